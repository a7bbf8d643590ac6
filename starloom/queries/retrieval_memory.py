"""Messages, BM25, vectors, hybrid retrieval and memory scoring on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions import scalars as S
from starloom.functions import text as T
from starloom.operators import cross_index as X
from starloom.operators import dedupe as DD
from starloom.operators import messages as M
from starloom.operators import retrieval as R
from starloom.operators import vectors as V
from starloom.queries import load, query
from starloom.session import scratch_path

def _letters_sql(text: str) -> str:
    """The counts of the letters a to z in a text."""
    return f"list_transform(range(0, 26), lambda i: (length(lower({text})) - length(replace(lower({text}), chr((97 + i)::INTEGER), '')))::DOUBLE)"


NOW = "2024-02-01 00:00:00"
WIDTH = 64


def _messages(spark, sf):
    c = load(spark, sf, "conversations")
    return c.select((F.col("conv_id").cast("long") * 4294967296 + F.col("turn")).alias("seq"), "conv_id", "role", F.col("text").alias("content"),
                    F.substring_index("text", " ", 1).alias("head"))


_MSG = "m AS (SELECT conv_id::BIGINT * 4294967296 + turn AS seq, conv_id, role, text AS content, split_part(text, ' ', 1) AS head FROM conversations)"


@query(f"WITH {_MSG} SELECT seq, role, content FROM m WHERE role = 'user' AND contains(content, 'the')")
def msg_by_role(spark, sf):
    return M.by_content(M.by_role(_messages(spark, sf), "user"), "the").select("seq", "role", "content")


@query("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def metadata_filter(spark, sf):
    wanted = {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "2-HIGH"]}
    return load(spark, sf, "orders").filter(S.metadata_filter(wanted)).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(f"WITH {_MSG} SELECT seq, role, content FROM m ORDER BY seq DESC LIMIT 50")
def msg_recent_k(spark, sf):
    return M.latest(_messages(spark, sf), 50).select("seq", "role", "content")


@query(f"WITH {_MSG} SELECT conv_id, seq, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY seq DESC) AS rn FROM m) WHERE rn > 3")
def msg_archive(spark, sf):
    return M.older_than_latest(_messages(spark, sf), "conv_id", 3).select("conv_id", "seq", "role")


@query(f"WITH {_MSG} SELECT role, max(seq) AS seq, max_by(content, seq) AS content FROM m GROUP BY role")
def msg_latest_of_kind(spark, sf):
    return M.latest_of_kind(_messages(spark, sf), "role")


@query(f"""WITH {_MSG}, k AS (SELECT DISTINCT head FROM (SELECT head FROM m WHERE role = 'assistant' ORDER BY seq DESC LIMIT 100))
SELECT seq, head FROM m WHERE role = 'user' AND head NOT IN (SELECT head FROM k)""")
def msg_find_news(spark, sf):
    m = _messages(spark, sf)
    return M.unseen(M.by_role(m, "user").select("seq", "head"), M.by_role(m, "assistant"), ["head"], 100)


@query(f"WITH {_MSG} SELECT role, head, min(seq) AS seq FROM m GROUP BY role, head")
def msg_first_occurrences(spark, sf):
    return M.first_occurrences(_messages(spark, sf).select("seq", "role", "head"), ["role", "head"])


@query("""SELECT source, lang, h AS fingerprint, min(doc_id) AS doc_id FROM (SELECT *, sha256(text) AS h FROM documents) GROUP BY ALL""")
def dedup_first(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", "source", "lang", T.fingerprint(F.col("text")).alias("fingerprint"))
    return M.first_occurrences(d, ["source", "lang", "fingerprint"], "doc_id").select("source", "lang", "fingerprint", "doc_id")


def _mail(spark, sf):
    e = load(spark, sf, "events")
    loud = F.when(F.get_json_object("props", "$.k") == "7", F.array(F.lit(M.ALL_RECIPIENTS))).otherwise(F.array().cast("array<string>"))
    letters = e.select("event_id", F.concat(F.array(F.concat(F.lit("u"), F.col("user_id").cast("string")), F.concat(F.lit("seg-"), "event_type")), loud).alias("send_to"))
    people = load(spark, sf, "customer").select(
        F.col("c_name").alias("recipient"), F.array(F.concat(F.lit("u"), (F.col("c_custkey") * 3).cast("string")), F.lit("seg-none")).alias("addresses"))
    return letters, people


_MAIL = """mail AS (SELECT event_id, user_id, json_extract_string(props, '$.k') = '7' AS loud FROM events),
direct AS (SELECT event_id, c_name AS recipient FROM mail JOIN customer ON user_id = c_custkey * 3 WHERE NOT loud)"""


@query(f"WITH {_MAIL} SELECT event_id, recipient FROM direct UNION ALL SELECT event_id, '<all>' FROM mail WHERE loud")
def msg_route(spark, sf):
    return M.routes(*_mail(spark, sf), "event_id", "recipient")


@query(f"""WITH {_MAIL} SELECT c_name AS recipient, coalesce(d.n, 0) + (SELECT count(*) FROM mail WHERE loud) AS messages
FROM customer LEFT JOIN (SELECT recipient, count(*) AS n FROM direct GROUP BY 1) d ON c_name = d.recipient""")
def msg_mailboxes(spark, sf):
    letters, people = _mail(spark, sf)
    return M.mailbox_sizes(M.routes(letters, people, "event_id", "recipient"), people, "recipient")


@query(f"WITH {_MAIL} SELECT event_id FROM mail WHERE NOT loud AND user_id NOT IN (SELECT c_custkey * 3 FROM customer)")
def msg_unrouted(spark, sf):
    return M.unrouted(*_mail(spark, sf), "event_id").select("event_id")


def _records(spark, sf):
    e = load(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    return e.select("event_id", F.array(F.initcap("event_type"), F.concat(F.lit("user"), F.col("user_id").cast("string"))).alias("keywords"),
                    F.when(k == "1", "is").otherwise("does").alias("p"), F.when(k == "1", "idle").otherwise(F.col("event_type")).alias("o"))


_POST = "post AS (SELECT event_id, unnest([event_type, 'user' || user_id]) AS keyword, json_extract_string(props, '$.k') = '1' AS idle FROM events)"


@query(f"WITH {_POST} SELECT keyword, max(event_id) AS last_event_id, count(*) AS records FROM post GROUP BY keyword")
def keyword_index(spark, sf):
    return M.last_by_keyword(M.keyword_postings(_records(spark, sf), "event_id", "keywords", "event_id").select("keyword", "event_id"), "event_id", "event_id")


@query(f"WITH {_POST} SELECT keyword, event_id, row_number() OVER (PARTITION BY keyword ORDER BY event_id DESC) AS position FROM post")
def keyword_positions(spark, sf):
    """The newest-first list of every keyword, as rows."""
    postings = M.keyword_postings(_records(spark, sf).withColumn("seq", F.col("event_id")), "event_id", "keywords", "seq")
    return M.ranked_postings(postings, "event_id", "seq").select("keyword", "event_id", "position")


@query(f"WITH {_POST} SELECT keyword, count(*) AS strength FROM post WHERE NOT idle GROUP BY keyword")
def keyword_strength(spark, sf):
    return M.keyword_strength(_records(spark, sf), "keywords", "p", "o")


@query(f"WITH {_POST} SELECT DISTINCT event_id FROM post WHERE keyword IN ('error', 'user7')")
def keyword_relevant(spark, sf):
    r = _records(spark, sf)
    postings = M.keyword_postings(r.withColumn("seq", F.col("event_id")), "event_id", "keywords", "seq")
    return M.relevant(r, postings, "event_id", ["Error", "USER7"]).select("event_id")


@query("SELECT DISTINCT event_type || ' by ' || (user_id % 10) AS summary FROM (SELECT * FROM events ORDER BY event_id DESC LIMIT 40)")
def latest_summaries(spark, sf):
    text = F.concat(F.col("event_type"), F.lit(" by "), (F.col("user_id") % 10).cast("string"))
    return M.latest_summaries(load(spark, sf, "events"), 40, "event_id", text)


@query("""
WITH t AS (SELECT user_id, event_type, count(*) AS votes, min(event_id) AS f FROM events WHERE event_type <> 'error' GROUP BY ALL)
SELECT user_id, event_type AS winner, votes FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, f) AS rn FROM t) WHERE rn = 1""")
def vote_tally(spark, sf):
    e = load(spark, sf, "events").withColumn("choice", F.when(F.col("event_type") != "error", F.col("event_type")).otherwise(""))
    return M.vote_winner(e, "user_id", "choice", "event_id")


@query("SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') > count(*) FILTER (l_returnflag <> 'R') AS accepted FROM lineitem GROUP BY l_orderkey")
def majority_verdict(spark, sf):
    return M.majority(load(spark, sf, "lineitem").select("l_orderkey", (F.col("l_returnflag") == "R").alias("v")), "l_orderkey", "v")


def _bm25_sql(lower: bool, k: int) -> str:
    text = "lower(text)" if lower else "text"
    return f"""
toks AS (SELECT doc_id, list_filter(regexp_split_to_array({text}, '\\s+'), lambda x: x <> '') AS ts FROM documents),
dl AS (SELECT doc_id, len(ts) AS n FROM toks), stats AS (SELECT count(*) AS nd, avg(n) AS avgdl FROM dl),
tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS t FROM toks) GROUP BY ALL),
df AS (SELECT t, ln(nd - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM tf, stats GROUP BY t, nd),
idf AS (SELECT t, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM df) ELSE idf END AS idf FROM df),
q AS (SELECT item_id, t, count(*) AS w FROM (SELECT item_id, unnest(list_filter(regexp_split_to_array({text}, '\\s+'), lambda x: x <> '')) AS t FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, round(sum(w * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * n / avgdl))), 6) AS score
 FROM q JOIN tf USING (t) JOIN idf USING (t) JOIN dl USING (doc_id), stats GROUP BY ALL),
bm AS (SELECT * FROM (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s) WHERE rank <= {k})"""


@query(f"WITH {_bm25_sql(True, 5)} SELECT item_id, doc_id, score, rank FROM bm")
def bm25_topk(spark, sf):
    index = R.BM25Index(load(spark, sf, "documents"), "doc_id", "text", lower=True)
    return index.top_k(load(spark, sf, "benchmark"), "item_id", "text", 5, digits=6)


@query(f"WITH {_bm25_sql(False, 20)} SELECT item_id, doc_id, score, rank FROM bm")
def bm25_whitespace(spark, sf):
    """Case-sensitive tokens; the index is built on one language and the others are added."""
    d = load(spark, sf, "documents")
    index = R.BM25Index(d.filter("lang = 'en'"), "doc_id", "text").add(d.filter("lang <> 'en'"))
    return index.top_k(load(spark, sf, "benchmark"), "item_id", "text", 20, digits=6)


def _centroids(spark, sf):
    return V.centroids(load(spark, sf, "embeddings"), "label", "embedding", WIDTH).withColumnRenamed("label", "query_id")


_CENTROIDS = f"""c AS (SELECT query_id, list(v ORDER BY i) AS qv FROM (SELECT label AS query_id, i, round(avg(CAST(embedding[i] AS DOUBLE)), 6) AS v
 FROM embeddings, range(1, {WIDTH + 1}) r(i) GROUP BY label, i) GROUP BY query_id)"""


def _nearest_sql(measure: str, order: str, k: int, where: str = "true") -> str:
    return f"""n AS (SELECT query_id, vec_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score {order}, vec_id) AS INTEGER) AS rank
 FROM (SELECT query_id, vec_id, label, round({measure}(CAST(embedding AS DOUBLE[]), qv), 6) AS score FROM embeddings, c WHERE {where}) QUALIFY rank <= {k})"""


@query(f"WITH {_CENTROIDS}, {_nearest_sql('list_cosine_similarity', 'DESC', 10)} SELECT query_id, vec_id, score, rank FROM n")
def vec_topk_cosine(spark, sf):
    return V.top_k(load(spark, sf, "embeddings"), _centroids(spark, sf), "vec_id", "query_id", "embedding", 10, digits=6)


@query(f"WITH {_CENTROIDS}, {_nearest_sql('list_distance', 'ASC', 5)} SELECT query_id, vec_id, score, rank FROM n")
def vec_topk_l2(spark, sf):
    return V.top_k(load(spark, sf, "embeddings"), _centroids(spark, sf), "vec_id", "query_id", "embedding", 5, metric="l2", digits=6)


@query(f"WITH {_CENTROIDS}, {_nearest_sql('list_cosine_similarity', 'DESC', 10, 'label >= 3 AND label <> 6')} SELECT query_id, vec_id, score, rank FROM n")
def vec_filtered(spark, sf):
    """The filter is applied before scoring."""
    where = S.all_of([F.col("label") >= 3, F.col("label") != 6])
    return V.top_k(load(spark, sf, "embeddings"), _centroids(spark, sf), "vec_id", "query_id", "embedding", 10, where=where, digits=6)


RADIUS = 0.1


def _observed_and_stored(spark, sf):
    """Observed: every vector, stretched by 0, 4, 8 or 12 percent.  Stored: the lower labels as they are."""
    e = load(spark, sf, "embeddings")
    stretch = 1 + (F.col("vec_id") % 4) * 0.04
    own = e.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double") * stretch).alias("embedding"))
    return own, e.filter("label < 5").select(F.col("embedding").cast("array<double>").alias("embedding"))


def _near_sql(word: str) -> str:
    return f"""WITH s AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label < 5),
o AS (SELECT vec_id, label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (1 + (vec_id % 4) * 0.04)) AS v FROM embeddings)
SELECT vec_id, label FROM o WHERE {word} (SELECT 1 FROM s WHERE list_distance(s.v, o.v) < {RADIUS})"""


@query(_near_sql("EXISTS"))
def vec_within(spark, sf):
    """Observed vectors with a stored neighbour."""
    return V.near_any(*_observed_and_stored(spark, sf), "embedding", RADIUS).select("vec_id", "label")


@query(_near_sql("NOT EXISTS"))
def vec_find_news(spark, sf):
    """Observed vectors without a stored neighbour: the news."""
    return V.near_any(*_observed_and_stored(spark, sf), "embedding", RADIUS, negate=True).select("vec_id", "label")


@query("""
WITH up AS (SELECT vec_id, 99 AS label FROM embeddings WHERE label = 2)
SELECT vec_id, label FROM embeddings WHERE label NOT IN (2, 4) UNION ALL SELECT vec_id, label FROM up""")
def vec_upsert_delete(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", "label")
    store = V.upsert(e, e.filter("label = 2").withColumn("label", F.lit(99)), "vec_id")
    return V.delete(store, e.filter("label = 4").select("vec_id"), "vec_id")


@query("""
WITH v AS (SELECT vec_id, label, 0 AS version FROM embeddings UNION ALL SELECT vec_id, label + 100, 2 FROM embeddings WHERE label = 3 UNION ALL SELECT vec_id, label + 50, 1 FROM embeddings WHERE label < 5)
SELECT vec_id, max_by(label, version) AS label, max(version) AS version FROM v GROUP BY vec_id""")
def vec_latest_versions(spark, sf):
    """Several versions of some vectors; the last one of each counts."""
    e = load(spark, sf, "embeddings").select("vec_id", "label")
    newer = e.filter("label = 3").select("vec_id", F.expr("label + 100").alias("label"), F.lit(2).alias("version"))
    between = e.filter("label < 5").select("vec_id", F.expr("label + 50").alias("label"), F.lit(1).alias("version"))
    return V.latest_versions(e.withColumn("version", F.lit(0)).unionByName(newer).unionByName(between), "vec_id", "version")


def _text_and_vector_queries(spark, sf):
    b, e = load(spark, sf, "benchmark"), load(spark, sf, "embeddings")
    return b.join(e.select(F.col("vec_id").alias("item_id"), "embedding"), "item_id")


@query(f"""WITH {_bm25_sql(True, 5)},
c AS (SELECT item_id AS query_id, CAST(embedding AS DOUBLE[]) AS qv FROM benchmark JOIN embeddings ON item_id = vec_id),
{_nearest_sql('list_cosine_similarity', 'DESC', 5)},
u AS (SELECT item_id, doc_id, score, 0 AS list_no, rank FROM bm WHERE item_id IN (SELECT query_id FROM c) UNION ALL SELECT query_id, vec_id, score, 1, rank FROM n),
f AS (SELECT *, row_number() OVER (PARTITION BY item_id, doc_id ORDER BY list_no, rank) AS first FROM u QUALIFY first = 1)
SELECT item_id, doc_id, score, list_no, rank, CAST(row_number() OVER (PARTITION BY item_id ORDER BY list_no, rank) AS INTEGER) AS merged_rank FROM f""")
def hybrid_topk(spark, sf):
    q = _text_and_vector_queries(spark, sf)
    index = R.BM25Index(load(spark, sf, "documents"), "doc_id", "text", lower=True)
    lexical = index.top_k(q, "item_id", "text", 5, digits=6)
    store = load(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    semantic = V.top_k(store, q, "doc_id", "item_id", "embedding", 5, digits=6)
    return R.first_wins([lexical, semantic], "item_id", "doc_id")


def _memories(spark, sf):
    e, v = load(spark, sf, "events"), load(spark, sf, "embeddings").select(F.col("vec_id").alias("event_id"), "embedding")
    return e.join(v, "event_id").select(
        F.col("event_id").alias("memory_id"), "embedding", F.col("ts").alias("created"),
        F.expr("ts + make_dt_interval(cast(user_id % 7 as int))").alias("accessed"), F.col("value").alias("poignancy"), "event_type")


def _memory_sql(where: str, k: int) -> str:
    return f"""WITH {_CENTROIDS},
mem AS (SELECT event_id AS memory_id, CAST(embedding AS DOUBLE[]) AS v, ts + INTERVAL 1 DAY * (user_id % 7) AS accessed, value AS imp,
 pow(0.99, floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(ts)) / 86400000000)) AS rec FROM events JOIN embeddings ON event_id = vec_id WHERE {where}),
r AS (SELECT query_id, memory_id, accessed, imp, rec, list_cosine_similarity(v, qv) AS rel FROM mem, c),
s AS (SELECT *, min(imp) OVER w AS i0, max(imp) OVER w AS i1, min(rec) OVER w AS r0, max(rec) OVER w AS r1, min(rel) OVER w AS l0, max(rel) OVER w AS l1 FROM r WINDOW w AS (PARTITION BY query_id)),
t AS (SELECT query_id, memory_id, accessed, round(CASE WHEN i1 = i0 THEN 0.5 ELSE (imp - i0) / (i1 - i0) END + CASE WHEN r1 = r0 THEN 0.5 ELSE (rec - r0) / (r1 - r0) END + CASE WHEN l1 = l0 THEN 0.5 ELSE (rel - l0) / (l1 - l0) END, 6) AS score FROM s)
SELECT query_id, memory_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, accessed DESC, memory_id) AS INTEGER) AS rank FROM t QUALIFY rank <= {k}"""


_MEMORY_COLUMNS = dict(query_id="query_id", vector="embedding", created="created", accessed="accessed", importance="poignancy", digits=6)


@query(_memory_sql("true", 4))
def memory_retrieve(spark, sf):
    return V.memory_retrieve(_memories(spark, sf), _centroids(spark, sf), memory_id="memory_id", now=NOW, k=4, **_MEMORY_COLUMNS)


@query(_memory_sql("event_type <> 'error'", 30))
def memory_focus(spark, sf):
    m = _memories(spark, sf).withColumn("key_text", F.when(F.col("event_type") == "error", "is idle").otherwise(F.col("event_type")))
    found, _ = V.focus_retrieve(m, _centroids(spark, sf), memory_id="memory_id", key_text="key_text", now=NOW, k=30, **_MEMORY_COLUMNS)
    return found


@query(_memory_sql("event_type <> 'error'", 30).replace("WITH ", "WITH found AS (WITH ", 1) + f""")
SELECT event_id AS memory_id, CASE WHEN event_id IN (SELECT memory_id FROM found) THEN TIMESTAMP '{NOW}' ELSE ts + INTERVAL 1 DAY * (user_id % 7) END AS accessed
FROM events JOIN embeddings ON event_id = vec_id""")
def memory_focus_access(spark, sf):
    """The access times of all memories after the focus points have been looked up, written back and read again."""
    m = _memories(spark, sf).withColumn("key_text", F.when(F.col("event_type") == "error", "is idle").otherwise(F.col("event_type")))
    _, touched = V.focus_retrieve(m, _centroids(spark, sf), memory_id="memory_id", key_text="key_text", now=NOW, k=30, **_MEMORY_COLUMNS)
    return V.write_access(m, touched, "memory_id", "accessed", scratch_path(spark, "memories")).select("memory_id", "accessed")


@query(f"""
WITH m AS (SELECT conv_id, turn, role, {_letters_sql('text')} AS v, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS nth, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
q AS (SELECT conv_id, v AS qv FROM m WHERE nth = 1 AND role = 'user' AND n > 3),
f AS (SELECT m.conv_id, turn, row_number() OVER (PARTITION BY m.conv_id ORDER BY round(coalesce(list_cosine_similarity(v, qv), 0), 6) DESC, turn) AS r FROM m JOIN q USING (conv_id) WHERE nth > 2 QUALIFY r <= 5),
u AS (SELECT conv_id, turn, false AS related, 8 - nth AS place FROM m WHERE nth <= 2 UNION ALL SELECT conv_id, turn, true, r FROM f)
SELECT conv_id, turn, related, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY place) AS INTEGER) AS position FROM u""")
def memory_recall_union(spark, sf):
    """The latest two messages of each conversation after up to five related older ones."""
    c = load(spark, sf, "conversations").select("conv_id", "turn", "role", X.letter_shares(F.col("text")).alias("embedding"))
    return V.recall_union(c, "conv_id", "turn", "role", "embedding", k=2, minimum=3, digits=6)


@query("""SELECT conv_id, count(*) AS messages, max_by(role, turn) AS last_role, count(*) > 3 AND max_by(role, turn) = 'user' AS use_longterm
FROM conversations GROUP BY conv_id""")
def memory_recall_gate(spark, sf):
    return V.recall_gate(load(spark, sf, "conversations"), "conv_id", "turn", "role", k=5, minimum=3)


@query("SELECT event_id, props, CAST(json_extract_string(props, '$.k') AS INTEGER) AS obj_k FROM events ORDER BY obj_k DESC, event_id LIMIT 50")
def object_rank(spark, sf):
    return R.order_by_object_field(load(spark, sf, "events").select("event_id", "props"), "props", "k", "int", 50)


@query("SELECT event_id, event_type, value FROM events")
def object_nodes(spark, sf):
    e = load(spark, sf, "events").select("event_id", "event_type", "value")
    return R.objects_back(R.as_object_nodes(e, "Event", F.col("event_type")), "event_id bigint, event_type string, value double")


_EXPS = "x AS (SELECT event_id AS exp_id, user_id || '/' || event_type AS req, CAST(floor(value / 10) AS INTEGER) AS score, props AS resp FROM events)"


def _experiences(spark, sf):
    e = load(spark, sf, "events")
    return e.select(F.col("event_id").alias("exp_id"), F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("req"),
                    F.floor(F.col("value") / 10).cast("int").alias("score"), F.col("props").alias("resp"), F.col("event_type").alias("tag"), "value")


@query(f"""WITH {_EXPS}, best AS (SELECT req, min_by(resp, exp_id) AS resp FROM x WHERE score = 10 GROUP BY req),
a AS (SELECT DISTINCT c_custkey || '/purchase' AS req FROM customer)
SELECT a.req, best.resp, best.resp IS NOT NULL AS hit FROM a LEFT JOIN best ON a.req = best.req""")
def experience_cache(spark, sf):
    asked = load(spark, sf, "customer").select(F.concat(F.col("c_custkey").cast("string"), F.lit("/purchase")).alias("req")).distinct()
    return R.cached_answers(asked, _experiences(spark, sf).select("exp_id", "req", "score", "resp"), "req")


@query("""SELECT event_id AS exp_id, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events)
WHERE rn <= 20 AND event_type = 'purchase' AND value > 50""")
def experience_filter_after(spark, sf):
    """Tag and exact filters after the top 20 per user: fewer may remain."""
    top = R.top_per(load(spark, sf, "events"), "user_id", [F.col("value").desc(), F.col("event_id")], 20)
    kept = R.filter_after_top_k(top, (F.col("event_type") == "purchase") & (F.col("value") > 50))
    return kept.select(F.col("event_id").alias("exp_id"), "user_id", "value")


@query("""
WITH b AS (SELECT user_id, event_id, ts, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) <= 5)
SELECT user_id, event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS position FROM b""")
def recall_by_time(spark, sf):
    """The five highest events of each user in order of time."""
    e = load(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    out = R.by_time_after_top_k(e, "user_id", [F.col("value").desc(), F.col("event_id")], 5, [F.col("ts"), F.col("event_id")])
    return out.select("user_id", "event_id", "position")


@query(f"""WITH {_CENTROIDS}, d AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) BETWEEN 100 AND 100000 AS fits FROM documents),
{_nearest_sql('list_cosine_similarity', 'DESC', 10)}
SELECT CAST(NULL AS INTEGER) AS query_id, doc_id, CAST(NULL AS DOUBLE) AS score, 'whole' AS kind FROM d WHERE NOT fits
UNION ALL SELECT query_id, vec_id, score, 'node' FROM n JOIN d ON vec_id = doc_id AND fits""")
def index_search(spark, sf):
    """Files outside the token budget whole, plus the vector hits that belong to indexed files."""
    fits = T.word_count(F.col("text")).between(100, 100_000)
    d = load(spark, sf, "documents").select("doc_id", fits.alias("fits"))
    hits = V.top_k(load(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id"), _centroids(spark, sf), "doc_id", "query_id", "embedding", 10, digits=6)
    nodes = hits.join(d.filter("fits"), "doc_id", "left_semi").select("query_id", "doc_id", "score", F.lit("node").alias("kind"))
    whole = d.filter("not fits").select(F.lit(None).cast("int").alias("query_id"), "doc_id", F.lit(None).cast("double").alias("score"), F.lit("whole").alias("kind"))
    return whole.unionByName(nodes)


def _paths(spark, sf):
    path = F.when(F.col("lang") == "en", F.concat(F.lit("/data/chats/"), "source", F.lit("/f"), F.col("doc_id").cast("string"))).when(
        F.col("lang") == "fr", F.concat(F.lit("/data/uploads/"), "source")).otherwise(F.concat(F.lit("/srv/"), "source"))
    return load(spark, sf, "documents").select("doc_id", "n_chars", path.alias("path"))


@query("""SELECT CASE lang WHEN 'en' THEN 'chats/' || source WHEN 'fr' THEN 'uploads' ELSE 'other' END AS index_id, count(*) AS files FROM documents GROUP BY ALL""")
def index_clusters(spark, sf):
    return _paths(spark, sf).groupBy(R.index_of_path(F.col("path")).alias("index_id")).agg(F.count(F.lit(1)).alias("files"))


@query("""
WITH x AS (SELECT CASE lang WHEN 'en' THEN 'chats/' || source WHEN 'fr' THEN 'uploads' ELSE 'other' END AS index_id, doc_id AS position, n_chars / 100.0 AS score FROM documents),
s AS (SELECT *, row_number() OVER (PARTITION BY index_id ORDER BY score DESC, position) AS rn FROM x)
SELECT index_id, position, CAST(score AS DOUBLE) AS score, rn AS rank FROM s WHERE rn <= 30""")
def index_merge(spark, sf):
    """The best 30 results per index."""
    found = _paths(spark, sf).select(R.index_of_path(F.col("path")).alias("index_id"), F.col("doc_id").alias("position"), (F.col("n_chars") / 100.0).alias("score"))
    return R.recall_merge(found, "index_id", 30)


@query(f"""
WITH files AS (SELECT CASE lang WHEN 'en' THEN '/data/chats/' || source || '/f' || doc_id WHEN 'fr' THEN '/data/uploads/' || source || '/' || doc_id ELSE '/srv/' || doc_id END AS path,
  CASE lang WHEN 'en' THEN 'chats/' || source WHEN 'fr' THEN 'uploads' ELSE 'other' END AS idx, text,
  len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) BETWEEN 100 AND 100000 AS fits FROM documents),
q AS (SELECT item_id, {_letters_sql('text')} AS qv FROM benchmark),
nodes AS (SELECT item_id, path, text FROM files JOIN q ON fits AND idx <> 'other'
  QUALIFY row_number() OVER (PARTITION BY item_id, idx ORDER BY round(coalesce(list_cosine_similarity({_letters_sql('text')}, qv), 0), 6) DESC, path) <= 3),
results AS (SELECT *, 'node' AS kind FROM nodes UNION ALL SELECT item_id, path, text, 'text' FROM files JOIN q ON NOT fits AND idx <> 'other'),
parts AS (SELECT item_id, path, kind, unnest(CASE WHEN length(text) > 3000 THEN [substr(text, 1, CAST(length(text) // 10 * 6 AS INTEGER)), substr(text, CAST(length(text) // 10 * 4 AS INTEGER) + 1)] ELSE [text] END) AS piece FROM results),
scored AS (SELECT item_id, path, kind, max(round(coalesce(list_cosine_similarity({_letters_sql('piece')}, qv), 0), 6)) AS score FROM parts JOIN q USING (item_id) GROUP BY ALL)
SELECT item_id, path, score, kind, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, path) AS INTEGER) AS rank FROM scored QUALIFY rank <= 10
UNION ALL SELECT NULL, path, NULL, 'whole', NULL FROM files WHERE idx = 'other'""")
def cross_index_search(spark, sf):
    """Every benchmark text over the indexes that the documents' paths belong to."""
    path = F.when(F.col("lang") == "en", F.concat(F.lit("/data/chats/"), "source", F.lit("/f"), F.col("doc_id").cast("string"))).when(
        F.col("lang") == "fr", F.concat(F.lit("/data/uploads/"), "source", F.lit("/"), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("/srv/"), F.col("doc_id").cast("string")))
    files = load(spark, sf, "documents").select(path.alias("path"), "text")
    return X.cross_search(files, load(spark, sf, "benchmark"), "path", "text", "item_id", "text", T.word_count(F.col("text")),
                          k=3, recall=10, longest=3_000, low=100, high=100_000, digits=6)


@query("""
WITH w AS (SELECT doc_id, source, text, length(text) AS n FROM documents),
s AS (SELECT doc_id, source, text, n, unnest(CASE WHEN n <= 500 THEN [0] ELSE range(0, least((n - 500) // 480 + 1, (n - 1) // 480) + 1) END) AS i FROM w)
SELECT source || '/' || doc_id AS file_path, CAST(i AS INTEGER) AS pos, sha256(text) AS fingerprint, length(substr(text, i * 480 + 1, 500)) AS chars FROM s""")
def index_build(spark, sf):
    """Every document cut into overlapping windows, written as an index and read back."""
    d = load(spark, sf, "documents").select(F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("path"), "text")
    index = R.build_index(d, "path", "text", T.char_windows(F.col("text"), 500), scratch_path(spark, "index"))
    return index.select("file_path", "pos", "fingerprint", F.length("text").cast("bigint").alias("chars"))


@query("""
SELECT doc_id, substr(text, 1, CAST(length(text) // 10 * 6 AS INTEGER)) AS head, substr(text, CAST(length(text) // 10 * 4 AS INTEGER) + 1) AS tail FROM documents""")
def index_half_windows(spark, sf):
    parts = load(spark, sf, "documents").select("doc_id", R.half_windows(F.col("text")).alias("w"))
    return parts.select("doc_id", F.element_at("w", 1).alias("head"), F.element_at("w", 2).alias("tail"))


@query("""SELECT source AS file_path, count(*) AS chunks, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents WHERE source NOT IN ('src3', 'src5') GROUP BY source
UNION ALL SELECT 'src3', 2 * count(*), CAST(2 * sum(length(text)) AS BIGINT) FROM documents WHERE source = 'src3'""")
def index_replace_delete(spark, sf):
    """One file's rows replaced by a doubled version, another file deleted."""
    index = load(spark, sf, "documents").select(F.col("source").alias("file_path"), "doc_id", "text")
    new = index.filter("file_path = 'src3'")
    kept = R.delete_files(R.replace_files(index, new.unionByName(new), "file_path"), index.filter("file_path = 'src5'"), "file_path")
    return kept.groupBy("file_path").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.length("text")).alias("chars"))


@query()
def near_dup(spark, sf):
    return DD.near_duplicates(load(spark, sf, "documents"), "doc_id", "text")
