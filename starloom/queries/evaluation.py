"""Answer scoring, retrieval metrics, model scores, rounds, votes and trees on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.functions import scalars as S
from starloom.functions import text as T
from starloom.operators import evals as E
from starloom.operators import graph as G
from starloom.operators import rounds as RO
from starloom.operators.retrieval import BM25Index
from starloom.queries import load, query
from starloom.session import spread

PUNCT_SQL = T.PUNCTUATION.replace("'", "''")


def _norm_sql(text: str) -> str:
    plain = f"translate(lower({text}), '{PUNCT_SQL}', '')"
    return f"list_filter(regexp_split_to_array({plain}, '\\s+'), lambda x: x NOT IN ('', 'a', 'an', 'the'))"


def _turn_pairs(spark, sf):
    """Each turn with the next one of its conversation as the answer."""
    c = load(spark, sf, "conversations")
    reply = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("prediction"))
    return c.select("conv_id", "turn", F.col("text").alias("expected")).join(reply, ["conv_id", "turn"])


_TURNS = "p AS (SELECT a.conv_id, a.turn, a.text AS expected, b.text AS prediction FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"


@query(f"""WITH {_TURNS}, t AS (SELECT conv_id, turn, {_norm_sql('prediction')} AS pt, {_norm_sql('expected')} AS et FROM p),
x AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(pt) AS w FROM t) GROUP BY ALL),
y AS (SELECT conv_id, turn, w, count(*) AS n FROM (SELECT conv_id, turn, unnest(et) AS w FROM t) GROUP BY ALL),
s AS (SELECT conv_id, turn, sum(least(x.n, y.n)) AS same FROM x JOIN y USING (conv_id, turn, w) GROUP BY ALL)
SELECT conv_id, turn, round(CASE WHEN coalesce(same, 0) = 0 THEN 0.0 ELSE 2 * (same / len(pt)) * (same / len(et)) / (same / len(pt) + same / len(et)) END, 6) AS f1
FROM t LEFT JOIN s USING (conv_id, turn)""")
def text_f1(spark, sf):
    return _turn_pairs(spark, sf).select("conv_id", "turn", F.round(E.text_f1(F.col("prediction"), F.col("expected")), 6).alias("f1"))


@query(f"""WITH {_TURNS},
a AS (SELECT conv_id, turn, unnest(string_split(replace(expected, '.', '|'), '|')) AS a FROM p),
o AS (SELECT conv_id, turn, unnest(string_split(replace(prediction, '.', '|'), '|')) AS o FROM p),
pr AS (SELECT row_number() OVER () AS id, conv_id, turn, {_norm_sql('o')} AS pt, {_norm_sql('a')} AS et FROM a JOIN o USING (conv_id, turn) WHERE trim(a) <> ''),
x AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(pt) AS w FROM pr) GROUP BY ALL), y AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(et) AS w FROM pr) GROUP BY ALL),
s AS (SELECT id, sum(least(x.n, y.n)) AS same FROM x JOIN y USING (id, w) GROUP BY id),
f AS (SELECT conv_id, turn, CASE WHEN coalesce(same, 0) = 0 THEN 0.0 ELSE 2 * (same / len(pt)) * (same / len(et)) / (same / len(pt) + same / len(et)) END AS f1 FROM pr LEFT JOIN s USING (id))
SELECT conv_id::BIGINT * 4294967296 + turn AS pair_id, round(max(f1), 6) AS score, max(f1) < 0.3 AS is_mismatch FROM f GROUP BY ALL""")
def text_max_f1(spark, sf):
    pairs = _turn_pairs(spark, sf).select(
        (F.col("conv_id").cast("long") * 4294967296 + F.col("turn")).alias("pair_id"), F.translate("prediction", ".", "|").alias("prediction"),
        F.translate("expected", ".", "|").alias("expected"))
    return E.best_f1(pairs, "pair_id", "prediction", "expected").withColumn("score", F.round("score", 6))


@query("""
WITH t AS (SELECT p_partkey, p_retailprice, CASE WHEN p_type = 'PROMO' THEN 'no idea' ELSE 'about ' || p_size || ' units for $' || format('{:,.2f}', p_retailprice + CASE WHEN p_size > 40 THEN 1 ELSE 0 END) || ' in total' END AS said FROM part)
SELECT p_partkey, CASE WHEN said = 'no idea' THEN NULL ELSE CAST(replace(regexp_extract(said, '\\$([0-9,.]+)', 1), ',', '') AS DOUBLE) END AS number,
 CASE WHEN said <> 'no idea' AND abs(CAST(replace(regexp_extract(said, '\\$([0-9,.]+)', 1), ',', '') AS DOUBLE) - p_retailprice) <= 1e-6 THEN 1.0 ELSE 0.0 END::DOUBLE AS score FROM t""")
def num_match(spark, sf):
    p = load(spark, sf, "part")
    price = F.col("p_retailprice") + F.when(F.col("p_size") > 40, 1).otherwise(0)
    said = F.when(F.col("p_type") == "PROMO", "no idea").otherwise(
        F.concat(F.lit("about "), F.col("p_size").cast("string"), F.lit(" units for $"), F.format_number(price, 2), F.lit(" in total")))
    number = T.last_number(said)
    return p.select("p_partkey", number.alias("number"), E.number_match(F.col("p_retailprice"), number).alias("score"))


@query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_size || '\\%' WHEN p_size % 3 = 1 THEN '\\frac{' || p_size || '}{2}' ELSE 'it is ' || p_name || '.' END AS answer,
 p_size % 3 = 0 OR p_size = 1 AS is_equal FROM part""")
def boxed_match(spark, sf):
    """The last box, or the last sentence; percentages count as fractions."""
    p, size = load(spark, sf, "part"), F.col("p_size").cast("string")
    kind = F.col("p_size") % 3
    said = F.when(kind == 0, F.concat(F.lit("So $\\boxed{7}$ or rather $\\boxed{"), size, F.lit("\\%}$ holds. Done. "))).when(
        kind == 1, F.concat(F.lit("Hence \\boxed{\\frac{"), size, F.lit("}{2}}."))).otherwise(F.concat(F.lit("Version 3.5 says no. Well! it is "), "p_name", F.lit(".")))
    truth = F.when(kind == 0, (F.col("p_size") / 100).cast("string")).when(kind == 1, F.lit("\\frac{1}{2}")).otherwise("unknown")
    answer = T.final_answer(said)
    return p.select("p_partkey", answer.alias("answer"), T.math_equal(answer, truth).alias("is_equal"))


def _answers(spark, sf):
    p = load(spark, sf, "part")
    predictions = p.select("p_partkey", F.concat(
        F.lit("{@price["), F.format_number(F.col("p_retailprice") + F.when(F.col("p_size") > 40, 5).otherwise(0), 2), F.lit("], @size["), F.lit("1"),
        F.lit("] @size["), F.col("p_size").cast("string"), F.lit("] @kind["), F.when(F.col("p_type") == "PROMO", "none").otherwise(F.lower("p_type")), F.lit("]}")).alias("prediction"))
    pair = [F.array(F.lit("price"), F.col("p_retailprice").cast("string")), F.array(F.lit("size"), F.col("p_size").cast("string")),
            F.array(F.lit("kind"), F.col("p_type")), F.array(F.lit("missing"), F.lit("1"))]
    only = F.when(F.col("p_size") % 2 == 0, F.array(*pair)).otherwise(F.array(*pair[:3]))
    return predictions, p.select("p_partkey", only.alias("common_answers"))


_ANSWERS = """a AS (SELECT p_partkey, 'price' AS metric, p_size <= 40 AS is_correct FROM part UNION ALL SELECT p_partkey, 'size', true FROM part
 UNION ALL SELECT p_partkey, 'kind', p_type <> 'PROMO' FROM part UNION ALL SELECT p_partkey, 'missing', false FROM part WHERE p_size % 2 = 0)"""


@query(f"WITH {_ANSWERS} SELECT * FROM a")
def answer_map_score(spark, sf):
    return E.score_answers(*_answers(spark, sf), "p_partkey")


@query(f"""WITH {_ANSWERS}, q AS (SELECT p_partkey, sum(is_correct::INT) AS ok, count(*) AS n FROM a GROUP BY 1)
SELECT round_even(round(avg((ok = n)::INT), 10), 4) AS accuracy_by_question, round_even(round(sum(ok) / sum(n), 10), 4) AS accuracy_by_sub_question, round_even(round(avg(ok / n), 10), 4) AS proportional_accuracy FROM q""")
def acc_three(spark, sf):
    return E.three_accuracies(E.score_answers(*_answers(spark, sf), "p_partkey"), "p_partkey")


def _doc_pairs(spark, sf):
    """Every document with its successor: whole texts as response and reference."""
    d = load(spark, sf, "documents")
    left = d.select(F.col("doc_id").alias("pair_id"), F.col("text").alias("response"))
    right = d.select((F.col("doc_id") - 1).alias("pair_id"), F.col("text").alias("reference"))
    return left.join(right, "pair_id")


@query("""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS ts FROM documents),
t AS (SELECT doc_id AS pair_id, 0 AS side, ts FROM words WHERE doc_id + 1 IN (SELECT doc_id FROM words) UNION ALL SELECT doc_id - 1, 1, ts FROM words WHERE doc_id - 1 IN (SELECT doc_id FROM words)),
w0 AS (SELECT pair_id, side, unnest(ts) AS w, unnest(range(len(ts))) AS pos FROM t),
w1 AS (SELECT pair_id, side, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3, lead(w, 3) OVER o AS w4 FROM w0 WINDOW o AS (PARTITION BY pair_id, side ORDER BY pos)),
g AS (SELECT pair_id, side, 1 AS n, w AS gram FROM w1 UNION ALL SELECT pair_id, side, 2, w || ' ' || w2 FROM w1 WHERE w2 IS NOT NULL
 UNION ALL SELECT pair_id, side, 3, w || ' ' || w2 || ' ' || w3 FROM w1 WHERE w3 IS NOT NULL UNION ALL SELECT pair_id, side, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM w1 WHERE w4 IS NOT NULL),
c AS (SELECT pair_id, n, side, gram, count(*) AS k FROM g GROUP BY ALL),
m AS (SELECT a.pair_id, a.n, sum(least(a.k, b.k)) AS same FROM c a JOIN c b ON a.pair_id = b.pair_id AND a.n = b.n AND a.gram = b.gram AND a.side = 0 AND b.side = 1 GROUP BY ALL),
l AS (SELECT t.pair_id, r.n, greatest(len(ts) - r.n + 1, 0) AS size FROM t, range(1, 5) r(n) WHERE side = 0),
p AS (SELECT l.pair_id, l.n, CASE WHEN size = 0 THEN 0.0 ELSE coalesce(m.same, 0) / size END AS p FROM l LEFT JOIN m ON l.pair_id = m.pair_id AND l.n = m.n),
w AS (SELECT pair_id, max(p) FILTER (n = 1) AS p1, max(p) FILTER (n = 2) AS p2, max(p) FILTER (n = 3) AS p3, max(p) FILTER (n = 4) AS p4 FROM p GROUP BY 1)
SELECT pair_id, round(CASE WHEN least(p1, p2, p3, p4) > 0 THEN exp((ln(p1) + ln(p2) + ln(p3) + ln(p4)) / 4) ELSE 0.0 END, 6) AS bleu_avg,
 round(p1, 6) AS bleu1, round(p2, 6) AS bleu2, round(p3, 6) AS bleu3, round(p4, 6) AS bleu4 FROM w""")
def bleu(spark, sf):
    tokens = [F.filter(F.split(c, r"\s+"), lambda t: t != "") for c in ("response", "reference")]
    scored = _doc_pairs(spark, sf).select("pair_id", T.bleu(*tokens).alias("b"))
    return scored.select("pair_id", *[F.round(f"b.{c}", 6).alias(c) for c in ("bleu_avg", "bleu1", "bleu2", "bleu3", "bleu4")])


@query()
def rouge_l_rows(spark, sf):
    return E.metric_row(_doc_pairs(spark, sf), "pair_id", "response", "reference")


_BM25_ITEMS = """
toks AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS ts FROM benchmark),
dl AS (SELECT item_id, len(ts) AS n FROM toks), stats AS (SELECT count(*) AS nd, avg(n) AS avgdl FROM dl),
tf AS (SELECT item_id, t, count(*) AS tf FROM (SELECT item_id, unnest(ts) AS t FROM toks) GROUP BY ALL),
df AS (SELECT t, ln(nd - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM tf, stats GROUP BY t, nd),
idf AS (SELECT t, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM df) ELSE idf END AS idf FROM df),
q AS (SELECT doc_id, t, count(*) AS w FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '')) AS t FROM documents) GROUP BY ALL),
s AS (SELECT doc_id, item_id, round(sum(w * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * n / avgdl))), 6) AS score
 FROM q JOIN tf USING (t) JOIN idf USING (t) JOIN dl USING (item_id), stats GROUP BY ALL),
found AS (SELECT doc_id, item_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, item_id) AS rank FROM s JOIN benchmark USING (item_id) QUALIFY rank <= 5),
refs AS (SELECT doc_id, substr(text, 1, length(text) // 2) AS ref FROM documents UNION ALL SELECT doc_id, substr(text, length(text) // 2 + 1) FROM documents)"""


@query(f"""WITH {_BM25_ITEMS}, r AS (SELECT DISTINCT doc_id, ref FROM refs),
h AS (SELECT r.doc_id, ref, max(coalesce(contains(ref, f.text), false)::INT) AS hit, min(CASE WHEN contains(ref, f.text) THEN rank END) AS rank FROM r LEFT JOIN found f USING (doc_id) GROUP BY ALL)
SELECT doc_id, round(avg(hit), 6) AS recall, CAST(max(hit) AS DOUBLE) AS hit_rate, round(coalesce(1 / min(rank), 0.0), 6) AS mrr FROM h GROUP BY doc_id""")
def retrieval_recall_hit_mrr(spark, sf):
    """Benchmark passages retrieved for each document, judged against the document's two halves."""
    d, b = load(spark, sf, "documents"), load(spark, sf, "benchmark")
    found = BM25Index(b, "item_id", "text", lower=True).top_k(d, "doc_id", "text", 5, digits=6).join(b, "item_id")
    middle = F.floor(F.length("text") / 2).cast("int")
    refs = d.select("doc_id", F.explode(F.array(F.substr("text", F.lit(1), middle), F.substr("text", middle + 1))).alias("reference"))
    scores = E.retrieval_scores(found.select("doc_id", "rank", "text"), refs, "doc_id")
    return scores.select("doc_id", F.round("recall", 6).alias("recall"), "hit_rate", F.round("mrr", 6).alias("mrr"))


@query("""SELECT round(avg(value) FILTER (event_type <> 'error'), 6) AS mean_value, round(avg(user_id) FILTER (event_type <> 'error'), 6) AS mean_user_id,
 round(100.0 * count(*) FILTER (event_type = 'error') / count(*), 6) AS error_percent FROM events""")
def benchmark_means(spark, sf):
    e = load(spark, sf, "events").withColumn("error", F.when(F.col("event_type") == "error", "failed"))
    out = E.benchmark_means(e, ["value", "user_id"], "error")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("""
WITH x AS (SELECT quality AS t, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS p, n_chars AS s FROM labels JOIN documents USING (doc_id)),
l AS (SELECT k, count(*) FILTER (t = k) AS sup, count(*) FILTER (p = k) AS called, count(*) FILTER (t = k AND p = k) AS tp FROM x, (VALUES (0), (1)) v(k) GROUP BY k),
f AS (SELECT *, 2.0 * tp / (sup + called) AS f1 FROM l),
r AS (SELECT t, avg(rn) OVER (PARTITION BY s) AS ar FROM (SELECT *, row_number() OVER (ORDER BY s) AS rn FROM x))
SELECT round((SELECT avg((t = p)::INT) FROM x), 6) AS accuracy, round((SELECT f1 FROM f WHERE k = 1), 6) AS f1, round((SELECT sum(f1 * sup) / sum(sup) FROM f), 6) AS f1_weighted,
 round((SELECT (sum(ar) FILTER (t = 1) - count(*) FILTER (t = 1) * (count(*) FILTER (t = 1) + 1) / 2.0) / (count(*) FILTER (t = 1) * count(*) FILTER (t <> 1)) FROM r), 6) AS roc_auc""")
def cls_scores(spark, sf):
    x = load(spark, sf, "labels").join(load(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").select(
        F.col("quality").alias("t"), F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("p"), F.col("n_chars").alias("s"))
    both = E.classification_scores(x, "t", "p").withColumn("roc_auc", F.lit(E.roc_auc(x, "t", "s").first()[0]))
    return both.select(*[F.round(c, 6).alias(c) for c in both.columns])


@query("""
SELECT round(sqrt(avg((t - p) * (t - p))), 4) AS rmse, round(sqrt(avg((ln(1 + t) - ln(1 + p)) * (ln(1 + t) - ln(1 + p)))), 6) AS log_rmse
FROM (SELECT l_extendedprice AS t, l_quantity * 1500 AS p FROM lineitem)""")
def reg_scores(spark, sf):
    out = E.regression_scores(load(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("t"), (F.col("l_quantity") * 1500).alias("p")), "t", "p")
    return out.select(F.round("rmse", 4).alias("rmse"), F.round("log_rmse", 6).alias("log_rmse"))


def _results(spark, sf):
    """One result per event: the day is the round, the scaled value the score."""
    return load(spark, sf, "events").select(F.datediff(F.col("ts").cast("date"), F.lit("2023-12-31").cast("date")).alias("round"), (F.col("value") / 100).alias("score"))


def _stats(spark, sf):
    s = RO.round_stats(_results(spark, sf), "round", "score")
    return s.select("round", F.round("avg_score", 9).alias("avg_score"), F.round("std_score", 9).alias("std_score"))


_STATS = """st AS (SELECT CAST(date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS INTEGER) AS round, round(avg(value / 100), 9) AS avg_score, round(stddev_pop(value / 100), 9) AS std_score FROM events GROUP BY 1)"""

_RUNNING = f"""{_STATS}, ix AS (SELECT *, row_number() OVER (ORDER BY round) - 1 AS idx FROM st),
tk AS (SELECT a.round, a.idx, b.avg_score, b.std_score, row_number() OVER (PARTITION BY a.idx ORDER BY b.avg_score DESC, b.round DESC) AS rn FROM ix a JOIN ix b ON b.idx <= a.idx),
y AS (SELECT round, idx, avg(avg_score) AS top_mean, sqrt(sum(std_score * std_score) / 9) AS top_error FROM tk WHERE rn <= 3 GROUP BY ALL),
d AS (SELECT *, top_mean - lag(top_mean) OVER (ORDER BY idx) AS delta, sqrt(top_error * top_error + pow(lag(top_error) OVER (ORDER BY idx), 2)) AS delta_error FROM y)"""


@query(f"WITH {_STATS} SELECT * FROM st")
def round_means(spark, sf):
    return _stats(spark, sf)


@query(f"WITH {_RUNNING} SELECT round, idx, round(top_mean, 6) AS top_mean, round(top_error, 6) AS top_error, round(delta, 6) AS delta, round(delta_error, 6) AS delta_error FROM d")
def round_top_k(spark, sf):
    out = RO.running_top_k(_stats(spark, sf), 3)
    return out.select("round", "idx", *[F.round(c, 6).alias(c) for c in ("top_mean", "top_error", "delta", "delta_error")])


@query(f"""WITH {_RUNNING}, f AS (SELECT idx, coalesce(abs(delta) <= 0.01 * delta_error, false) AS quiet FROM d),
c AS (SELECT idx, count(*) FILTER (quiet) OVER (ORDER BY idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n FROM f), s AS (SELECT min(idx) AS stop FROM c WHERE n = 5)
SELECT stop IS NOT NULL AND (SELECT count(*) FROM st) >= 4 AS converged, stop - 4 AS start_idx, stop AS stop_idx FROM s""")
def round_convergence(spark, sf):
    return RO.convergence(_stats(spark, sf), top_k=3, z=0.01, consecutive=5)


@query(f"""WITH {_STATS}, w AS (SELECT round, exp(0.2 * 100 * (avg_score - max(avg_score) OVER ())) AS w FROM st)
SELECT round, round(0.3 / count(*) OVER () + 0.7 * w / sum(w) OVER (), 6) AS probability FROM w""")
def round_probs(spark, sf):
    out = RO.mixed_probabilities(_stats(spark, sf), "avg_score")
    return out.select("round", F.round("probability", 6).alias("probability"))


@query(f"""WITH {_STATS} SELECT round, avg_score FROM st WHERE round = 1
UNION ALL SELECT * FROM (SELECT round, avg_score FROM st WHERE round <> 1 ORDER BY avg_score DESC, round LIMIT 4)""")
def top_rounds(spark, sf):
    return RO.top_rounds(_stats(spark, sf), 5).select("round", "avg_score")


@query("""SELECT event_id, ts, value FROM events WHERE value > 50 ORDER BY event_id DESC LIMIT 1""")
def best_round(spark, sf):
    e = load(spark, sf, "events").select("event_id", "ts", "value", (F.col("value") > 50).alias("succeed"))
    return RO.best_round(e, "event_id", "succeed").select("event_id", "ts", "value")


@query("""
WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN -1.0 ELSE value END AS dev, value / 2 AS test FROM events)
SELECT min(dev) FILTER (dev <> -1) AS best_dev_score, first(event_id ORDER BY dev, event_id) FILTER (dev <> -1) AS best_dev_score_idx,
 first(test ORDER BY dev, event_id) FILTER (dev <> -1) AS best_dev_test_score, round(avg(test), 6) AS avg_test_score, min(test) FILTER (dev <> -1) AS global_best_test_score FROM r""")
def run_summary(spark, sf):
    runs = load(spark, sf, "events").select("event_id", F.when(F.col("event_type") == "error", -1.0).otherwise(F.col("value")).alias("dev_score"), (F.col("value") / 2).alias("test_score"))
    return E.run_summary(runs, "event_id", low_is_better=True).withColumn("avg_test_score", F.round("avg_test_score", 6))


def _experience(spark, sf):
    o = load(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("parent"), F.col("o_orderkey").alias("round"), F.col("o_orderpriority").alias("modification"),
                    F.lit(150000.0).alias("before"), F.col("o_totalprice").alias("after"))


@query("SELECT o_custkey AS parent, o_orderkey AS round, CASE WHEN o_totalprice > 150000 THEN 'success' ELSE 'failure' END AS outcome, o_orderpriority AS modification, o_totalprice AS score FROM orders")
def experience_maps(spark, sf):
    return RO.experience_maps(_experience(spark, sf))


@query("SELECT o_custkey AS parent, 150000.0::DOUBLE AS score, count(*) FILTER (o_totalprice > 150000) AS successes, count(*) FILTER (o_totalprice <= 150000) AS failures FROM orders GROUP BY 1")
def experience_counts(spark, sf):
    return RO.outcome_counts(_experience(spark, sf))


@query("SELECT c_custkey AS parent, '1-URGENT' AS modification FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def experience_repeats(spark, sf):
    asked = load(spark, sf, "customer").select(F.col("c_custkey").alias("parent"), F.lit("1-URGENT").alias("modification"))
    return RO.already_tried(asked, _experience(spark, sf))


# Prices per 1000 tokens.
PRICES = [("user", 0.01, 0.03), ("assistant", 0.002, 0.004)]


@query("""
WITH u AS (SELECT conv_id, role, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n, length(text) // 10 AS c FROM conversations)
SELECT conv_id, CAST(sum(n) AS BIGINT) AS prompt_tokens, CAST(sum(c) AS BIGINT) AS completion_tokens,
 round(coalesce(sum(CASE role WHEN 'user' THEN n * 0.01 + c * 0.03 WHEN 'assistant' THEN n * 0.002 + c * 0.004 END) / 1000, 0), 9) AS total_cost FROM u WHERE n + c <> 0 GROUP BY conv_id""")
def token_cost(spark, sf):
    prices = spark.createDataFrame(PRICES, "role string, prompt_price double, completion_price double")
    usage = load(spark, sf, "conversations").select("conv_id", "role", T.word_count(F.col("text")).alias("prompt_tokens"), F.floor(F.length("text") / 10).alias("completion_tokens"))
    return E.token_costs(usage, prices, "role", ["conv_id"]).withColumn("total_cost", F.round("total_cost", 9))


CALL = "['Player1', 'Player2', 'Player3', 'Player4']. Say ONLY: I vote to eliminate ...\n"


def _logs(spark, sf):
    """One game per order: two voting rounds of four players, all inside the row."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def line(turn, p):
        role = F.when(key % 4 + 1 == p, "Werewolf").otherwise("Seer" if p == 2 else "Villager")
        target = ((cust * turn + p * p + turn) % 4 + 1).cast("string")
        return F.concat(F.lit(f"Player{p}("), role, F.lit("): 49 | I vote to eliminate Player"), target, F.lit("\n"))

    rounds = [F.concat(F.lit(CALL), *[line(t, p) for p in range(1, 5)]) for t in (1, 2)]
    return spread(load(spark, sf, "orders")).select(F.col("o_orderpriority").alias("folder"), F.concat(F.lit("game"), key.cast("string"), F.lit(".txt")).alias("file"), F.concat(*rounds).alias("log"))


@query("""
WITH b AS (SELECT o_orderpriority AS folder, 'game' || o_orderkey || '.txt' AS file, t, p, (o_orderkey % 4 + 1) AS wolf, (o_custkey * t + p * p + t) % 4 + 1 AS target FROM orders, range(1, 3) r(t), range(1, 5) q(p)),
r AS (SELECT folder, file, 'vote_' || t AS vote_round, round_even(count(*) FILTER (p <> wolf AND target = wolf) / count(*) FILTER (p <> wolf), 2) AS good_vote_rate, '_1 / 4' AS difficulty FROM b GROUP BY ALL),
v AS (SELECT folder, avg(good_vote_rate) AS v1 FROM r WHERE vote_round = 'vote_1' GROUP BY 1)
SELECT r.folder, file, vote_round, good_vote_rate, difficulty, round(avg(good_vote_rate) OVER (PARTITION BY file), 6) AS avg_rate,
 CASE WHEN vote_round = 'vote_1' THEN round(v1, 6) END AS vote1_rate FROM r JOIN v USING (folder)""")
def vote_report(spark, sf):
    out = E.vote_report(_logs(spark, sf), "folder", "file", "log")
    return out.withColumn("avg_rate", F.round("avg_rate", 6)).withColumn("vote1_rate", F.round("vote1_rate", 6))


def _tree(spark, sf):
    """Root, types, brands within types, parts; parts hold the rewards."""
    p = load(spark, sf, "part")
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("long")
    brand = F.concat_ws("/", "p_type", "p_brand")
    leaf = p.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("node"), brand.alias("parent"), F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("place"),
                    F.col("p_retailprice").alias("value"), F.when(F.col("p_size") > 5, 1).otherwise(0).cast("long").alias("visits"), F.col("p_size").alias("score"))
    brands = p.select(brand.alias("node"), F.col("p_type").alias("parent"), F.col("p_brand").alias("place")).distinct()
    types = p.select(F.col("p_type").alias("node"), F.lit("root").alias("parent"), F.col("p_type").alias("place")).distinct()
    root = p.agg(F.lit("root").alias("node"), none.alias("parent"), F.lit("").alias("place"))
    inner = [x.select("*", F.lit(0.0).alias("value"), zero.alias("visits"), F.lit(-1).alias("score")) for x in (brands, types, root)]
    return reduce(DataFrame.unionByName, inner, leaf)


_TREE = """f AS (SELECT p_partkey, p_type AS t, p_type || '/' || p_brand AS b, p_retailprice AS v, CASE WHEN p_size > 5 THEN 1 ELSE 0 END AS n, p_size FROM part),
tot AS (SELECT 'p' || p_partkey AS node, b AS parent, v AS value, n AS visits FROM f UNION ALL SELECT b, t, sum(v), sum(n) FROM f GROUP BY b, t
 UNION ALL SELECT t, 'root', sum(v), sum(n) FROM f GROUP BY t UNION ALL SELECT 'root', NULL, sum(v), sum(n) FROM f)"""


@query(f"WITH {_TREE} SELECT node, round(value, 4) AS value, CAST(visits AS BIGINT) AS visits, round(CASE WHEN visits = 0 THEN 0.0 ELSE value / visits END, 4) AS avg_value FROM tot")
def node_totals(spark, sf):
    out = G.node_totals(_tree(spark, sf).select("node", "parent", "value", "visits"))
    return out.select("node", F.round("value", 4).alias("value"), "visits", F.round("avg_value", 4).alias("avg_value"))


@query(f"""WITH {_TREE} SELECT c.node, round(c.value / CASE WHEN c.visits > 0 THEN c.visits ELSE 0.8 END + 1.4 * sqrt(ln(p.visits) / CASE WHEN c.visits > 0 THEN c.visits ELSE 0.8 END), 4) AS uct
FROM tot c JOIN tot p ON c.parent = p.node WHERE p.visits > 0""")
def node_uct(spark, sf):
    tree = _tree(spark, sf)
    scored = G.upper_confidence(G.node_totals(tree.select("node", "parent", "value", "visits")), tree)
    return scored.filter("parent_visits > 0").select("node", F.round("uct", 4).alias("uct"))


@query("SELECT 'p' || p_partkey AS node, p_size AS score FROM part ORDER BY p_size DESC, p_type, p_brand, p_partkey LIMIT 1")
def best_tree_node(spark, sf):
    return G.best_node(_tree(spark, sf).select("node", "parent", "place", "score"), "score")


@query("SELECT count(*) * 2 AS instructions, (SELECT count(*) FROM (SELECT p_type AS i FROM part UNION SELECT p_brand FROM part)) AS distinct_instructions FROM part")
def tree_instructions(spark, sf):
    nodes = load(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.array("p_type", "p_brand").alias("insights"))
    return G.distinct_instructions(nodes, "insights")


@query("""
SELECT a.vec_id AS pair_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def semantic_similarity(spark, sf):
    """Cosine of the stored vectors of a response and its reference, the next one."""
    e = load(spark, sf, "embeddings")
    response = e.select(F.col("vec_id").alias("pair_id"), F.col("embedding").alias("a"))
    reference = e.select((F.col("vec_id") - 1).alias("pair_id"), F.col("embedding").alias("b"))
    return response.join(reference, "pair_id").select("pair_id", F.round(S.cosine(F.col("a"), F.col("b")), 6).alias("similarity"))
