"""Text, HTML, JSON repair and triple-graph queries on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.functions import code as CO
from starloom.functions import html as H
from starloom.functions import scalars as S
from starloom.functions import text as T
from starloom.functions.rows import numbered_rows
from starloom.operators import graph as G
from starloom.queries import load, query
from starloom.queries.evaluation import PUNCT_SQL
from starloom.session import cut_lineage, scratch_path
from starloom.sources import sinks as SI

# a page may be cut off inside an entity: the semicolon is optional
_ENTITIES = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '&quot;?', '\"', 'g'), '&middot;?', '·', 'g'), '&copy;?', '©', 'g'), '&amp;?', '&', 'g')"


@query(f"SELECT page_id, trim({_ENTITIES.format('regexp_extract(html, ' + chr(39) + '(?s)<title>(.*?)</title>' + chr(39) + ', 1)')}) AS title FROM pages")
def html_title(spark, sf):
    return H.parsed_pages(load(spark, sf, "pages")).select("page_id", "title")


_LINKS = """l AS (SELECT page_id, unnest(range(len(hs))) AS pos, unnest(hs) AS href, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS base
 FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hs FROM pages))"""


@query(f"WITH {_LINKS} SELECT page_id, CAST(pos AS INTEGER) AS pos, base || href AS link, lower(regexp_extract(base, '^https?://(.*)$', 1)) AS host FROM l")
def html_links(spark, sf):
    return H.link_table(load(spark, sf, "pages"))


@query(f"WITH {_LINKS} SELECT lower(regexp_extract(base, '^https?://(.*)$', 1)) AS host, count(*) AS links FROM l GROUP BY 1")
def html_link_hosts(spark, sf):
    return H.link_table(load(spark, sf, "pages")).groupBy("host").agg(F.count(F.lit(1)).alias("links"))


_TEXT = """v AS (SELECT page_id, regexp_split_to_array(regexp_replace(html, '(?s)<head.*?</head>|<style.*?</style>|<script.*?</script>|<footer.*?</footer>|<!--.*?-->', '<x>', 'g'), '<[^>]*>') AS parts FROM pages),
tx AS (SELECT page_id, """ + _ENTITIES.format("array_to_string(list_transform(parts, lambda s: regexp_replace(s, '^\\s+|\\s+$', '', 'g')), '')") + " AS text FROM v)"


@query(f"WITH {_TEXT} SELECT page_id, text FROM tx")
def html_text(spark, sf):
    return H.parsed_pages(load(spark, sf, "pages")).select("page_id", "text")


@query(f"WITH {_TEXT} SELECT page_id, length(text) AS chars FROM tx WHERE NOT (trim(text) LIKE 'Fail to load page%' OR trim(text) LIKE 'Access Denied%')")
def html_valid(spark, sf):
    return H.valid_pages(H.parsed_pages(load(spark, sf, "pages"))).select("page_id", F.length("text").cast("bigint").alias("chars"))


@query()
def html_slim(spark, sf):
    return load(spark, sf, "pages").select("page_id", H.slim_html(F.col("html"), keep_links=True).alias("html"))


@query(f"""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(translate(lower(text), '{PUNCT_SQL}', ''), '\\s+'), lambda x: x NOT IN ('', 'a', 'an', 'the')), ' ') AS normalized FROM documents""")
def text_normalized(spark, sf):
    return load(spark, sf, "documents").select("doc_id", T.normalize_answer(F.col("text")).alias("normalized"))


@query("SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS tokens, sha256(text) AS fingerprint FROM documents")
def text_tokens(spark, sf):
    return load(spark, sf, "documents").select("doc_id", T.word_count(F.col("text")).cast("bigint").alias("tokens"), T.fingerprint(F.col("text")).alias("fingerprint"))


@query()
def chunk_lines(spark, sf):
    d = numbered_rows(load(spark, sf, "documents"), ["doc_id"], T.pack_lines(F.col("text"), 400, 100), "pos", "chunk")
    return d.withColumn("tokens", T.word_count(F.col("chunk")))


@query("""
WITH w AS (SELECT doc_id, text, length(text) AS n FROM documents),
s AS (SELECT doc_id, text, n, unnest(CASE WHEN n <= 500 THEN [0] ELSE range(0, least((n - 500) // 480 + 1, (n - 1) // 480) + 1) END) AS i FROM w)
SELECT doc_id, CAST(i AS INTEGER) AS pos, CASE WHEN n <= 500 THEN text ELSE substr(text, i * 480 + 1, 500) END AS piece FROM s""")
def chunk_windows(spark, sf):
    return numbered_rows(load(spark, sf, "documents"), ["doc_id"], T.char_windows(F.col("text"), 500), "pos", "piece")


@query("""
WITH p AS (SELECT doc_id, regexp_extract_all(text, '(?s)[^.]*\\.|[^.]+') AS a, regexp_extract_all(text, '(?s)[^,]*,|[^,]+') AS b, regexp_extract_all(text, '(?s).') AS c FROM documents),
x AS (SELECT doc_id, CASE WHEN len(a) > 1 THEN a WHEN len(b) > 1 THEN b ELSE c END AS xs FROM p)
SELECT doc_id, array_to_string(xs[1:(len(xs) + 1) // 2], '') AS first, array_to_string(xs[(len(xs) + 1) // 2 + 1:], '') AS second FROM x""")
def split_parts(spark, sf):
    parts = load(spark, sf, "documents").select("doc_id", T.split_paragraph(F.col("text"), 2).alias("p"))
    return parts.select("doc_id", F.element_at("p", 1).alias("first"), F.element_at("p", 2).alias("second"))


@query("""
WITH d AS (SELECT doc_id, text, split_part(text, '.', 1) AS one, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n,
 len(list_filter(regexp_split_to_array(split_part(text, '.', 1), '\\s+'), lambda x: x <> '')) AS n1 FROM documents)
SELECT doc_id, CASE WHEN n < 200 THEN 'whole' WHEN n1 < 200 THEN 'sentence' ELSE 'none' END AS kept FROM d""")
def fit_budget(spark, sf):
    """The whole text, its first sentence or nothing: the first candidate under the budget."""
    whole, one = F.col("text"), F.split_part("text", F.lit("."), F.lit(1))
    d = load(spark, sf, "documents").withColumn("fit", T.first_fitting(F.array(whole, one, F.lit("")), 200))
    kept = F.when(F.col("fit") == whole, "whole").when(F.col("fit") == one, "sentence").otherwise("none")
    return d.select("doc_id", F.when(T.word_count(whole) < 200, "whole").when(F.col("fit") != "", kept).otherwise(
        F.when(T.word_count(one) < 200, "sentence").otherwise("none")).alias("kept"))


@query("SELECT c_custkey, c_name || chr(233) || c_mktsegment AS name FROM customer")
def unicode_escapes(spark, sf):
    escaped = F.concat("c_name", F.lit("\\u00e9"), "c_mktsegment")
    return load(spark, sf, "customer").select("c_custkey", T.decode_unicode_escape(escaped).alias("name"))


@query("""SELECT conv_id, turn, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS section, CASE WHEN role = 'system' THEN NULL ELSE upper(role) END AS speaker,
 CASE WHEN role = 'system' THEN text ELSE regexp_extract(text, '^\\s*([^\\n]+)', 1) END AS said FROM conversations WHERE length(trim(text)) > 0""")
def tagged_sections(spark, sf):
    c = load(spark, sf, "conversations").filter("length(trim(text)) > 0")
    wrapped = F.concat(F.lit("noise [CONTENT]\n"), "text", F.lit("\n[/CONTENT] more [CONTENT]other[/CONTENT]"))
    marked = F.when(F.col("role") == "system", F.col("text")).otherwise(F.concat(F.lit("["), F.upper("role"), F.lit("]: "), "text"))
    return c.select("conv_id", "turn", T.tagged_section(wrapped).alias("section"), T.role_and_text(marked).alias("r")).select(
        "conv_id", "turn", "section", F.col("r.role").alias("speaker"), F.col("r.text").alias("said"))


@query("""SELECT event_id, true AS fixed, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events WHERE event_type <> 'error'
UNION ALL SELECT event_id, false, NULL FROM events WHERE event_type = 'error'""")
def json_repair(spark, sf):
    """Event properties damaged in four ways; the fifth cannot be repaired."""
    kind, p = F.col("event_type"), F.col("props")
    body = F.substr(p, F.lit(1), F.length(p) - 1)
    broken = (
        F.when(kind == "click", F.concat(F.lit("["), p)).when(kind == "view", F.concat(p, F.lit("]")))
        .when(kind == "signup", F.concat(body, F.lit("]"))).when(kind == "purchase", F.concat(body, F.lit(", \"u\": \"http://x\" # note\n} // end")))
        .otherwise(body)
    )
    e = load(spark, sf, "events").select("event_id", T.repair_json(broken).alias("j"))
    return e.select("event_id", T.is_json(F.col("j")).alias("fixed"), F.when(T.is_json(F.col("j")), F.get_json_object("j", "$.k").cast("int")).alias("k"))


@query("""SELECT event_id, '[CONTENT]' || chr(10) || props || chr(10) || '[/CONTENT]' AS repaired FROM events""")
def section_repair(spark, sf):
    """Sections with a wrong case, a missing end, a missing start or a second start instead of the end."""
    kind, p = F.col("event_type"), F.col("props")
    damaged = (
        F.when(kind == "click", F.concat(F.lit("[Content]\n"), p, F.lit("\n[/CONTENT]"))).when(kind == "view", F.concat(F.lit("[CONTENT]\n"), p))
        .when(kind == "signup", F.concat(p, F.lit("\n[/CONTENT]"))).when(kind == "purchase", F.concat(F.lit("[CONTENT]\n"), p, F.lit("\n[CONTENT]")))
        .otherwise(F.concat(F.lit("[CONTENT]\n"), p, F.lit("\n[/CONTENT]")))
    )
    return load(spark, sf, "events").select("event_id", T.repair_sections(damaged, ["[CONTENT]", "[/CONTENT]"]).alias("repaired"))


@query("SELECT event_id, 0 AS pos, props || chr(10) AS block FROM events UNION ALL SELECT event_id, 1, '[' || user_id || ']' || chr(10) FROM events")
def fenced_blocks(spark, sf):
    text = F.concat(F.lit("See:\n```json\n"), "props", F.lit("\n```\nand\n```python\nx = 1\n```\n```json\n["), F.col("user_id").cast("string"), F.lit("]\n```"))
    return numbered_rows(load(spark, sf, "events"), ["event_id"], S.fenced_blocks(text), "pos", "block")


def _sources(spark, sf):
    """One Python file per page: a class, a function and a global named after it; every tenth does not parse."""
    n = F.col("page_id").cast("string")
    body = F.concat(F.lit("import os\nLIMIT_"), n, F.lit(" = 3\nclass Page"), n, F.lit(":\n    size: int = 1\n    def read(self):\n        return 1\n    async def save(self):\n        pass\n\ndef load_"),
                    n, F.lit("(x):\n    y = x\n    return y\n"))
    return load(spark, sf, "pages").select(F.concat(F.lit("src/p"), n, F.lit(".py")).alias("file"), F.when(F.col("page_id") % 10 == 3, F.concat(body, F.lit("def broken(:\n"))).otherwise(body).alias("content"))


_FILES = "f AS (SELECT 'src/p' || page_id || '.py' AS file, page_id AS n, page_id % 10 = 3 AS bad FROM pages)"


@query(f"""WITH {_FILES} SELECT file, 'class' AS kind, 'Page' || n AS name FROM f WHERE NOT bad UNION ALL SELECT file, 'method', 'Page' || n || '.' || m FROM f, (VALUES ('read'), ('save')) v(m) WHERE NOT bad
UNION ALL SELECT file, 'function', 'load_' || n FROM f WHERE NOT bad UNION ALL SELECT file, 'global', 'LIMIT_' || n FROM f WHERE NOT bad UNION ALL SELECT file, 'error', '' FROM f WHERE bad""")
def code_symbols(spark, sf):
    s = CO.file_symbols(_sources(spark, sf))
    s = cut_lineage(s)  # parsed once for the five parts
    classes = s.select("file", F.explode("classes").alias("c"))
    parts = [classes.select("file", F.lit("class").alias("kind"), F.col("c.name").alias("name")),
             classes.select("file", F.lit("method").alias("kind"), F.explode("c.methods").alias("m"), F.col("c.name").alias("n")).select("file", "kind", F.concat_ws(".", "n", "m").alias("name")),
             s.select("file", F.lit("function").alias("kind"), F.explode("functions").alias("name")), s.select("file", F.lit("global").alias("kind"), F.explode("globals").alias("name")),
             s.filter("error is not null").select("file", F.lit("error").alias("kind"), F.lit("").alias("name"))]
    return reduce(DataFrame.unionByName, parts)


@query(f"""WITH {_FILES}, g AS (SELECT * FROM f WHERE NOT bad)
SELECT file AS subject, 'is' AS predicate, 'source_code' AS object FROM f UNION ALL SELECT file, 'is', 'python' FROM f
UNION ALL SELECT file, 'has_class', file || ':Page' || n FROM g UNION ALL SELECT file || ':Page' || n, 'is', 'class' FROM g
UNION ALL SELECT file || ':Page' || n, 'has_class_method', file || ':Page' || n || ':' || m FROM g, (VALUES ('read'), ('save')) v(m)
UNION ALL SELECT file || ':Page' || n || ':' || m, 'is', 'class_method' FROM g, (VALUES ('read'), ('save')) v(m)
UNION ALL SELECT file, 'has_function', file || ':load_' || n FROM g UNION ALL SELECT file || ':load_' || n, 'is', 'function' FROM g
UNION ALL SELECT file || ':LIMIT_' || n, 'is', 'global_variable' FROM g""")
def graph_file_triples(spark, sf):
    return G.file_triples(CO.file_symbols(_sources(spark, sf)))


def _views(spark, sf):
    """One class view per part: type and price as attributes, one method."""
    p = load(spark, sf, "part")
    name = F.concat(F.lit("src/"), F.lower("p_type"), F.lit(".js:Part"), F.col("p_partkey").cast("string"))
    return p.select(name.alias("package"), F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string")).alias("attributes"),
                    F.create_map(F.lit("price"), F.lit("double")).alias("methods"), F.array(F.concat(F.lit("Part"), F.expr("cast(p_partkey div 2 as string)"))).alias("compositions"), F.array("p_brand").alias("aggregations"))


_PKG = "v AS (SELECT 'src/' || lower(p_type) || '.js' AS file, 'src/' || lower(p_type) || '.js:Part' || p_partkey AS pkg, 'Part' || (p_partkey // 2) AS piece, p_brand, p_size FROM part)"


@query(f"""WITH {_PKG} SELECT DISTINCT file AS subject, 'is' AS predicate, 'source_code' AS object FROM v UNION ALL SELECT DISTINCT file, 'is', 'javascript' FROM v
UNION ALL SELECT file, 'has_class', pkg FROM v UNION ALL SELECT pkg, 'is', 'class' FROM v
UNION ALL SELECT pkg, 'has_class_property', pkg || ':' || a FROM v, (VALUES ('brand'), ('size')) x(a) UNION ALL SELECT pkg || ':' || a, 'is', 'class_property' FROM v, (VALUES ('brand'), ('size')) x(a)
UNION ALL SELECT pkg || ':brand', 'has_detail', p_brand FROM v UNION ALL SELECT pkg || ':size', 'has_detail', CAST(p_size AS VARCHAR) FROM v
UNION ALL SELECT pkg, 'has_class_method', pkg || ':price' FROM v UNION ALL SELECT pkg || ':price', 'is', 'class_method' FROM v UNION ALL SELECT pkg || ':price', 'has_detail', 'double' FROM v
UNION ALL SELECT pkg, 'isCompositeOf', '?:' || piece FROM v UNION ALL SELECT pkg, 'isAggregateOf', '?:' || p_brand FROM v
UNION ALL SELECT pkg, 'has_detail', '{{"package":"' || pkg || '","attributes":{{"brand":"' || p_brand || '","size":"' || p_size || '"}},"methods":{{"price":"double"}},"compositions":["' || piece || '"],"aggregations":["' || p_brand || '"]}}' FROM v""")
def graph_class_triples(spark, sf):
    return G.class_triples(_views(spark, sf))


@query(f"""WITH {_PKG}, w AS (SELECT DISTINCT pkg, split_part(pkg, ':', 2) AS short FROM v)
SELECT v.pkg AS subject, 'isCompositeOf' AS predicate, w.pkg AS object FROM v JOIN w ON w.short = v.piece""")
def graph_compositions(spark, sf):
    """The classes that each class is composed of, by their whole names."""
    t = G.resolve_names(G.class_triples(_views(spark, sf)))
    return G.select(t, predicate=G.IS_COMPOSITE_OF).select("subject", "predicate", "object")


@query(f"""WITH {_PKG} SELECT pkg || ':' || a AS object, pkg AS subject, CASE a WHEN 'price' THEN 'has_class_method' ELSE 'has_class_property' END AS predicate,
 CASE a WHEN 'brand' THEN p_brand WHEN 'size' THEN CAST(p_size AS VARCHAR) ELSE 'double' END AS detail FROM v, (VALUES ('brand'), ('size'), ('price')) x(a) WHERE pkg IN (SELECT max(pkg) FROM v)""")
def graph_class_view(spark, sf):
    views = _views(spark, sf)
    name = views.agg(F.max("package")).first()[0]
    return G.class_view(G.class_triples(views), name).select("subject", "predicate", "object", "detail")


_REL = """r AS (SELECT 'n' || n_nationkey AS src, 'Composite' AS relationship, 'r' || n_regionkey AS dest, nullif('', '') AS label FROM nation
 UNION ALL SELECT 'c' || c_custkey, 'Aggregate', 'n' || c_nationkey, nullif(c_mktsegment, 'BUILDING') FROM customer)"""


@query(f"WITH {_REL} SELECT src AS subject, 'is' || relationship || 'Of' AS predicate, dest AS object FROM r UNION ALL SELECT src, 'is' || relationship || 'On', dest || ':' || label FROM r WHERE label IS NOT NULL")
def graph_relations(spark, sf):
    n, c = load(spark, sf, "nation"), load(spark, sf, "customer")

    def name(p, k):
        return F.concat(F.lit(p), F.col(k).cast("string"))

    rel = n.select(name("n", "n_nationkey").alias("src"), F.lit("Composite").alias("relationship"), name("r", "n_regionkey").alias("dest"), F.lit(None).cast("string").alias("label")).unionByName(
        c.select(name("c", "c_custkey").alias("src"), F.lit("Aggregate").alias("relationship"), name("n", "c_nationkey").alias("dest"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("label")))
    return G.relation_triples(rel)


def _event_triples(spark, sf):
    """Users act on objects; a later event between the same two overwrites the earlier one."""
    e = load(spark, sf, "events")
    return e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("subject"), F.col("event_type").alias("predicate"),
                    F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("object"), F.col("event_id").alias("seq"))


_TRIPLES = "t AS (SELECT 'u' || user_id AS subject, event_type AS predicate, 'k' || json_extract_string(props, '$.k') AS object, event_id AS seq FROM events), le AS (SELECT subject, arg_max(predicate, seq) AS predicate, object, max(seq) AS seq FROM t GROUP BY subject, object)"


@query(f"WITH {_TRIPLES} SELECT subject, predicate, object, seq FROM le")
def graph_last_edge(spark, sf):
    folder = scratch_path(spark, "triples")
    SI.save_triples(G.last_edges(_event_triples(spark, sf)), folder)
    return SI.load_triples(spark, folder)


@query(f"WITH {_TRIPLES} SELECT subject, predicate, object, seq FROM le WHERE predicate = 'purchase' AND object = 'k7'")
def graph_select(spark, sf):
    return G.select(G.last_edges(_event_triples(spark, sf)), predicate="purchase", object_="k7")


@query(f"WITH {_TRIPLES} SELECT subject, count(*) AS edges, (SELECT count(*) FROM le WHERE predicate = 'error') AS deleted FROM le WHERE predicate <> 'error' GROUP BY subject")
def graph_delete(spark, sf):
    rest, deleted = G.delete(G.last_edges(_event_triples(spark, sf)), predicate="error")
    return rest.groupBy("subject").agg(F.count(F.lit(1)).alias("edges")).withColumn("deleted", F.lit(deleted).cast("bigint"))


@query("""SELECT 'u' || user_id AS subject, event_type AS predicate, 'k' || json_extract_string(props, '$.k') AS object, count(*) AS links FROM events GROUP BY ALL""")
def graph_from_links(spark, sf):
    """Node-link JSON, one document per event, read back into triples."""
    t = _event_triples(spark, sf)
    doc = F.to_json(F.struct(F.array(F.struct(F.col("subject").alias("source"), F.col("object").alias("target"), "predicate")).alias("links")))
    return SI.triples_from_links(t.select(doc.alias("doc")), "doc").groupBy("subject", "predicate", "object").agg(F.count(F.lit(1)).alias("links"))


@query("""
WITH c AS (SELECT 'lib' || p_brand || ':' || p_name AS cls, p_name AS short FROM part GROUP BY ALL), u AS (SELECT short, min(cls) AS cls FROM c GROUP BY short HAVING count(*) = 1),
w AS (SELECT DISTINCT p_type AS subject, p_name FROM part)
SELECT cls AS subject, 'is' AS predicate, 'class' AS object FROM c
UNION ALL SELECT w.subject, 'isCompositeOf', coalesce(u.cls, '?:' || p_name) FROM w LEFT JOIN u ON u.short = w.p_name""")
def graph_resolve(spark, sf):
    p = load(spark, sf, "part")
    classes = p.select(F.concat(F.lit("lib"), "p_brand", F.lit(":"), "p_name").alias("subject"), F.lit(G.IS).alias("predicate"), F.lit("class").alias("object")).distinct()
    uses = p.select(F.col("p_type").alias("subject"), F.lit(G.IS_COMPOSITE_OF).alias("predicate"), F.concat(F.lit("?:"), "p_name").alias("object")).distinct()
    return G.resolve_names(classes.unionByName(uses))


@query("""
SELECT 'r' || r_regionkey AS node, 0 AS depth FROM region WHERE r_name < 'ASIA' UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name < 'ASIA'
UNION ALL SELECT 'c' || c_custkey, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name < 'ASIA'
UNION ALL SELECT 'o' || o_orderkey, 3 FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name < 'ASIA'""")
def graph_reach(spark, sf):
    from starloom.queries.quality_files import _plan

    _, edges = _plan(spark, sf)
    sources = load(spark, sf, "region").filter("r_name < 'ASIA'").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"))
    return G.reachable(edges, sources)
