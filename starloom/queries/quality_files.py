"""Data-quality checks, catalog, file loads and model runs on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starloom.functions import scalars as S
from starloom.functions import text as T
from starloom.operators import graph as G
from starloom.operators import quality as Q
from starloom.plans.models import ModelSet
from starloom.queries import load, query
from starloom.session import scratch_path
from starloom.sources import catalog as C
from starloom.sources import files as FI
from starloom.sources import sinks as SI

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
KEYS = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey", "lineitem": "l_orderkey", "events": "event_id"}
LINKS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
         ("lineitem", "l_partkey", "part", "p_partkey"), ("customer", "c_nationkey", "nation", "n_nationkey")]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# keys and references equal to 7 are blanked on both sides, so that nulls occur
def _holed(df, column):
    return df.withColumn(column, F.nullif(F.col(column), F.lit(7)))


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS key_column, count(*) - count(DISTINCT nullif({k}, 7)) AS duplicate_count, "
    f"count(*) - count(nullif({k}, 7)) AS null_count, count(*) = count(DISTINCT nullif({k}, 7)) AS is_unique FROM {t}" for t, k in KEYS.items()))
def dq_pk(spark, sf):
    return _union([Q.key_uniqueness(_holed(load(spark, sf, t), k), t, k) for t, k in KEYS.items()])


@query(" UNION ALL ".join(
    f"SELECT '{f}.{a}' AS reference, count(*) AS orphan_count, count(*) = 0 AS is_valid FROM (SELECT nullif({a}, 7) AS fk FROM {f}) x "
    f"LEFT JOIN {d} ON x.fk = {d}.{p} WHERE {d}.{p} IS NULL" for f, a, d, p in LINKS))
def dq_fk(spark, sf):
    return _union([Q.orphan_count(_holed(load(spark, sf, f), a), a, load(spark, sf, d), p, f"{f}.{a}") for f, a, d, p in LINKS])


@query(" UNION ALL ".join(
    f"SELECT 'customer' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS failures FROM "
    "(SELECT c_custkey, c_nationkey, nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment FROM customer)" for c in ("c_custkey", "c_nationkey", "c_mktsegment")))
def dq_not_null(spark, sf):
    c = load(spark, sf, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    return Q.not_null_failures(c, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{k}' AS column_name, count(*) AS failures FROM "
    f"(SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)" for t, k in [*KEYS.items(), ("documents", "text")]))
def dq_unique(spark, sf):
    return _union([Q.unique_failures(load(spark, sf, t), t, k) for t, k in [*KEYS.items(), ("documents", "text")]])


_SPEC = {"customer": {"c_custkey": "integer", "c_acctbal": "decimal", "c_phone": "string"},
         "orders": {"o_orderdate": "date", "o_totalprice": "string"}, "invoice": {"i_key": "integer"}}
_TYPE_SQL = """CASE WHEN data_type IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') THEN 'integer' WHEN data_type IN ('FLOAT', 'DOUBLE') THEN 'decimal'
 WHEN data_type = 'DATE' OR data_type LIKE 'TIMESTAMP%' THEN 'date' WHEN data_type = 'VARCHAR' THEN 'string' ELSE lower(data_type) END"""


@query("WITH spec(table_name, column_name, declared) AS (VALUES " + ", ".join(
    f"('{t}', '{c}', '{k}')" for t, cols in _SPEC.items() for c, k in cols.items()) + f""")
SELECT s.table_name, s.column_name, s.declared, CASE WHEN s.table_name NOT IN (SELECT table_name FROM information_schema.columns) THEN 'missing table'
 WHEN i.column_name IS NULL THEN 'missing column' WHEN {_TYPE_SQL} = s.declared THEN 'ok' ELSE 'wrong type' END AS status
FROM spec s LEFT JOIN information_schema.columns i ON i.table_name = s.table_name AND i.column_name = s.column_name""")
def dq_schema(spark, sf):
    return Q.conformance(spark, {t: load(spark, sf, t) for t in TABLES}, _SPEC)


def _report(spark, sf):
    pk = dq_pk(spark, sf).select(F.lit("structure").alias("phase"), F.concat_ws(".", "table_name", "key_column").alias("item"),
                                 F.lit("pk_unique").alias("check_name"), F.when(F.col("is_unique"), "PASS").otherwise("FAIL").alias("status"),
                                 F.concat(F.lit("duplicates "), F.col("duplicate_count").cast("string")).alias("details"))
    fk = dq_fk(spark, sf).select(F.lit("structure").alias("phase"), F.col("reference").alias("item"), F.lit("fk_valid").alias("check_name"),
                                 F.when(F.col("is_valid"), "PASS").otherwise("FAIL").alias("status"),
                                 F.concat(F.lit("orphans "), F.col("orphan_count").cast("string")).alias("details"))
    filled = _union([load(spark, sf, t).limit(1).agg(
        F.lit("existence").alias("phase"), F.lit(t).alias("item"), F.lit("has_rows").alias("check_name"),
        F.when(F.count(F.lit(1)) > 0, "PASS").otherwise("FAIL").alias("status"), F.lit("").alias("details")) for t in TABLES])
    return Q.report([pk, fk, filled])


_REPORT_SQL = " UNION ALL ".join(
    [f"SELECT 'structure' AS phase, '{t}.{k}' AS item, 'pk_unique' AS check_name, CASE WHEN count(*) = count(DISTINCT nullif({k}, 7)) THEN 'PASS' ELSE 'FAIL' END AS status, "
     f"'duplicates ' || (count(*) - count(DISTINCT nullif({k}, 7))) AS details FROM {t}" for t, k in KEYS.items()]
    + [f"SELECT 'structure', '{f}.{a}', 'fk_valid', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END, 'orphans ' || count(*) FROM "
       f"(SELECT nullif({a}, 7) AS fk FROM {f}) x LEFT JOIN {d} ON x.fk = {d}.{p} WHERE {d}.{p} IS NULL" for f, a, d, p in LINKS]
    + [f"SELECT 'existence', '{t}', 'has_rows', CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL' END, '' FROM (SELECT 1 FROM {t} LIMIT 1)" for t in TABLES])


@query(_REPORT_SQL)
def dq_report(spark, sf):
    return _report(spark, sf)


@query(f"""SELECT count(*) AS checks, count(*) FILTER (status <> 'PASS') AS failed,
 CASE WHEN count(*) FILTER (status <> 'PASS') = 0 AND count(*) > 0 THEN 'ACCEPTED' ELSE 'REJECTED' END AS verdict FROM ({_REPORT_SQL})""")
def dq_verdict(spark, sf):
    return Q.verdict(_report(spark, sf))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, (SELECT count(*) FROM information_schema.columns "
                          f"WHERE table_name = '{t}') AS column_count FROM {t}" for t in TABLES))
def table_inventory(spark, sf):
    return C.inventory({t: load(spark, sf, t) for t in TABLES})


@query("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS dtype, count(*) AS row_count, count(*) - count({e}) AS null_count FROM events"
    for c, k, e in [("event_id", "bigint", "event_id"), ("event_type", "string", "nullif(event_type, 'error')"), ("value", "double", "value"),
                    ("k", "int", "json_extract(props, '$.k')"), ("nothing", "string", "nullif(1, 1)")]) + ") WHERE null_count < row_count")
def profile_columns(spark, sf):
    e = load(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"), F.lit(None).cast("string").alias("nothing"))
    return FI.profile(e)


@query("""
WITH t AS (SELECT o_orderkey, '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || ',000' AS money,
 CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%d/%m/%Y %H:%M') WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE 'n/a' END AS stamp FROM orders)
SELECT o_orderkey, TRY_CAST(regexp_replace(money, '[$,]', '', 'g') AS DOUBLE) AS amount,
 coalesce(TRY_CAST(stamp AS TIMESTAMP), try_strptime(stamp, '%d/%m/%Y %H:%M')) AS event_time FROM t
WHERE coalesce(TRY_CAST(stamp AS TIMESTAMP), try_strptime(stamp, '%d/%m/%Y %H:%M')) IS NOT NULL""")
def clean_currency_ts(spark, sf):
    d = F.col("o_orderdate")
    raw = load(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("$"), F.floor("o_totalprice").cast("string"), F.lit(",000")).alias("money"),
        F.when(F.col("o_orderstatus") == "F", F.date_format(d, "dd/MM/yyyy HH:mm")).when(
            F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise("n/a").alias("stamp"))
    return raw.select("o_orderkey", S.clean_money(F.col("money")).alias("amount"),
                      S.parse_timestamp(F.col("stamp"), ["dd/MM/yyyy HH:mm"]).alias("event_time")).filter("event_time is not null")


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf):
    """Customers written with semicolons, sniffed, loaded into a table and read back."""
    folder = scratch_path(spark, "roundtrip") + ".csv"
    load(spark, sf, "customer").write.option("header", True).option("sep", ";").csv(folder)
    table = "customer_load_" + folder[-12:-4]
    SI.load_file(spark, folder, table, location=scratch_path(spark, "table"))
    return spark.table(table).select(F.col("c_custkey").cast("bigint"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("""
SELECT column_name, dtype, row_count FROM (SELECT count(*) AS row_count FROM customer),
 (VALUES ('c_custkey', 'int'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'), ('c_mktsegment', 'string')) t(column_name, dtype)""")
def file_inference(spark, sf):
    """Types and rows of a file, without loading it into a table."""
    folder = scratch_path(spark, "inferred") + ".csv"
    load(spark, sf, "customer").write.option("header", True).option("sep", "|").csv(folder)
    rows = [(name, kind, FI.file_rows(spark, folder)) for name, kind in FI.file_schema(spark, folder)]
    return spark.createDataFrame(rows, "column_name string, dtype string, row_count bigint")


@query("""
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)
SELECT substr(line, i * 256 + 1, 256) AS content, count(*) AS times FROM (SELECT line, unnest(range(0, (length(line) - 1) // 256 + 1)) AS i FROM l WHERE trim(line) <> '') GROUP BY ALL""")
def text_files_indexed(spark, sf):
    """Text files as rows of at most 256 characters of a line, ready for an index."""
    folder = scratch_path(spark, "texts") + ".txt"
    load(spark, sf, "benchmark").select("text").write.text(folder)
    return FI.indexable(spark, folder).groupBy("content").agg(F.count(F.lit(1)).alias("times"))


@query("""SELECT o_orderstatus, count(*) AS orders, count(DISTINCT c_nationkey) AS nations FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderstatus""")
def adhoc_query(spark, sf):
    """SQL over frames given by name."""
    sql = "SELECT o_orderstatus, count(*) AS orders, count(DISTINCT c_nationkey) AS nations FROM {o} JOIN {c} ON o_custkey = c_custkey GROUP BY o_orderstatus"
    return C.run_query(spark, sql, o=load(spark, sf, "orders"), c=load(spark, sf, "customer"))


@query("""
SELECT position, column_name, dtype, true AS listed, false AS filled FROM
 (VALUES (1, 'n_nationkey', 'int'), (2, 'n_name', 'string'), (3, 'n_regionkey', 'int')) t(position, column_name, dtype) WHERE (SELECT count(*) FROM nation) > 0""")
def staging_table(spark, sf):
    """An empty table with a file's columns: listed, verified and described by the catalog."""
    table = "staging_" + scratch_path(spark, "x")[-8:]
    SI.staging_shell(load(spark, sf, "nation"), table, scratch_path(spark, "staging"))
    listed = C.verify_table(spark, table) and f"default.{table}" in C.list_tables(spark)
    filled = not spark.table(table).isEmpty()
    return C.table_schema(spark, table).withColumns({"listed": F.lit(listed), "filled": F.lit(filled)})


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0 ELSE 1 / (1 + value) END AS score FROM events")
def score_normalised(spark, sf):
    """Lower-is-better values as shares of one; the failure mark is zero."""
    raw = F.when(F.col("event_type") == "error", F.lit(-1.0)).otherwise(F.col("value"))
    return load(spark, sf, "events").select("event_id", S.normalised_score(raw).alias("score"))


@query("SELECT l_returnflag, 2 * count(*) AS row_count, round(2 * sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY l_returnflag")
def csv_append(spark, sf):
    """The same file appended twice: its rows are there twice."""
    folder = scratch_path(spark, "append") + ".csv"
    load(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag").write.option("header", True).csv(folder)
    table, place = "lineitem_append_" + folder[-12:-4], scratch_path(spark, "table")
    for _ in range(2):
        SI.append_file(spark, folder, table, sep=",", location=place)
    return spark.table(table).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("row_count"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("""
SELECT l.line_no, d.doc_id, d.lang FROM (SELECT doc_id AS line_no, quality FROM labels) l
JOIN (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line_no, doc_id, lang FROM documents) d USING (line_no)""")
def jsonl_subset(spark, sf):
    """Lines of a JSON-lines copy of the documents whose index is listed in the labels."""
    folder = scratch_path(spark, "jsonl")
    load(spark, sf, "documents").select("doc_id", "lang").repartitionByRange("doc_id").sortWithinPartitions("doc_id").write.json(folder)
    wanted = load(spark, sf, "labels").select(F.col("doc_id").alias("line_no"))
    return FI.json_lines_subset(spark, folder, "doc_id bigint, lang string", wanted)


@query("""
WITH f AS (SELECT CASE lang WHEN 'en' THEN 'docs' WHEN 'fr' THEN 'codes' WHEN 'de' THEN 'assets' END AS category, length(text) AS n FROM documents)
SELECT category, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_chars FROM f GROUP BY category
UNION ALL SELECT 'total', count(*), CAST(sum(n) AS BIGINT) FROM f""")
def corpus_stats(spark, sf):
    suffix = F.when(F.col("lang") == "en", "md").when(F.col("lang") == "fr", "py").when(F.col("lang") == "de", "json").otherwise("bin")
    files = load(spark, sf, "documents").select(F.concat_ws(".", F.concat_ws("/", "source", F.col("doc_id").cast("string")), suffix).alias("path"),
                                                F.col("text").alias("content"))
    return FI.corpus_stats(files.withColumn("category", FI.file_category(F.col("path"))))


@query("""
SELECT event_id AS exp_id, event_type AS req, CAST(floor(value) AS BIGINT) AS score FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, 'rejected', count(*) FROM events WHERE event_type = 'error'""")
def log_to_rows(spark, sf):
    """Experiences parsed from a log written from the events; lines with broken JSON are counted apart."""
    e = load(spark, sf, "events")
    body = F.to_json(F.struct(F.col("event_id").alias("exp_id"), F.col("event_type").alias("req"), F.floor("value").alias("score")))
    broken = F.when(F.col("event_type") == "error", F.concat(body, F.lit("{"))).otherwise(body)
    folder = scratch_path(spark, "log")
    e.select(F.concat(F.lit("2024-01-01 | DEBUG | "), F.lit(FI.EXPERIENCE_PREFIX), broken).alias("value")).union(
        e.select(F.concat(F.lit("INFO other line "), F.col("event_id").cast("string")))).write.text(folder)
    good, rejected = FI.experiences_from_log(spark.read.text(folder), "exp_id bigint, req string, score bigint")
    counted = rejected.agg(F.lit(None).cast("bigint").alias("exp_id"), F.lit("rejected").alias("req"), F.count(F.lit(1)).alias("score"))
    return good.unionByName(counted)


@query("""
SELECT 'customer' AS stream, 'succeeded' AS status, count(*) AS rows_synced FROM customer
UNION ALL SELECT 'orders', 'succeeded', count(*) FROM orders UNION ALL SELECT 'part', 'succeeded', count(*) FROM part
UNION ALL SELECT 'supplier', CASE WHEN count(*) FILTER (s_acctbal < 0) > 0 THEN 'failed' ELSE 'succeeded' END, CASE WHEN count(*) FILTER (s_acctbal < 0) > 0 THEN 0 ELSE count(*) END FROM supplier""")
def sync_status(spark, sf):
    """Four streams; one refuses rows that break its rule, and the others go on."""
    streams = {t: load(spark, sf, t) for t in ("customer", "orders", "part")}
    owing = F.when(F.col("s_acctbal") < 0, F.raise_error(F.lit("a balance is negative"))).otherwise(F.col("s_acctbal"))
    streams["supplier"] = load(spark, sf, "supplier").withColumn("s_acctbal", owing)
    folder = scratch_path(spark, "sync")
    SI.sync_streams(streams, folder, ["customer", "part"])  # a full refresh replaces, it does not add
    return SI.sync_streams(streams, folder, ["customer", "orders", "part", "supplier"])


@query("""
SELECT round(avg(value / 1000), 6) AS avg_score, round(max(event_id) / 100.0 / count(*), 6) AS avg_cost, round(max(event_id) / 100.0, 6) AS total_cost FROM events""")
def results_sink(spark, sf):
    rows = load(spark, sf, "events").select((F.col("value") / 1000).alias("score"), (F.col("event_id") / 100.0).alias("cost"))
    summary = SI.save_results(rows, scratch_path(spark, "results"))
    return summary.select(*[F.round(c, 6).alias(c) for c in summary.columns])


@query("""SELECT lang, count(*) AS mismatches FROM documents JOIN labels USING (doc_id) WHERE quality < 1 GROUP BY lang""")
def mismatch_sink(spark, sf):
    rows = load(spark, sf, "documents").select("doc_id", "lang").join(load(spark, sf, "labels"), "doc_id").withColumnRenamed("quality", "score")
    folder = scratch_path(spark, "mismatch")
    SI.log_mismatches(rows, folder, 1.0)
    return spark.read.schema("lang string").json(folder).groupBy("lang").agg(F.count(F.lit(1)).alias("mismatches"))


@query("""SELECT event_type AS stream, 'k' AS field, 'integer' AS type, count(*) AS documents FROM events GROUP BY event_type
UNION ALL SELECT event_type, 'name', 'string', count(*) FROM events GROUP BY event_type""")
def stream_catalog(spark, sf):
    """Columns of one catalog document per event; nullable unions reduce to their type."""
    doc = F.concat(F.lit('{"streams": [{"name": "'), F.col("event_type"), F.lit(
        '", "json_schema": {"properties": {"k": {"type": "integer"}, "name": {"type": ["null", "string"]}}}}]}'))
    columns = FI.stream_columns(load(spark, sf, "events").select(doc.alias("doc")), "doc")
    return columns.groupBy("stream", "field", "type").agg(F.count(F.lit(1)).alias("documents"))


@query("""
SELECT event_type AS sheet, c AS column_name, count(*) AS row_count, count(*) FILTER (v IS NULL) AS null_count,
 CASE WHEN count(v) = 0 THEN 'null' WHEN count(*) FILTER (v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL) = 0 THEN 'double' ELSE 'string' END AS dtype
FROM (SELECT event_type, 'value' AS c, CAST(nullif(value, 1.5) AS VARCHAR) AS v FROM events
 UNION ALL SELECT event_type, 'props', nullif(props, '{"k": 1}') FROM events) GROUP BY ALL""")
def workbook_profile(spark, sf):
    """Profile of long-form cells, one sheet per event type."""
    e = load(spark, sf, "events")
    cells = F.explode(F.array(
        F.struct(F.lit("value").alias("column_name"), F.lit(0).alias("position"), F.nullif("value", F.lit(1.5)).cast("string").alias("value")),
        F.struct(F.lit("props").alias("column_name"), F.lit(1).alias("position"), F.nullif("props", F.lit('{"k": 1}')).alias("value"))))
    rows = e.select(F.lit("events").alias("file"), F.col("event_type").alias("sheet"), cells.alias("c")).select("file", "sheet", "c.*")
    return FI.profile_cells(rows).select("sheet", "column_name", "row_count", "null_count", "dtype")


def _plan(spark, sf):
    """Tasks: each region, its nations, their customers, their orders; every task needs the one above."""
    r, n, c, o = (load(spark, sf, t) for t in ("region", "nation", "customer", "orders"))

    def node(prefix, column):
        return F.concat(F.lit(prefix), F.col(column).cast("string"))

    nodes = _union([d.select(node(p, k).alias("node")) for d, p, k in (
        (r, "r", "r_regionkey"), (n, "n", "n_nationkey"), (c, "c", "c_custkey"), (o, "o", "o_orderkey"))])
    edges = _union([d.select(node(p, a).alias("src"), node(q, b).alias("dst")) for d, p, a, q, b in (
        (n, "r", "n_regionkey", "n", "n_nationkey"), (c, "n", "c_nationkey", "c", "c_custkey"), (o, "c", "o_custkey", "o", "o_orderkey"))])
    return nodes, edges


@query("""
SELECT 'r' || r_regionkey AS node, 0 AS level FROM region UNION ALL SELECT 'n' || n_nationkey, 1 FROM nation
UNION ALL SELECT 'c' || c_custkey, 2 FROM customer UNION ALL SELECT 'o' || o_orderkey, 3 FROM orders""")
def model_levels(spark, sf):
    return G.dependency_levels(*_plan(spark, sf))


@query("""
WITH t AS (SELECT o_orderkey AS id, nullif(o_orderstatus, 'P') AS instruction,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'DATA_INGESTION' WHEN '5-LOW' THEN 'CREDENTIAL_REQUEST' WHEN '2-HIGH' THEN 'CLEANUP' ELSE 'TRANSFORMATION' END AS task_type,
 CASE WHEN o_totalprice < 50000 THEN '' ELSE 'loader' END AS tool FROM orders),
p AS (SELECT id, 'missing instruction' AS problem FROM t WHERE instruction IS NULL
 UNION ALL SELECT id, 'unknown task type' FROM t WHERE task_type = 'CLEANUP'
 UNION ALL SELECT id, 'missing tool' FROM t WHERE task_type <> 'CREDENTIAL_REQUEST' AND tool = ''
 UNION ALL SELECT id, 'unknown dependency 0' || id - 1 FROM t WHERE id > 0 AND id - 1 NOT IN (SELECT id FROM t)
 UNION ALL SELECT id, 'unknown dependency -1' FROM t WHERE id = 0)
SELECT CAST(id AS VARCHAR) AS task_id, problem FROM p""")
def plan_checks(spark, sf):
    o = load(spark, sf, "orders")
    kind = F.col("o_orderpriority")
    plan = o.select(
        F.col("o_orderkey").cast("string").alias("task_id"), F.array((F.col("o_orderkey") - 1).cast("string")).alias("dependent_task_ids"),
        F.nullif("o_orderstatus", F.lit("P")).alias("instruction"),
        F.when(kind == "1-URGENT", "DATA_INGESTION").when(kind == "5-LOW", "CREDENTIAL_REQUEST").when(kind == "2-HIGH", "CLEANUP").otherwise(
            "TRANSFORMATION").alias("task_type"),
        F.when(F.col("o_totalprice") < 50000, "").otherwise("loader").alias("tool"))
    return Q.plan_errors(plan)


def warehouse_models(spark, sf) -> ModelSet:
    """A small star schema as models: staging, two dimensions, a fact and a KPI."""
    models = ModelSet(spark, {t: load(spark, sf, t) for t in ("customer", "orders", "nation")}, scratch_path(spark, "models"))
    models.sql_model("stg_orders", "SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM {orders}", ("orders",), not_null=("o_orderkey",))
    models.sql_model("dim_customer", "SELECT c_custkey, c_mktsegment, n_name FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey",
                     ("customer", "nation"), unique=("c_custkey",), not_null=("c_custkey", "n_name"))
    models.sql_model("fact_orders", "SELECT o.*, c.n_name, c.c_mktsegment FROM {stg_orders} o LEFT JOIN {dim_customer} c ON o.o_custkey = c.c_custkey",
                     ("stg_orders", "dim_customer"), materialized="table", unique=("o_orderkey", "o_custkey"))

    @models.model("kpi_revenue", refs=("fact_orders",))
    def kpi_revenue(ref):
        return ref("fact_orders").groupBy("n_name").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))

    return models


@query("SELECT n_name, round(sum(o_totalprice), 2) AS revenue FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def model_run(spark, sf):
    models = warehouse_models(spark, sf)
    models.run("+kpi_revenue")
    return models.ref("kpi_revenue")


@query("""
SELECT 'dim_customer' AS table_name, 'c_custkey' AS column_name, 'unique' AS test, 0 AS failures, 'pass' AS status
UNION ALL SELECT 'dim_customer', 'c_custkey', 'not_null', 0, 'pass' UNION ALL SELECT 'dim_customer', 'n_name', 'not_null', 0, 'pass'
UNION ALL SELECT 'stg_orders', 'o_orderkey', 'not_null', 0, 'pass' UNION ALL SELECT 'fact_orders', 'o_orderkey', 'unique', 0, 'pass'
UNION ALL SELECT 'fact_orders', 'o_custkey', 'unique', (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)), 'fail'""")
def model_tests(spark, sf):
    models = warehouse_models(spark, sf)
    models.run()
    return models.test().select("table_name", "column_name", "test", F.col("failures").cast("bigint"), "status")


@query("""
SELECT doc_id, CASE WHEN n_words NOT BETWEEN 100 AND 100000 THEN 'not-indexable' WHEN old IS NULL THEN 'new' WHEN old <> fp THEN 'changed' ELSE 'unchanged' END AS state, fp AS fingerprint
FROM (SELECT d.doc_id, sha256(d.text) AS fp, len(list_filter(regexp_split_to_array(d.text, '\\s+'), lambda x: x <> '')) AS n_words,
 CASE WHEN l.quality IS NULL THEN NULL WHEN l.quality = 1 THEN sha256(d.text) ELSE sha256(d.text || '!') END AS old
 FROM documents d LEFT JOIN labels l USING (doc_id))""")
def fingerprint_diff(spark, sf):
    from starloom.operators.retrieval import change_state

    d, labels = load(spark, sf, "documents").select("doc_id", "text"), load(spark, sf, "labels")
    stored = d.join(labels, "doc_id").select("doc_id", F.when(F.col("quality") == 1, T.fingerprint(F.col("text"))).otherwise(
        T.fingerprint(F.concat("text", F.lit("!")))).alias("fingerprint"))
    return change_state(d, stored, "doc_id", "text", T.word_count(F.col("text")), 100, 100_000).select("doc_id", "state", "fingerprint")


_NEEDS = [
    {"item": "revenue by segment", "kind": "kpi", "tables": ["orders", "customer"], "columns": ["orders.o_totalprice", "customer.c_mktsegment"], "links": [("orders", "customer")]},
    {"item": "margin by part", "kind": "kpi", "tables": ["lineitem", "part"], "columns": ["lineitem.l_cost"], "links": [("lineitem", "part")]},
    {"item": "who buys what", "kind": "question", "tables": ["customer", "lineitem"], "columns": [], "links": [("customer", "part")]},
    {"item": "events feed", "kind": "source", "tables": ["events"], "columns": [], "links": []},
    {"item": "returns feed", "kind": "source", "tables": ["returns"], "columns": [], "links": []},
]


@query("""
WITH links AS (SELECT 'orders' AS a, 'customer' AS b, (SELECT count(*) FROM orders ANTI JOIN customer ON o_custkey = c_custkey) AS lost
 UNION ALL SELECT 'lineitem', 'part', (SELECT count(*) FROM lineitem ANTI JOIN part ON l_partkey = p_partkey)),
ok AS (SELECT * FROM links WHERE lost = 0)
SELECT 'revenue by segment' AS item, 'kpi' AS kind, CASE WHEN (SELECT count(*) FROM ok WHERE a = 'orders') = 1 THEN 'COMPUTABLE' ELSE 'NOT COMPUTABLE' END AS status,
 CASE WHEN (SELECT count(*) FROM ok WHERE a = 'orders') = 1 THEN '' ELSE 'orders->customer' END AS detail
UNION ALL SELECT 'margin by part', 'kpi', 'NOT COMPUTABLE', 'lineitem.l_cost' || CASE WHEN (SELECT count(*) FROM ok WHERE a = 'lineitem') = 1 THEN '' ELSE ', lineitem->part' END
UNION ALL SELECT 'who buys what', 'question', 'NOT SUPPORTED', 'customer->part' UNION ALL SELECT 'events feed', 'source', 'INGESTED', ''
UNION ALL SELECT 'returns feed', 'source', 'NOT INGESTED', 'returns'""")
def dq_needs(spark, sf):
    """Declared questions, KPIs and sources against the tables and the references that hold."""
    tables = {t: load(spark, sf, t) for t in TABLES}
    checks = _union([Q.orphan_count(tables[f], a, tables[d], p, f"{f}>{d}") for f, a, d, p in LINKS if f in ("orders", "lineitem") and d != "orders"])
    holding = {tuple(r.reference.split(">")) for r in checks.filter("is_valid").collect()}
    rows = Q.needs_met({t: df.schema for t, df in tables.items()}, holding, _NEEDS)
    return spark.createDataFrame(rows, "item string, kind string, status string, detail string")


@query("SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day FROM orders UNION ALL SELECT l_orderkey, CAST(l_shipdate AS DATE) FROM lineitem")
def union_all_rows(spark, sf):
    o = load(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"))
    return o.unionByName(load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_shipdate").cast("date").alias("day")))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey LIMIT 100")
def ordered_top(spark, sf):
    rows = load(spark, sf, "lineitem").orderBy(F.col("l_extendedprice").desc_nulls_last(), "l_orderkey", "l_linenumber", "l_partkey")
    return rows.select("l_orderkey", "l_linenumber", "l_extendedprice").limit(100)
