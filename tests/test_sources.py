"""Readers, loads, catalog, models and streams on temporary files."""

import json

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts as FA
from starloom.operators import quality as Q
from starloom.plans import registry
from starloom.plans.models import ModelSet
from starloom.sources import catalog as C
from starloom.sources import files as FI
from starloom.sources import sinks as SI
from starloom.streaming import streams as ST


@pytest.fixture
def write(tmp_path):
    def put(name, text):
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(text, encoding="utf-8")
        return str(target)

    return put


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_separator_is_found(spark, write, sep):
    path = write("t.csv", "\n".join(sep.join(r) for r in [("id", "name", "v"), ("1", "x", "1.5"), ("2", "y", "2.5")]))
    assert FI.file_schema(spark, path) == [("id", "int"), ("name", "string"), ("v", "double")] and FI.file_rows(spark, path) == 2


def test_explicit_separator_wins(spark, write):
    assert FI.read_table(spark, write("t.csv", "a;b\n1;2\n"), sep=",").columns == ["a;b"]


def test_unsupported_file(spark, write):
    with pytest.raises(ValueError, match="Unsupported"):
        FI.read_table(spark, write("t.xml", "x"))


def test_profile_leaves_out_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "x" * 70), (None, None, "b")], "a int, b string, c string")
    assert [(r.column_name, r.row_count, r.null_count) for r in FI.profile(df).collect()] == [("a", 2, 1), ("c", 2, 0)]
    assert FI.samples(df)["c"] == ["x" * 70, "b"] and FI.samples(df, width=60)["c"] == ["x" * 60 + "…", "b"]


def test_load_replaces_and_append_adds(spark, write, tmp_path):
    path = write("t.csv", "id,v\n1,1.5\n2,\n")
    for _ in range(2):
        got = SI.load_file(spark, path, "loaded_t", location=str(tmp_path / "l"))
    assert got == {"table": "loaded_t", "rows_loaded": 2, "columns": ["id", "v"]}
    assert [SI.append_file(spark, path, "appended_t", location=str(tmp_path / "a")) for _ in range(2)] == [2, 4]
    assert dict(spark.table("appended_t").dtypes) == {"id": "bigint", "v": "double"}
    SI.staging_shell(FI.read_table(spark, path), "shell_t", str(tmp_path / "s"))
    assert spark.table("shell_t").count() == 0 and spark.table("shell_t").columns == ["id", "v"]
    assert {"default.appended_t", "default.loaded_t", "default.shell_t"} <= set(C.list_tables(spark))
    assert C.verify_table(spark, "loaded_t") and not C.verify_table(spark, "nothing_here")
    assert [tuple(r) for r in C.table_schema(spark, "loaded_t").collect()] == [(1, "id", "int"), (2, "v", "double")]
    assert C.described(spark, "nothing_here").count() == 0
    with pytest.raises(ValueError):
        C.table_schema(spark, "nothing_here")
    counts = {r.table_name: r.row_count for r in C.catalog_inventory(spark).collect()}
    assert counts["default.appended_t"] == 4
    for t in ("loaded_t", "appended_t", "shell_t"):
        spark.sql(f"drop table {t}")


def test_ddl_statements_run_one_by_one(spark):
    assert C.run_ddl(spark, ["create or replace temp view v1 as select 1 a; create or replace temp view v2 as select 2 a", "create or replace temp view v3 as select 3 a"]) == 3
    assert C.run_query(spark, "select sum(a) s from (select * from v1 union all select * from v3 union all select * from {x})", x=spark.table("v2")).first().s == 6


def test_identifiers_and_jdbc_text():
    with pytest.raises(ValueError):
        C.safe_identifier("a; drop")
    with pytest.raises(ValueError):
        C.jdbc_tables_query("x' or '1")
    assert "table_schema = 'public'" in C.jdbc_tables_query() and '"s"."t"' in C.jdbc_count_query("s", "t")
    options = C.jdbc_options("jdbc:x", "select 1", "u", "p", ("id", 0, 9, 3))
    assert options["numPartitions"] == "3" and options["dbtable"] == "(select 1) AS q"


def test_placeholders():
    results = {"3": {"workspace_id": 17}, "4b": {"Name": "n"}}
    assert C.fill_placeholders("a WORKSPACEID_FROM_TASK_3 b NAME_FROM_TASK_4b c OTHER_FROM_TASK_9", results) == "a 17 b n c OTHER_FROM_TASK_9"


def test_numbered_lines_over_files_and_blocks(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for f in range(3):
        (folder / f"part{f}.txt").write_text("".join(f"{f}-{i}\n" for i in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.line_no: r.value for r in FI.numbered_lines(spark, str(folder)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {500 * f + i: f"{f}-{i}" for f in range(3) for i in range(500)}


def test_json_lines_subset_ignores_out_of_range(spark, write):
    path = write("x.jsonl", "".join(json.dumps({"a": i}) + "\n" for i in range(10)))
    wanted = spark.createDataFrame([(2,), (5,), (50,), (2,)], "line_no long")
    assert sorted((r.line_no, r.a) for r in FI.json_lines_subset(spark, path, "a int", wanted).collect()) == [(2, 2), (5, 5)]
    assert FI.read_json_lines(spark, path).count() == 10 and FI.read_plain_csv(spark, path).count() == 10


def test_corpus(spark, write, tmp_path):
    for name, text in (("repo/a.md", "docs\nhere"), ("repo/src/b.py", "x"), ("repo/c.json", "{}"), ("repo/d.bin", "?")):
        write(name, text)
    files = FI.corpus(spark, str(tmp_path / "repo"))
    assert {r.name: r.category for r in files.collect()} == {"a.md": "docs", "b.py": "codes", "c.json": "assets", "d.bin": None}
    assert {r.category: (r.n_docs, r.n_chars) for r in FI.corpus_stats(files).collect()}["total"] == (4, 13)


def test_indexable(spark, write):
    assert FI.indexable(spark, write("a.csv", "content,n\nx,1\n")).first().content == "x"
    assert FI.indexable(spark, write("a.json", '[{"content": "y"}]')).first().content == "y"
    pieces = [r.content for r in FI.indexable(spark, write("a.txt", "a" * 600 + "\n\nlast line")).collect()]
    assert [len(p) for p in pieces] == [256, 256, 88, 9]
    with pytest.raises(ValueError, match="Content column"):
        FI.indexable(spark, write("b.csv", "x\n1\n"))


def test_experience_log(spark, write):
    path = write("app.log", 'x\n2024 New experience: {"req": "a", "resp": "b"}\nNew experience: {"req": \n')
    good, bad = FI.experiences_from_log(spark.read.text(path), "req string, resp string")
    assert [tuple(r) for r in good.collect()] == [("a", "b")] and bad.count() == 1


def test_sync_keeps_snapshots(spark, tmp_path):
    folder = str(tmp_path / "sync")
    SI.sync_streams({"a": spark.range(3)}, folder, snapshot="2024-01-01")
    SI.sync_streams({"a": spark.range(5)}, folder, snapshot="2024-01-02")
    SI.sync_streams({"a": spark.range(4)}, folder, snapshot="2024-01-02")
    assert {str(r.load_date): r["count"] for r in spark.read.parquet(f"{folder}/a").groupBy("load_date").count().collect()} == {"2024-01-01": 3, "2024-01-02": 4}


def test_keys_with_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    got = Q.key_uniqueness(df, "t", "k").first()
    assert got.duplicate_count == 3 and got.null_count == 2 and not got.is_unique
    assert Q.unique_failures(df, "t", "k").first().failures == 1
    assert Q.orphan_count(df, "k", spark.createDataFrame([(1,)], "p int"), "p", "r").first().orphan_count == 3
    assert Q.orphan_count(df.limit(0), "k", df.withColumnRenamed("k", "p"), "p", "r").first().orphan_count == 0


def test_plan_errors(spark):
    rows = [("1", [], "i", "TRANSFORMATION", "x"), ("2", ["1", "9"], None, "NOPE", ""), ("3", ["2"], "i", "CREDENTIAL_REQUEST", None)]
    plan = spark.createDataFrame(rows, "task_id string, dependent_task_ids array<string>, instruction string, task_type string, tool string")
    assert sorted((r.task_id, r.problem) for r in Q.plan_errors(plan).collect()) == [
        ("2", "missing instruction"), ("2", "missing tool"), ("2", "unknown dependency 9"), ("2", "unknown task type")]


def test_verdict_of_empty_report(spark):
    assert Q.verdict(spark.createDataFrame([], "status string")).first().verdict == "REJECTED"


def test_cross_left(spark):
    left = spark.range(2)
    assert FA.cross_left(left, spark.createDataFrame([], "a int, b string")).collect()[0].a is None
    assert FA.cross_left(left, spark.createDataFrame([(1, None), (2, "x")], "a int, b string")).count() == 4
    with pytest.raises(ValueError):
        FA.cross_left(left, spark.range(20), limit=10)


def test_models(spark, tmp_path):
    models = ModelSet(spark, {"src": spark.createDataFrame([(1,), (None,)], "id int")}, str(tmp_path))
    models.sql_model("first", "select * from {src}", ("src",), materialized="table", unique=("id",), not_null=("id",))
    models.sql_model("second", "select * from {first} where id = 1", ("first",))
    models.sql_model("broken", "select nope from {first}", ("first",))
    models.sql_model("after", "select * from {broken}", ("broken",))
    assert {r.node: r.status for r in models.run().collect()} == {"first": "success", "second": "success", "broken": "error", "after": "skipped"}
    assert {r.test: (r.failures, r.status) for r in models.test().collect()} == {"unique": (0, "pass"), "not_null": (1, "fail")}
    assert models.select("+second") == {"first", "second"} and models.downstream("first") == {"first", "second", "broken", "after"}
    with pytest.raises(ValueError, match="no model matches"):
        models.run("zzz")
    models.sql_model("first", "select * from {second}", ("second",))
    with pytest.raises(ValueError, match="cycle"):
        models.order()


def test_registry(tmp_path):
    from starloom.operators import features  # noqa: F401

    assert {"CatCount", "SplitBins"} <= set(registry.tools_with_tag("feature engineering"))
    assert registry.get_tool("MinMaxScale").doc and "features" in registry.get_tool("MinMaxScale").signature
    assert registry.tools_matching({"machine learning", "feature engineering"})[0].tags >= {"feature engineering"}
    (tmp_path / "mine.py").write_text("from starloom.plans.registry import tool\n\n@tool('x')\ndef my_tool(a):\n    'doc'\n    return a\n")
    assert registry.load_tools(str(tmp_path / "mine.py")) == ["my_tool"]


def test_status_handler_keeps_the_newest(spark, tmp_path):
    target = str(tmp_path)
    handler = ST.latest_status(target, "job", "at", buckets=4)
    kind = "job int, at int, s string"
    assert ST.read_status(spark, target) is None
    handler(spark.createDataFrame([(i, 1, "run") for i in range(20)], kind), 0)
    handler(spark.createDataFrame([(1, 3, "done"), (1, 2, "mid")], kind), 1)
    want = {i: "run" for i in range(20)} | {1: "done"}
    read = lambda: {r.job: r.s for r in ST.read_status(spark, target).collect()}
    assert read() == want
    versions = {r.bucket: r.version for r in ST.committed(spark, target)}
    assert sorted(versions.values()) == [0, 0, 0, 1]  # one bucket is written again
    handler(spark.createDataFrame([(1, 3, "done"), (1, 2, "mid")], kind), 1)  # the same epoch again
    assert read() == want and {r.bucket: r.version for r in ST.committed(spark, target)} == versions
    handler(spark.createDataFrame([], kind), 2)
    handler(spark.createDataFrame([(30, 1, "new"), (1, 1, "stale")], kind), 3)
    assert read() == want | {30: "new"}


def test_late_rows_are_dropped(spark, tmp_path):
    schema = "ts timestamp, event_type string, value double"
    folder = str(tmp_path / "in")

    def add(*rows):
        spark.sql("select 1").count()
        spark.createDataFrame([(t, k, 1.0) for t, k in rows], "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(folder)

    def run():
        return ST.drain(ST.daily_counts(ST.file_stream(spark, folder, schema), "ts", "event_type"), "x", target=str(tmp_path / "out"))

    add(("2024-01-01 10:00:00", "View"), ("2024-01-01 11:00:00", "view "), ("2024-01-05 00:00:00", "view"))
    run()
    add(("2024-01-01 12:00:00", "view"), ("2024-01-09 00:00:00", "view"))
    got = {str(r.day): r.interaction_count for r in run().collect()}
    assert got["2024-01-01"] == 2 and got["2024-01-05"] == 1 and "2024-01-09" not in got


def test_budget_state_carries_over_batches_out_of_order(spark, tmp_path):
    import random

    from starloom.operators.budget import budget_triggers

    rng = random.Random(2)
    rows = [(rng.choice([1, 1, 2, 3]), 1_700_000_000 + h * 3600, h, rng.randrange(0, 9)) for h in range(400)]
    kind = "agent long, at long, seq long, w long"
    timed = lambda df: df.withColumn("ts", F.timestamp_seconds("at"))
    schema = timed(spark.createDataFrame([], kind)).schema
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(4):
        # a day's worth of neighbours changes places between the files
        mine = [r for r in rows if min(max((r[2] + (r[2] * 7 % 13 - 6)) // 100, 0), 3) == part]
        rng.shuffle(mine)
        timed(spark.createDataFrame(mine, kind)).coalesce(1).write.mode("append").parquet(folder)
        if part == 2:
            continue  # two files in one run
        stream = ST.budget_stream(ST.file_stream(spark, folder, schema, 1), "agent", "ts", ["seq"], "w", 20, "1 day")
        got = ST.drain(stream, "b", target=out, rocksdb=True)
    whole = budget_triggers(timed(spark.createDataFrame(rows, kind)), "agent", ["ts", "seq"], "w", 20).filter("triggered")
    closed = 399 - 24
    assert sorted((r.agent, r.seq) for r in got.collect()) == sorted((r.agent, r.seq) for r in whole.collect() if r.seq < closed)


def test_agents_of_a_bucket_share_its_state(spark, tmp_path):
    """Named agents and one without a name, few buckets, two files; a call of the state serves a bucket, not an agent."""
    import random

    from starloom.operators.budget import budget_triggers

    rng = random.Random(3)
    rows = [(rng.choice([None, *"abcdefg"]), 1_700_000_000 + h * 3600, h, rng.randrange(0, 9)) for h in range(300)]
    timed = spark.createDataFrame(rows, "agent string, at long, seq long, w long").withColumn("ts", F.timestamp_seconds("at"))
    folder = str(tmp_path / "in")
    for part in range(2):
        timed.filter((F.col("seq") >= 150) == bool(part)).coalesce(1).write.mode("append").parquet(folder)
    stream = ST.budget_stream(ST.file_stream(spark, folder, timed.schema, 1), "agent", "ts", ["seq"], "w", 20, "1 day", buckets=2)
    got = ST.drain(stream, "b", target=str(tmp_path / "out"), rocksdb=True)
    whole = budget_triggers(timed.fillna("none", ["agent"]), "agent", ["ts", "seq"], "w", 20).filter("triggered and seq < 299 - 24")
    assert sorted((r.agent or "none", r.seq) for r in got.collect()) == sorted((r.agent, r.seq) for r in whole.collect())


def test_a_failing_stream_does_not_stop_the_others(spark, tmp_path):
    from starloom.sources import sinks

    bad = spark.range(3).select(F.raise_error(F.lit("broken")).alias("x"))
    got = {(r.stream, r.status, r.rows_synced) for r in sinks.sync_streams({"a": spark.range(2).toDF("x"), "b": bad, "c": spark.range(4).toDF("x")}, str(tmp_path)).collect()}
    assert got == {("a", "succeeded", 2), ("b", "failed", 0), ("c", "succeeded", 4)}


def test_statements_end_outside_quotes_and_comments(spark):
    from starloom.sources import catalog

    split = catalog.split_statements
    assert split("CREATE TABLE t(a int) -- don't drop; really\n; SELECT 1") == ["CREATE TABLE t(a int) -- don't drop; really", "SELECT 1"]
    assert split("/* a; b */ SELECT 2 /* it's */; -- only a comment;\n;;") == ["/* a; b */ SELECT 2 /* it's */"]
    assert split("SELECT 'it''s; ok', \"a;b\", `c;d`, 3 - 1, 4/2") == ["SELECT 'it''s; ok', \"a;b\", `c;d`, 3 - 1, 4/2"]
    assert split(" \n ; /* */ ") == []
    for bad in ("SELECT 'open; SELECT 2", "SELECT 1 /* open", 'SELECT "x'):
        with pytest.raises(ValueError, match="nothing closes"):
            split(bad)
    assert catalog.run_ddl(spark, ["SELECT 1 -- one; still\n; SELECT 2", "/* none; */"]) == 2


def test_database_queries_are_checked_and_partitioned(spark, monkeypatch):
    from starloom.sources import catalog

    asked = []
    answers = {"information_schema.tables": (["table_schema", "table_name"], [("shop", "b"), ("shop", "a")]), "MIN(": (["low", "high"], [(3, 40)]),
               "information_schema.columns": (["column_name", "data_type", "ordinal_position"], [("id", "bigint", 1)]), "COUNT(": (["table_name", "row_count"], [("a", 5), ("b", 6)])}

    def read(self, query, partition=None):
        asked.append((query, partition))
        names, rows = next((v for k, v in answers.items() if k in query), (["id"], [(1,)]))
        return spark.createDataFrame(rows, names)

    monkeypatch.setattr(catalog.Database, "read", read)
    shop = catalog.Database(spark, "jdbc:x", "u", "p", "shop")
    assert shop.tables() == ["a", "b"] and shop.verify("a")
    assert [tuple(r) for r in shop.inventory().collect()] == [("shop", "a", 5), ("shop", "b", 6)] and asked[-1][0].count("UNION ALL") == 1
    shop.scan("a", "id", 100)
    assert asked[-1] == ('SELECT * FROM "shop"."a"', ("id", 3, 41, 38))
    shop.scan("a")
    assert asked[-1] == ('SELECT * FROM "shop"."a"', None)
    for call in (lambda: shop.scan("a; DROP"), lambda: shop.scan("a", "id)"), lambda: shop.verify("a' OR 1=1"), lambda: catalog.jdbc_counts_query("shop", ["a b"])):
        with pytest.raises(ValueError, match="Invalid SQL identifier"):
            call()
    options = catalog.jdbc_options("jdbc:x", "SELECT 1", "u", "p", ("id", 3, 41, 38))
    assert (options["partitionColumn"], options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("id", "3", "41", "38")


def test_semicolons_in_quotes_do_not_split(spark):
    from starloom.sources import catalog

    assert catalog.run_ddl(spark, "SELECT ';' AS a; SELECT \"x;y\" AS b;") == 2
