"""Streaming queries: each runs over the files available now and equals its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.operators.budget import budget_triggers
from starloom.queries import load, query
from starloom.queries.retrieval_memory import _MAIL, _mail
from starloom.session import scratch_path
from starloom.sources import files as FI
from starloom.streaming import streams as ST


def _stream(spark, sf):
    return ST.file_stream(spark, f"{sf}/events.parquet", load(spark, sf, "events").schema)


@query("""
SELECT CAST(ts AS DATE) AS day, lower(trim(event_type)) AS event_type, count(*) AS interaction_count, round(sum(value), 2) AS total_value FROM events
WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events) GROUP BY ALL""")
def stream_daily_counts(spark, sf):
    """Days the watermark has closed."""
    counted = ST.drain(ST.daily_counts(_stream(spark, sf), "ts", "event_type"), "daily")
    return counted.withColumn("total_value", F.round("total_value", 2))


@query("""SELECT user_id, event_type, count(*) AS kept FROM (SELECT DISTINCT user_id, event_type, props FROM events) GROUP BY ALL""")
def stream_dedupe(spark, sf):
    """One message per user, type and properties; the delay spans the whole history."""
    kept = ST.drain(ST.without_repeats(_stream(spark, sf), ["user_id", "event_type", "props"], "ts", "60 days"), "dedupe")
    return kept.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("kept"))


@query(f"WITH {_MAIL} SELECT event_id, recipient FROM direct UNION ALL SELECT event_id, '<all>' FROM mail WHERE loud")
def stream_routed(spark, sf):
    _, people = _mail(spark, sf)
    loud = F.get_json_object("props", "$.k") == "7"
    own = F.array(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    letters = _stream(spark, sf).select("event_id", F.when(loud, F.array(F.lit("<all>"))).otherwise(own).alias("send_to"))
    return ST.drain(ST.routed(letters, people, "event_id", "recipient"), "routed")


FILE_ROWS = 1_000_000


def _in_four_files(spark, sf):
    """The events as four drops of files by time; those near a border lie in the drop before or after."""
    e = load(spark, sf, "events")
    span = e.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))).alias("lo"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("hi")).first()
    shifted = F.unix_micros(F.col("ts").cast("timestamp")) + (F.pmod(F.xxhash64("event_id"), F.lit(17)) - 8) * 3_600_000_000
    quarter = F.least(F.greatest(F.floor((shifted - span.lo) * 4 / F.lit(span.hi - span.lo + 1)), F.lit(0)), F.lit(3))
    folder = scratch_path(spark, "four-files")
    rows = {r.k: r.n for r in e.groupBy(quarter.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
    files = max(1, min(rows.get(k, 0) for k in range(4)) // FILE_ROWS)  # so many for each, none of them empty
    for k in range(4):
        e.filter(quarter == k).repartition(files).write.mode("append").parquet(folder)
    return ST.file_stream(spark, folder, e.schema, files_per_batch=files)


@query("SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS status FROM events GROUP BY user_id")
def stream_latest_status(spark, sf):
    """Newest status per job, kept by a batch handler over four micro-batches."""
    target = scratch_path(spark, "status")
    rows = _in_four_files(spark, sf).select("user_id", "event_id", F.col("event_type").alias("status"))
    ST.for_each(rows, ST.latest_status(target, "user_id", "event_id"), "status")
    return ST.read_status(spark, target).select("user_id", "event_id", "status")


@query("SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation UNION ALL SELECT c_custkey, c_name, c_nationkey FROM customer")
def stream_increments(spark, sf):
    """Files dropped between two runs: the second run loads only the new ones."""
    folder, target = scratch_path(spark, "drops"), scratch_path(spark, "loaded")
    schema = "n_nationkey bigint, n_name string, n_regionkey bigint"
    load(spark, sf, "nation").write.mode("append").option("header", True).csv(folder)
    ST.load_increments(spark, folder, schema, target)
    load(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey").toDF("n_nationkey", "n_name", "n_regionkey").write.mode("append").option("header", True).csv(folder)
    return ST.load_increments(spark, folder, schema, target)


BUDGET = 150


def _weight():
    return (F.floor("value") % 10 + 1).cast("bigint")


@query("""
WITH RECURSIVE e AS (SELECT user_id, event_id, CAST(floor(value) AS BIGINT) % 10 + 1 AS w, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, event_id, i, 150 - w AS remaining FROM e WHERE i = 1
 UNION ALL SELECT e.user_id, e.event_id, e.i, CASE WHEN r.remaining <= 0 THEN 150 ELSE r.remaining END - e.w FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
SELECT user_id, event_id, CAST(remaining AS BIGINT) AS remaining, remaining <= 0 AS triggered FROM r""")
def budget_trigger(spark, sf):
    e = load(spark, sf, "events").select("user_id", "ts", "event_id", _weight().alias("weight"))
    return budget_triggers(e, "user_id", ["ts", "event_id"], "weight", BUDGET).select("user_id", "event_id", "remaining", "triggered")


@query("""
WITH RECURSIVE e AS (SELECT user_id, ts, event_id, CAST(floor(value) AS BIGINT) % 10 + 1 AS w, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
r AS (SELECT user_id, ts, event_id, i, 150 - w AS remaining FROM e WHERE i = 1
 UNION ALL SELECT e.user_id, e.ts, e.event_id, e.i, CASE WHEN r.remaining <= 0 THEN 150 ELSE r.remaining END - e.w FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
SELECT user_id, event_id FROM r WHERE remaining <= 0 AND epoch_ms(ts) < (SELECT max(epoch_ms(ts)) - 86400000 FROM events)""")
def stream_budget_trigger(spark, sf):
    """Four files, out of order near their borders; what the watermark has passed equals the batch form."""
    events = _in_four_files(spark, sf).withColumn("weight", _weight())
    fired = ST.drain(ST.budget_stream(events, "user_id", "ts", ["event_id"], "weight", BUDGET), "budget", rocksdb=True)
    return fired.select("user_id", "event_id")


@query("SELECT doc_id, lang, source, n_chars FROM documents")
def jsonl_roundtrip(spark, sf):
    folder = scratch_path(spark, "json")
    load(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").write.json(folder)
    return FI.read_json_lines(spark, folder, "doc_id bigint, lang string, source string, n_chars bigint")
