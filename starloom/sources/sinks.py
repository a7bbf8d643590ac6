"""Loads and sinks: replace, append, sync, results and mismatches."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starloom.functions.rows import numbered_rows
from starloom.sources.catalog import safe_identifier
from starloom.sources.files import read_table


def load_file(spark: SparkSession, path: str, table: str, sep: str | None = None, location: str | None = None) -> dict:
    """Create or replace a table from a file; rows are counted in the written table."""
    df = read_table(spark, path, sep)
    writer = df.write.mode("overwrite")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(safe_identifier(table))
    return {"table": table, "rows_loaded": spark.table(table).count(), "columns": df.columns}


def staging_shell(df: DataFrame, table: str, location: str | None = None) -> None:
    """Empty table with the columns of a file."""
    writer = df.limit(0).write.mode("overwrite")
    (writer.option("path", location) if location else writer).saveAsTable(safe_identifier(table))


def sql_type(kind: str) -> str:
    """Target type family: integers, floats, booleans and timestamps, all else text."""
    if "int" in kind:
        return "bigint"
    if kind in ("float", "double") or kind.startswith("decimal"):
        return "double"
    if kind == "boolean":
        return "boolean"
    return "timestamp" if kind.startswith("timestamp") or kind == "date" else "string"


def typed_for_load(df: DataFrame) -> DataFrame:
    """Columns cast to their target family, NaN as null."""

    def column(name, kind) -> Column:
        c = F.col(f"`{name}`")
        if kind in ("float", "double"):
            c = F.when(~F.isnan(c), c)
        return c.cast(sql_type(kind)).alias(name)

    return df.select(*[column(n, k) for n, k in df.dtypes])


def append_file(spark: SparkSession, path: str, table: str, sep: str | None = None, location: str | None = None) -> int:
    """Append a file to a typed table, creating it if absent; a second run adds the rows again."""
    df = typed_for_load(read_table(spark, path, sep))
    writer = df.write.mode("append")
    if location and not spark.catalog.tableExists(table):
        writer = writer.option("path", location)
    writer.saveAsTable(safe_identifier(table))
    return spark.table(table).count()


def jdbc_append(df: DataFrame, url: str, table: str, user: str, password: str) -> None:
    typed_for_load(df).write.format("jdbc").mode("append").options(
        url=url, dbtable=safe_identifier(table), user=user, password=password, batchsize="500").save()


def sync_streams(streams: dict[str, DataFrame], folder: str, names: list[str] | None = None, snapshot: str | None = None) -> DataFrame:
    """Full refresh of each stream (all by default) and one status row per stream.

    A stream that cannot be written gets the status 'failed', and the others go on.

    With ``snapshot`` the rows go to a partition of that load date, and earlier
    loads stay; re-running a date replaces only that date.
    """
    done = []
    for name in names or sorted(streams):
        target = f"{folder.rstrip('/')}/{safe_identifier(name)}"
        if snapshot:
            target = f"{target}/load_date={snapshot}"
        spark = streams[name].sparkSession
        try:
            streams[name].write.mode("overwrite").parquet(target)
            written = spark.read.parquet(target)
            done.append(written.agg(F.lit(name).alias("stream"), F.lit("succeeded").alias("status"), F.count(F.lit(1)).alias("rows_synced")))
        except PySparkException as problem:
            logging.getLogger(__name__).warning("stream %s failed: %s", name, str(problem).split("\n")[0])
            done.append(spark.range(1).select(F.lit(name).alias("stream"), F.lit("failed").alias("status"), F.lit(0).cast("long").alias("rows_synced")))
    return reduce(DataFrame.unionByName, done)


def results_summary(results: DataFrame) -> DataFrame:
    """Mean score and total cost of a run; cost is cumulative, so the total is its maximum."""
    return results.agg(F.avg("score").alias("avg_score"), (F.max("cost") / F.count(F.lit(1))).alias("avg_cost"),
                       F.max("cost").alias("total_cost"))


def save_results(results: DataFrame, folder: str) -> DataFrame:
    results.write.mode("overwrite").option("header", True).csv(folder)
    return results_summary(results)


def log_mismatches(results: DataFrame, folder: str, threshold: float) -> None:
    """Append rows scoring below the threshold as JSON lines."""
    results.filter(F.col("score") < threshold).write.mode("append").json(folder)


def save_triples(triples: DataFrame, folder: str) -> None:
    triples.write.mode("overwrite").parquet(folder)


def load_triples(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def triples_from_links(documents: DataFrame, column: str) -> DataFrame:
    """Triples of node-link JSON documents (links with source, target, predicate)."""
    shape = "struct<links: array<struct<source: string, target: string, predicate: string>>>"
    links = numbered_rows(documents, [], F.from_json(column, shape).getField("links"), "seq", "l")
    return links.select(F.col("l.source").alias("subject"), "l.predicate", F.col("l.target").alias("object"), "seq")
