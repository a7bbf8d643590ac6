"""Helpers that several operators share: tokens, bound values, written tables and split running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.session import scratch_path

# What separates words, and what does not belong to a normalised word.
BLANKS = "[\\x20\\x09-\\x0D]+"
NOT_ALNUM = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read back.

    The written copy survives a lost executor, is read column by column, and has a
    known size, so that Spark broadcasts it only below its own byte threshold.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def boxed(docs: DataFrame, *columns) -> DataFrame:
    """Whole rows as one column ``_doc`` and beside it only the columns that an operator reads.

    Whatever else a row carries, and whatever it is called, cannot meet a name that the operator
    makes; ``select("_doc.*")`` gives the rows back.
    """
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), *columns)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Runs of anything but blanks, in order."""
    return F.array_remove(F.split(text, BLANKS), "")


def plain_words(text: Column) -> Column:
    """Lower-cased runs of ASCII letters, digits and anything beyond ASCII."""
    return F.array_remove(F.split(ascii_lower(text), NOT_ALNUM), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, also where the body is a lambda."""
    return F.transform(F.array(value), body)[0]


def windows_of(words: Column, n: int) -> Column:
    """64-bit hashes of all runs of n words, by start; none in a shorter text."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
    hashed = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) >= n, hashed).otherwise(F.array().cast("array<bigint>"))


def covered(starts: Column, lengths) -> Column:
    """How many positions the runs cover; ``starts`` ascends, ``lengths(i, next)`` bounds a run."""
    steps = F.transform(starts, lambda s, k: lengths(s, F.get(starts, k + 1)))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)


def id_text(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of parts; a null id counts as an empty text."""
    return F.crc32(id_text(column).cast("binary")) % parts


def unit(hexed: Column) -> Column:
    """The first 32 bits of a hex digest as a number from 0 up to 1."""
    return F.conv(F.substring(hexed, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def running_sums(rows: DataFrame, group: str, digest: str, ties: list[str], weight: str, name: str) -> DataFrame:
    """Sum of ``weight`` over the earlier rows of the group, in the order of a hex digest and the ties.

    A group of n rows is cut into about sqrt(n) buckets along the digest, so neither a
    task's rows nor the table of bucket sums grows with a hot group as such.  ``rows``
    is read several times and should be a written table.
    """
    sizes = saved(rows.groupBy(group).agg(F.count(F.lit(1)).alias("_rows")), "group-sizes")
    cuts = sizes.select(F.col(group).alias("_group"), F.ceil(F.sqrt("_rows")).alias("_cuts"))
    placed = rows.join(cuts, F.col(group).eqNullSafe(F.col("_group"))).withColumn("_bucket", F.floor(unit(F.col(digest)) * F.col("_cuts")))
    placed = placed.drop("_group", "_cuts")
    totals = placed.groupBy(group, "_bucket").agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = saved(totals.select(F.col(group).alias("_group"), F.col("_bucket").alias("_at"),
                                  F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")), "bucket-offsets")
    within = Window.partitionBy(group, "_bucket").orderBy(digest, *ties).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_bucket") == F.col("_at")))
    before = F.col("_offset") + F.coalesce(F.sum(weight).over(within), F.lit(0))
    return joined.withColumn(name, before.cast("bigint")).drop("_group", "_at", "_offset", "_bucket")
