"""Global numbering, running totals and ranks without a single-task window.

A window without PARTITION BY sends all rows to one task, and one over a hot
key sends that key's rows to one task.  Here the rows are range-partitioned on
the full order (a hot leading key is split by the later columns), sorted in
place and written once; a table with one row per partition then supplies the
offsets.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.session import small_side, written

_PID, _POS, _OFFSET = "__pid", "__pos", "__offset"


def _asc(order):
    return [o.asc_nulls_last() if isinstance(o, Column) else F.col(o).asc_nulls_last() for o in order]


def ordered_partitions(df: DataFrame, order: list) -> DataFrame:
    """Rows in global order with their partition id and 0-based position in it, as a written table."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    return written(placed, "ordered")


def _with_offsets(placed: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach the sum of the totals of all earlier partitions."""
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count, never by the data
    offsets = totals.select(_PID, F.coalesce(F.sum("__total").over(before), F.lit(0)).alias(_OFFSET))
    return placed.join(F.broadcast(offsets), _PID)


def number_rows(df: DataFrame, order: list, name: str = "row_key", start: int = 1) -> DataFrame:
    """``row_number() OVER (ORDER BY ...)`` spread over all tasks; nulls last."""
    placed = ordered_partitions(df, _asc(order) if all(isinstance(o, str) for o in order) else order)
    totals = placed.groupBy(_PID).agg(F.count(F.lit(1)).alias("__total"))
    numbered = _with_offsets(placed, totals)
    return numbered.withColumn(name, F.col(_OFFSET) + F.col(_POS) + F.lit(start)).drop(_PID, _POS, _OFFSET)


def running_total(df: DataFrame, order: list, weights: list[str], suffix: str = "_before") -> DataFrame:
    """For each row the sum of ``weights`` over all strictly earlier rows."""
    placed = ordered_partitions(df, order)
    local = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(_PID).agg(*[F.sum(w).alias(f"__t_{w}") for w in weights])
    earlier = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _PID, *[F.coalesce(F.sum(f"__t_{w}").over(earlier), F.lit(0)).alias(f"__o_{w}") for w in weights]
    )
    joined = placed.join(F.broadcast(offsets), _PID)
    for w in weights:
        joined = joined.withColumn(f"{w}{suffix}", F.col(f"__o_{w}") + F.coalesce(F.sum(w).over(local), F.lit(0)))
    return joined.drop(_PID, _POS, *[f"__o_{w}" for w in weights])


def number_in_groups(df: DataFrame, keys: list[str], order: list, name: str = "rn") -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` for hot keys.

    The global number minus the group's first global number; the join table has
    one row per key.  Few keys are broadcast; with many of them adaptive
    execution splits a hot key's side of the join.
    """
    key_order = [F.col(k).asc_nulls_first() for k in keys]
    tail = [o if isinstance(o, Column) else F.col(o).asc_nulls_last() for o in order]
    numbered = number_rows(df, key_order + tail, name="__global")
    firsts = numbered.groupBy(*keys).agg(F.min("__global").alias("__first"))
    renamed = firsts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__first")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    out = numbered.join(small_side(renamed), same)
    return out.withColumn(name, F.col("__global") - F.col("__first") + 1).drop(
        "__global", "__first", *[f"__k_{k}" for k in keys]
    )


def rank_rows(df: DataFrame, value: str, name: str = "rank", descending: bool = True, dense: bool = False) -> DataFrame:
    """``rank()`` / ``dense_rank()`` over one value, counted on its distinct values."""
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__n"), F.lit(1).cast("long").alias("__one"))
    order = [F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()]
    weight = "__one" if dense else "__n"
    ranked = running_total(counts, order, [weight]).select(
        F.col(value).alias("__v"), (F.col(f"{weight}_before") + 1).cast("long").alias(name)
    )
    return df.join(small_side(ranked), F.col(value).eqNullSafe(F.col("__v")), "left").drop("__v")


ACCURACY = 10_000


def _counts(df: DataFrame, brackets: dict) -> dict:
    """Rows below and inside each bracket, all of them in one pass."""
    parts = []
    for (c, i), (low, high) in brackets.items():
        v = F.col(c).cast("double")
        parts += [F.count_if(v < F.lit(low)).alias(f"b{i}_{c}"), F.count_if(v.between(low, high)).alias(f"n{i}_{c}")]
    row = df.agg(*parts).first()
    return {(c, i): (row[f"b{i}_{c}"], row[f"n{i}_{c}"]) for c, i in brackets}


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> dict[str, list[float]]:
    """Exact linear-interpolated quantiles of several columns without sorting them.

    An approximate pass brackets each quantile within a few ten-thousandths of
    the rows, a second one counts the rows below each bracket, and only values
    inside a bracket are counted per value and ordered.  A bracket that misses
    its rank is opened fully, so the result never depends on the approximation.
    The driver receives a few numbers per column and probability.
    """
    slack = 3.0 / ACCURACY
    edges = [e for p in probs for e in (max(p - slack, 0.0), min(p + slack, 1.0))]
    first = df.agg(*[F.count(c).alias(f"n_{c}") for c in columns],
                   *[F.percentile_approx(F.col(c).cast("double"), edges, ACCURACY).alias(f"q_{c}") for c in columns]).first()
    out: dict[str, list] = {c: [None] * len(probs) for c in columns}
    brackets, ranks = {}, {}
    for c in columns:
        if first[f"n_{c}"]:
            for i, p in enumerate(probs):
                brackets[c, i] = (first[f"q_{c}"][2 * i], first[f"q_{c}"][2 * i + 1])
                ranks[c, i] = p * (first[f"n_{c}"] - 1)
    if not brackets:
        return out
    found = _counts(df, brackets)
    missed = [k for k, (below, n) in found.items() if not below <= int(ranks[k]) or not math.ceil(ranks[k]) < below + n]
    if missed:
        brackets |= {k: (-math.inf, math.inf) for k in missed}
        found = _counts(df, brackets)

    inside = [
        F.when(F.col(c).cast("double").between(low, high), F.struct(F.lit(f"{c}\u0001{i}").alias("k"), F.col(c).cast("double").alias("v")))
        for (c, i), (low, high) in brackets.items()
    ]
    counted = (
        df.select(F.explode(F.array_compact(F.array(*inside))).alias("p")).select("p.k", "p.v").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    keys = sorted(f"{c}\u0001{i}" for c, i in brackets)
    start, offset = {}, 0  # the running count goes over all brackets, key by key
    for key in keys:
        c, i = key.split("\u0001")
        start[key], offset = offset, offset + found[c, int(i)][1]
    running = running_total(counted, [F.col("k"), F.col("v")], ["n"])
    hit = F.lit(False)
    for key in keys:
        c, i = key.split("\u0001")
        for rank in {int(ranks[c, int(i)]), math.ceil(ranks[c, int(i)])}:
            at = start[key] + rank - found[c, int(i)][0]
            hit = hit | ((F.col("n_before") <= at) & (F.col("n_before") + F.col("n") > at))
    for r in running.filter(hit).groupBy("k").agg(F.min("v").alias("low"), F.max("v").alias("high")).collect():
        c, i = r.k.split("\u0001")
        rank = ranks[c, int(i)]
        out[c][int(i)] = r.low + (r.high - r.low) * (rank - int(rank))
    return out
