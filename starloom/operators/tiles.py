"""A stated set of queries against all rows of a store, in tiles that meet on the executors.

Both sides are cut by a hash of their key; each pair of a query tile and a store tile is one
group, in which a task scores and keeps a few rows per query.  So neither side passes through
the driver, a task holds two tiles whatever the sizes, and what is shuffled is each side once
for every tile of the other.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.session import cut_lineage, small_side

TILE_VALUES = 4 << 20  # numbers in one tile of a store
QUERY_VALUES = 1 << 20  # numbers in one tile of queries
LEAST_ROWS = 512  # a store below as many rows a core is not cut further
SCORES = 8 << 20  # numbers in one matrix of scores


def tiles_for(rows: int, width: int, values: int) -> int:
    return max(1, -(-rows * max(width, 1) // values))


def store_tiles(spark, rows: int, width: int) -> int:
    """Enough tiles for the memory of a task, and for all cores where there are rows for them."""
    return max(tiles_for(rows, width, TILE_VALUES), min(spark.sparkContext.defaultParallelism, -(-rows // LEAST_ROWS)))


def meet(store: DataFrame, queries: DataFrame, store_key: str, query_key: str, cut: tuple[int, int], function, schema) -> DataFrame:
    """``function(store tile, query tile)`` on Arrow tables for each pair of tiles."""
    spark = store.sparkSession
    n_store, n_query = cut

    def dealt(rows, own, key, n_own, other, n_other):
        placed = rows.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n_own)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    # partitions are cheap and tiles are not: more of them keep two tiles from one task
    parts = min(4 * n_store * n_query, max(n_store * n_query, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    left = dealt(store, "__st", store_key, n_store, "__qt", n_query).repartition(parts, "__st", "__qt").groupBy("__st", "__qt")
    right = dealt(queries, "__qt", query_key, n_query, "__st", n_store).repartition(parts, "__st", "__qt").groupBy("__st", "__qt")
    return left.cogroup(right).applyInArrow(function, schema)


def meet_in_cells(store: DataFrame, queries: DataFrame, key: str, store_key: str, query_key: str, piece: int, function, schema) -> DataFrame:
    """``function(store rows, query rows)`` where both sides share a value of ``key``.

    A value with many rows on a side is cut into pieces by the hash of that side's own key, and
    each pair of pieces meets once; small values share a task.  Both tables that the function
    gets have a ``__cell``: only rows of one cell belong together (see ``cells``).
    """
    spark, count = store.sparkSession, F.count(F.lit(1))
    queries = queries.select(*[F.col(c).alias(c) for c in queries.columns])  # columns of its own, also where both come from one table
    sizes = store.groupBy(key).agg(F.ceil(count / piece).cast("int").alias("__sp"), count.alias("__n")).join(
        queries.groupBy(key).agg(F.ceil(count / piece).cast("int").alias("__qp"), count.alias("__m")), key)
    sizes = cut_lineage(sizes)
    total = sizes.agg(F.sum(F.col("__sp") * F.col("__qp")), F.sum(F.col("__n") * F.col("__qp") + F.col("__m") * F.col("__sp"))).first()
    # as many tasks as there are cells for, of about one piece each, but no fewer than the cores can share
    buckets = max(1, min(total[0] or 1, max(-(-(total[1] or 0) // piece), 4 * spark.sparkContext.defaultParallelism)))
    sizes = small_side(sizes.select(key, "__sp", "__qp"))

    def dealt(rows, name, own, other):
        mine = rows.join(sizes, key).withColumn(own, F.pmod(F.xxhash64(name), F.col(own)).cast("int"))
        each = mine.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).withColumn("__cell", F.xxhash64(key, "__sp", "__qp"))
        placed = each.drop("__sp", "__qp").withColumn("__bucket", F.pmod("__cell", F.lit(buckets)).cast("int"))
        return placed.repartition(buckets, "__bucket").groupBy("__bucket")

    return dealt(store, store_key, "__sp", "__qp").cogroup(dealt(queries, query_key, "__qp", "__sp")).applyInArrow(function, schema)


def cells(left: pa.Table, right: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of both sides for every cell that both have."""

    def rows(table):
        cell = np.asarray(table["__cell"])
        order = np.argsort(cell, kind="stable")
        starts = np.flatnonzero(np.append(True, cell[order][1:] != cell[order][:-1])[:len(cell)])
        return dict(zip(cell[order][starts].tolist(), np.split(order, starts[1:]), strict=True)) if len(cell) else {}

    own, other = rows(left), rows(right)
    return [(own[c], other[c]) for c in own.keys() & other.keys()]


def flat(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = flat(column)
    return np.asarray(rows.flatten(), dtype=np.float64).reshape(len(rows), -1)


def runs(column: pa.ChunkedArray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal values of a sorted column."""
    ends = np.asarray(flat(column).dictionary_encode().indices.fill_null(-1))
    starts = np.flatnonzero(np.append(True, ends[1:] != ends[:-1])[:len(ends)]).tolist()
    return list(pairwise([*starts, len(ends)]))


class Best:
    """The k least costs per query so far; rows must come in the order that breaks ties."""

    def __init__(self, k: int, queries: int):
        self.k = k
        self.cost, self.at = np.zeros((0, queries)), np.zeros((0, queries), dtype=np.int64)

    def add(self, cost: np.ndarray, first: int) -> None:
        """Costs of (rows, queries), the rows numbered from ``first``; an infinite cost is no candidate."""
        order = np.argsort(cost, axis=0, kind="stable")[:self.k]
        self.cost = np.concatenate([self.cost, np.take_along_axis(cost, order, axis=0)])
        self.at = np.concatenate([self.at, order + first])
        order = np.argsort(self.cost, axis=0, kind="stable")[:self.k]
        self.cost, self.at = np.take_along_axis(self.cost, order, axis=0), np.take_along_axis(self.at, order, axis=0)

    def kept(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and cost of all that are kept."""
        row, query = np.nonzero(np.isfinite(self.cost))
        return query, self.at[row, query], self.cost[row, query]


def steps(rows: int, queries: int, scores: int = SCORES):
    """Slices of the rows whose scores fit into one matrix; the same for equal sizes."""
    size = max(1, scores // max(queries, 1))
    return [(at, min(at + size, rows)) for at in range(0, rows, size)]
