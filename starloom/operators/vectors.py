"""Vector search: top-k by cosine or L2, threshold joins, store upkeep and memory scoring."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starloom.functions import scalars as S
from starloom.operators import tiles
from starloom.operators.retrieval import top_per
from starloom.session import cut_lineage, small_side


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1.0, norms)


def _cut(store: DataFrame, queries: DataFrame, vector: str) -> tuple[int, int]:
    """Numbers of tiles of both sides, from their row counts and the width of the vectors."""
    rows = store.count()
    asked, width = queries.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vector)), F.lit(1))).first()
    return tiles.store_tiles(store.sparkSession, rows, width), tiles.tiles_for(asked, width, tiles.QUERY_VALUES)


PAIR_VALUES = 4 << 20  # of vector components in one step of exact distances
GAP_VALUES = 1 << 19  # numbers in one of the matrices that tell whether any vector is near


def _exact_distances(left, right, gaps, skip, k, digits):
    """Distances from differences for every pair that can be among the nearest k, ties included; infinite for the rest.

    ``gaps`` are squared distances by product.  Their error is below (width + 4) epsilon of the
    squared sum of both norms, so the k-th upper bound of a query is above its k-th distance, and
    a pair whose lower bound is above that by more than a rounding step is not among the nearest.
    """
    width, eps = left.shape[1], np.finfo(np.float64).eps
    error = np.linalg.norm(left, axis=1)[:, None] + np.linalg.norm(right, axis=1)[None, :]
    error *= error
    error *= (width + 4) * eps
    exact = np.full(gaps.shape, np.inf)
    if len(left) > k:
        upper = np.sqrt(np.maximum(gaps + error, 0.0))
        upper[skip] = np.inf
        limit = np.partition(upper, k - 1, axis=0)[k - 1] * (1 + 4 * (width + 4) * eps) + 1.001 * 10.0**-digits
        np.subtract(gaps, error, out=upper)
        far = np.sqrt(np.maximum(upper, 0.0, out=upper), out=upper) > limit  # never where a bound is no number
        rows, cols = np.nonzero(~(far | skip))
    else:
        rows, cols = np.nonzero(~skip)
    step = max(1, PAIR_VALUES // max(width, 1))
    for at in range(0, len(rows), step):
        r, c = rows[at:at + step], cols[at:at + step]
        exact[r, c] = np.sqrt(((left[r] - right[c]) ** 2).sum(axis=1))
    return exact


def top_k(store: DataFrame, queries: DataFrame, store_id: str, query_id: str, vector: str, k: int = 10,
          metric: str = "cosine", where=None, exclude_self: bool = False, digits: int = 9, with_vector: bool = False, per: str | None = None) -> DataFrame:
    """Exact k nearest rows of ``store`` for every query, ties to the lower id.

    Tiles of both sides meet on the executors; a task scores its store rows in steps and
    carries the best k of every query from one step to the next, so only these leave it.
    ``where`` filters the store before scoring.  ``score`` is the cosine, or the L2 distance;
    ``with_vector`` adds the stored vector of each row found; with ``per``, a column of the
    store, every query gets the k nearest of each of its values.
    """
    own = [per] if per else []
    pool = (store.filter(where) if where is not None else store).select(store_id, vector, *own)
    asked = queries.select(query_id, F.col(vector).alias("__asked"))
    schema = StructType([StructField(query_id, queries.schema[query_id].dataType), StructField(store_id, store.schema[store_id].dataType)]).add("score", "double")
    for column in own:
        schema = schema.add(StructField(column, store.schema[column].dataType))

    def best_of(names, rows, asking, points) -> tiles.Best:
        best, squares = tiles.Best(k, len(asking)), (points**2).sum(axis=1)
        for at, to in tiles.steps(len(names), len(asking)):
            part = rows[at:to]
            skip = names[at:to, None] == asking[None, :] if exclude_self else np.zeros((to - at, len(asking)), dtype=bool)
            if metric == "cosine":
                cost = -np.round(_unit(part) @ points.T, digits)
                cost[skip] = np.inf
            else:
                gaps = (part**2).sum(axis=1)[:, None] + squares[None, :] - 2 * (part @ points.T)
                cost = np.round(_exact_distances(part, points, gaps, skip, k, digits), digits)
            best.add(cost, at)
        return best

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by([(c, "ascending") for c in (*own, store_id)])
        query, row, cost = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0)]
        if left.num_rows and right.num_rows:
            rows, points = tiles.matrix(left[vector]), tiles.matrix(right["__asked"])
            points = _unit(points) if metric == "cosine" else points
            names, asking = (tiles.flat(t[c]).to_numpy(zero_copy_only=False) for t, c in ((left, store_id), (right, query_id)))
            for at, to in tiles.runs(left[per]) if per else [(0, len(names))]:
                found = best_of(names[at:to], rows[at:to], asking, points).kept()
                query.append(found[0])
                row.append(found[1] + at)
                cost.append(found[2])
        query, row, cost = pa.array(np.concatenate(query)), pa.array(np.concatenate(row)), np.concatenate(cost)
        out = {query_id: tiles.flat(right[query_id]).take(query), store_id: tiles.flat(left[store_id]).take(row), "score": 0.0 - cost if metric == "cosine" else cost}
        return pa.table(out | {c: tiles.flat(left[c]).take(row) for c in own})

    found = tiles.meet(pool, asked, store_id, query_id, _cut(pool, asked, "__asked"), search, schema)
    best = F.col("score").desc() if metric == "cosine" else F.col("score").asc()
    ranked = top_per(found, [query_id, *own], [best, F.col(store_id)], k)
    return ranked.join(pool.select(store_id, vector), store_id).select(*ranked.columns, vector) if with_vector else ranked


CROWD = 512  # stored vectors of a cell that are compared without cutting it further
ROUNDS = 6  # of cutting, two axes each: a stored vector has at most 2 ** 12 copies
PIECE_VALUES = 1 << 18  # vector components of one side in one piece of a cell


def top_k_within(store: DataFrame, queries: DataFrame, group: str, store_id: str, query_id: str, vector: str, k: int = 10, digits: int = 9) -> DataFrame:
    """Exact k nearest rows by cosine for every (query, group), among the store rows of that group; ties to the lower id."""
    pool = store.select(group, store_id, vector)
    asked = queries.select(group, query_id, F.col(vector).alias("__asked"))
    schema = StructType([StructField(query_id, queries.schema[query_id].dataType), StructField(group, store.schema[group].dataType),
                         StructField(store_id, store.schema[store_id].dataType)]).add("score", "double")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by(store_id)
        points = _unit(tiles.matrix(left[vector])) if left.num_rows else None
        probes = _unit(tiles.matrix(right["__asked"])) if right.num_rows else None
        found = []
        for own, asking in tiles.cells(left, right):
            best = tiles.Best(k, len(asking))
            for at, to in tiles.steps(len(own), len(asking)):
                best.add(-np.round(points[own[at:to]] @ probes[asking].T, digits), at)
            query, row, cost = best.kept()
            found.append((asking[query], own[row], 0.0 - cost))
        query, row, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
        return pa.table({query_id: tiles.flat(right[query_id]).take(pa.array(query)), group: tiles.flat(right[group]).take(pa.array(query)),
                         store_id: tiles.flat(left[store_id]).take(pa.array(row)), "score": score})

    width = asked.agg(F.max(F.size("__asked"))).first()[0] or 1
    found = tiles.meet_in_cells(pool, asked, group, store_id, query_id, max(1, PIECE_VALUES // width), search, schema)
    return top_per(found, [query_id, group], [F.col("score").desc(), F.col(store_id)], k)


def _split(cells: DataFrame, name: str, axes: DataFrame, width: float, reach: float) -> DataFrame:
    """Vectors of the cells in ``axes`` move to finer ones along these axes: to all that their ball touches."""
    at = lambda i: F.element_at(name, F.get("axes", F.lit(i)) + 1)
    finer = cells.join(small_side(axes), "key", "left")
    for i in (0, 1):
        touched = F.array_distinct(F.array(F.floor((at(i) - reach) / width), F.floor((at(i) + reach) / width)))
        finer = finer.withColumn(f"cell{i}", F.explode(F.when(F.size("axes") > i, touched).otherwise(F.array(F.lit(None).cast("bigint")))))
    key = F.when(F.col("axes").isNull(), F.col("key")).otherwise(F.xxhash64("key", "cell0", "cell1"))
    return cut_lineage(finer.select(name, key.alias("key")))


def _cells(points: DataFrame, probes: DataFrame, radius: float) -> tuple[DataFrame, DataFrame]:
    """Cells (``key``) of both sides: any two vectors closer than the radius share one.

    All start in one cell.  A crowded cell is cut along the two axes on which its own vectors
    spread most, into steps of twice the radius, as long as they spread by more than a step;
    so an axis on which all are alike is never used, and a dense cluster is not cut in vain.
    """
    points, probes = points.withColumn("key", F.lit(0).cast("bigint")), probes.withColumn("key", F.lit(0).cast("bigint"))
    width = 2 * radius
    for _ in range(ROUNDS):
        crowded = points.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD).select("key")
        values = points.join(small_side(crowded), "key", "left_semi").select("key", F.posexplode("s").alias("axis", "value"))
        spread = values.groupBy("key", "axis").agg(F.stddev_pop("value").alias("by")).filter(F.col("by") > width)
        widest = F.slice(F.sort_array(F.collect_list(F.struct("by", "axis")), asc=False), 1, 2)  # one entry per axis of a vector
        axes = cut_lineage(spread.groupBy("key").agg(F.transform(widest, lambda x: x["axis"]).alias("axes")))
        if axes.isEmpty():
            break
        points, probes = _split(points, "s", axes, width, radius), _split(probes, "p", axes, width, 0.0)
    return points, probes


def _near(radius: float):
    """Probes that have a stored vector of their cell within the radius."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        points = tiles.matrix(left["s"]) if left.num_rows else None
        probes = tiles.matrix(right["p"]) if right.num_rows else None
        hit = np.zeros(right.num_rows, dtype=bool)
        for own, asking in tiles.cells(left, right):
            for at, to in tiles.steps(len(asking), len(own), GAP_VALUES):
                hit[asking[at:to]] |= _any_within(probes[asking[at:to]], points[own], radius)
        return pa.table({"p": tiles.flat(right["p"]).filter(pa.array(hit))})

    return search


def _any_within(some: np.ndarray, near: np.ndarray, radius: float) -> np.ndarray:
    """Which rows have another one closer than the radius: by product, and by differences where that is not sure."""
    gaps = (some**2).sum(axis=1)[:, None] + (near**2).sum(axis=1)[None, :] - 2 * (some @ near.T)
    error = (np.linalg.norm(some, axis=1)[:, None] + np.linalg.norm(near, axis=1)[None, :])**2 * ((some.shape[1] + 4) * np.finfo(np.float64).eps)
    sure = (gaps + error < radius * radius).any(axis=1)
    row, col = np.nonzero(~(gaps - error >= radius * radius) & ~sure[:, None])  # also where a gap is no number
    step = max(1, GAP_VALUES // max(some.shape[1], 1))
    for at in range(0, len(row), step):
        r, c = row[at:at + step], col[at:at + step]
        close = ((some[r] - near[c]) ** 2).sum(axis=1) < radius * radius
        sure[r[close]] = True
    return sure


def near_any(rows: DataFrame, stored: DataFrame, vector: str, radius: float, negate: bool = False) -> DataFrame:
    """Rows with (or, negated, without) a stored vector closer than ``radius`` in L2; exact.

    Different vectors of both sides are placed in cells; a cell is cut into pieces of bounded
    size, each pair of pieces meets in one task as a matrix product, and distances near the
    radius are taken from differences.  A null vector is near nothing.
    """
    wide = F.col(vector).cast("array<double>")
    different = lambda df, name: cut_lineage(df.select(wide.alias(name)).filter(F.col(name).isNotNull()).distinct())
    points, probes = _cells(different(stored, "s"), different(rows, "p"), radius)
    width = points.agg(F.max(F.size("s"))).first()[0] or 1
    found = tiles.meet_in_cells(points, probes, "key", "s", "p", max(1, PIECE_VALUES // width), _near(radius), "p array<double>")
    return rows.join(found.distinct(), wide == F.col("p"), "left_anti" if negate else "left_semi")


def upsert(store: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows replace stored ones with the same key; every row is kept, not only the last."""
    return store.join(rows.select(key), key, "left_anti").unionByName(rows)


def latest_versions(rows: DataFrame, key: str, version: str) -> DataFrame:
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*others), version).alias("__r")).select(key, "__r.*")


def delete(store: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return store.join(keys.select(key).distinct(), key, "left_anti")


def drop(spark, folder: str) -> bool:
    """Remove a stored collection with all its rows; tells whether there was one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def centroids(store: DataFrame, group: str, vector: str, width: int, digits: int = 6) -> DataFrame:
    """Mean vector per group as one flat aggregate."""
    means = [F.round(F.avg(F.element_at(vector, i + 1).cast("double")), digits) for i in range(width)]
    return store.groupBy(group).agg(F.array(*means).alias(vector))


def _min_max(value, low, high):
    """Scaled into 0..1; a zero range gives one half."""
    wide = high != low
    return np.where(wide, (value - low) / np.where(wide, high - low, 1.0), 0.5)


def memory_retrieve(memories: DataFrame, queries: DataFrame, memory_id: str, query_id: str, vector: str, created: str,
                    accessed: str, importance: str, now, decay: float = 0.99, k: int = 4, digits: int = 9) -> DataFrame:
    """Best k memories per query by importance + recency + relevance, each scaled to 0..1 over all memories.

    Importance and recency need one range each, relevance one per query.  Tiles of memories and
    queries meet twice: the first time they give two numbers per query, which are aggregated to
    its range; the second time the queries bring that range along and k rows per query leave a
    task.  Equal totals go to the memory accessed last, then the lower id.
    """
    days = S.whole_days(F.lit(now).cast("timestamp"), F.col(created))
    base = memories.select(
        memory_id, vector, F.unix_micros(F.col(accessed).cast("timestamp")).alias("__seen"),
        F.col(importance).cast("double").alias("__imp"), F.pow(F.lit(float(decay)), days).alias("__rec"),
    )
    base = cut_lineage(base)  # read by both meetings
    span = base.agg(F.min("__imp"), F.max("__imp"), F.min("__rec"), F.max("__rec")).first()
    asked = queries.select(query_id, F.col(vector).alias("__asked"))
    q_field = StructField(query_id, queries.schema[query_id].dataType)
    ranges = StructType([q_field]).add("lo", "double").add("hi", "double")
    scored = StructType([q_field, StructField(memory_id, memories.schema[memory_id].dataType)]).add("score", "double").add(StructField("__seen", LongType()))

    def relevances(left, right):
        """The tile in the order that breaks ties, and its relevance to all queries of the other tile, in equal steps."""
        left = left.sort_by([("__seen", "descending"), (memory_id, "ascending")])
        if not left.num_rows or not right.num_rows:
            return left, iter(())
        rows, points = _unit(tiles.matrix(left[vector])), _unit(tiles.matrix(right["__asked"]))
        return left, ((at, rows[at:to] @ points.T) for at, to in tiles.steps(len(rows), len(points)))

    def extremes(left: pa.Table, right: pa.Table) -> pa.Table:
        low, high = np.full(right.num_rows, np.inf), np.full(right.num_rows, -np.inf)
        for _, near in relevances(left, right)[1]:
            low, high = np.minimum(low, near.min(axis=0)), np.maximum(high, near.max(axis=0))
        there = right.num_rows if left.num_rows else 0
        return pa.table({query_id: tiles.flat(right[query_id]).slice(0, there), "lo": low[:there], "hi": high[:there]})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left, parts = relevances(left, right)
        best = tiles.Best(k, right.num_rows)
        own = _min_max(np.asarray(left["__imp"]), span[0], span[1]) + _min_max(np.asarray(left["__rec"]), span[2], span[3]) if left.num_rows else None
        low, high = np.asarray(right["lo"]), np.asarray(right["hi"])
        for at, near in parts:
            best.add(-np.round(own[at:at + len(near), None] + _min_max(near, low, high), digits), at)
        query, row, cost = best.kept()
        return pa.table({query_id: tiles.flat(right[query_id]).take(pa.array(query)), memory_id: tiles.flat(left[memory_id]).take(pa.array(row)),
                         "score": 0.0 - cost, "__seen": tiles.flat(left["__seen"]).take(pa.array(row))})

    cut = _cut(base, asked, "__asked")
    spans = tiles.meet(base, asked, memory_id, query_id, cut, extremes, ranges).groupBy(query_id).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ranged = asked.join(cut_lineage(spans), query_id)
    found = tiles.meet(base, ranged, memory_id, query_id, cut, score, scored)
    order = [F.col("score").desc(), F.col("__seen").desc(), F.col(memory_id)]
    return top_per(found, query_id, order, k).drop("__seen")


def focus_retrieve(memories: DataFrame, queries: DataFrame, memory_id: str, key_text: str, now, k: int = 30, **columns):
    """Several focus points over the memories that are not idle; also the access times to write back."""
    awake = memories.filter(~F.col(key_text).contains("idle"))
    found = cut_lineage(memory_retrieve(awake, queries, memory_id=memory_id, now=now, k=k, **columns))
    touched = found.select(memory_id).distinct().withColumn("last_accessed", F.lit(now).cast("timestamp"))
    return found, touched


def write_access(memories: DataFrame, touched: DataFrame, memory_id: str, accessed: str, folder: str) -> DataFrame:
    """The memories with the new access times, written as the store's next version and read back."""
    renamed = touched.select(F.col(memory_id).alias("__id"), F.col("last_accessed").cast(memories.schema[accessed].dataType).alias("__seen"))
    rows = memories.join(renamed, F.col(memory_id) == F.col("__id"), "left").withColumn(accessed, F.coalesce("__seen", accessed))
    rows.select(*memories.columns).write.mode("overwrite").parquet(folder)
    return memories.sparkSession.read.parquet(folder)


def recall_union(messages: DataFrame, group: str, seq: str, role: str, vector: str, k: int, minimum: int = 200, related: int = 5, digits: int = 9) -> DataFrame:
    """What a group recalls: its latest k messages and, where the gate is open, the related older ones before them.

    The older messages are the group's long-term store; the question is its last message.
    ``position`` counts from the best related message to the latest one.
    """
    newest = Window.partitionBy(group).orderBy(F.col(seq).desc())
    placed = cut_lineage(messages.withColumn("__nth", F.row_number().over(newest)))
    open_ = recall_gate(messages, group, seq, role, k, minimum).filter("use_longterm").select(group)
    recent = placed.filter(F.col("__nth") <= k).select(group, seq, F.lit(False).alias("related"), (F.lit(k) - F.col("__nth") + F.lit(related + 1)).cast("int").alias("__at"))
    asked = placed.filter("__nth = 1").join(open_, group, "left_semi").select(group, F.col(group).alias("__query"), vector)
    found = top_k_within(placed.filter(F.col("__nth") > k), asked, group, seq, "__query", vector, related, digits)
    both = recent.unionByName(found.select(group, seq, F.lit(True).alias("related"), F.col("rank").cast("int").alias("__at")))
    position = F.row_number().over(Window.partitionBy(group).orderBy("__at"))  # at most k + related rows
    return both.select(group, seq, "related", position.alias("position"))


def recall_gate(conversations: DataFrame, key: str, seq: str, role: str, k: int, minimum: int = 200) -> DataFrame:
    """Groups that also consult the long-term store: k set, more than ``minimum`` rows, last row from the user."""
    stats = conversations.groupBy(key).agg(F.count(F.lit(1)).alias("messages"), F.max_by(role, seq).alias("last_role"))
    use = F.lit(k != 0) & (F.col("messages") > minimum) & (F.col("last_role") == "user")
    return stats.withColumn("use_longterm", use)
