"""Near-duplicate texts: locality-sensitive candidates, exact verification, earliest kept."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, LongType

from starloom.functions.rows import numbered_rows
from starloom.functions.text import similar_texts
from starloom.session import cut_lineage, scratch_path


def band_keys(text: Column, bands: int, rows: int, width: int) -> Column:
    """One bucket number per band from MinHash values over distinct word runs.

    An Arrow helper, so each text is hashed once; a chain of column expressions
    would be evaluated again for every band.
    """

    @F.pandas_udf(ArrayType(LongType()))
    def keys(texts: pd.Series) -> pd.Series:
        seeds = np.random.default_rng(20_240_101)
        factor = seeds.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        offset = seeds.integers(0, 1 << 63, bands * rows, dtype=np.uint64)

        def one(t):
            words = (t or "").lower().split()
            runs = {" ".join(words[i:i + width]) for i in range(max(len(words) - width + 1, 1))}
            hashed = pd.util.hash_array(np.array(list(runs), dtype=object), categorize=False)
            lowest = np.array([(hashed * f + o).min() for f, o in zip(factor, offset)])
            mixed = np.arange(bands, dtype=np.uint64)
            for r in range(rows):
                mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + lowest[r::rows]
            return mixed.astype(np.int64)

        return texts.map(one)

    return keys(text)


def link_components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root): the smallest node each linked node is connected to.

    Roots are passed along links and then followed one step further per round
    (pointer jumping), so long chains need few rounds.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut_lineage(both)
    roots = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    for _ in range(max_rounds):
        offered = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("seen"))
        nearer = roots.join(offered, "node").select("node", F.least("root", "seen").alias("root"))
        jump = nearer.select(F.col("node").alias("root"), F.col("root").alias("far"))
        moved = nearer.join(jump, "root", "left").select("node", F.coalesce("far", "root").alias("root"))
        moved = cut_lineage(moved)
        changed = moved.join(roots.withColumnRenamed("root", "old"), "node").filter("root != old")
        if changed.isEmpty():
            return moved
        roots = moved
    raise RuntimeError("components did not settle")


def length_steps(length: Column, threshold: float) -> Column:
    """Two neighbouring length classes of a text; texts whose lengths allow the similarity share one."""
    step = F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / math.log((2 - threshold) / threshold)).cast("long")
    return F.array(step, step + 1)


PREFIX, GROWTH = 16, 4  # open texts of a bucket that a round settles at first, and how much more the next one does


def compared(pairs: DataFrame, firsts: DataFrame, threshold: float, tasks: int) -> DataFrame:
    """The (rep, head) pairs whose texts are alike; texts join last, and comparing keeps all cores busy."""
    later, earlier = firsts.select("rep", F.col("t").alias("tl")), firsts.select(F.col("rep").alias("head"), F.col("t").alias("te"))
    held = pairs.join(later, "rep").join(earlier, "head").repartition(tasks)
    return cut_lineage(held.filter(similar_texts("tl", "te", threshold)).select("rep", "head"))


def length_allows(threshold: float) -> Column:
    """The similarity cannot exceed 2 * shorter / (shorter + longer)."""
    return 2.0 * F.least("n", "head_n") > threshold * (F.least("n", "head_n") + F.greatest("n", "head_n"))


def settle(ready: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept and dropped texts (rep, keeper) among those whose earlier alike texts are all in ``edges``.

    A text without an earlier alike one stays; whatever is alike it goes, and links to texts
    that are gone do not count any more.  Only links circulate here, no texts.
    """
    kept = ready.join(edges, "rep", "left_anti").select("rep", F.col("rep").alias("keeper"))
    dropped = None
    fresh = kept
    while True:
        hit = edges.join(fresh.select(F.col("rep").alias("head")), "head", "left_semi").groupBy("rep").agg(F.min("head").alias("keeper"))
        dropped = cut_lineage(hit if dropped is None else dropped.unionByName(hit).groupBy("rep").agg(F.min("keeper").alias("keeper")))
        edges = cut_lineage(edges.join(dropped, "rep", "left_anti").join(dropped.select(F.col("rep").alias("head")), "head", "left_anti"))
        if edges.isEmpty():
            fresh = ready.join(kept, "rep", "left_anti").join(dropped, "rep", "left_anti")
            return kept.unionByName(fresh.select("rep", F.col("rep").alias("keeper"))), dropped
        fresh = cut_lineage(ready.join(kept, "rep", "left_anti").join(dropped, "rep", "left_anti").join(edges, "rep", "left_anti").select("rep"))
        if fresh.isEmpty():
            return kept, dropped
        kept = cut_lineage(kept.unionByName(fresh.select("rep", F.col("rep").alias("keeper"))))


def near_duplicates(docs: DataFrame, doc_id: str, text: str, threshold: float = 0.8, bands: int = 16, rows: int = 4,
                    width: int = 3) -> DataFrame:
    """(id, keeper, is_kept): in id order, a text goes if it is alike a kept one.

    Texts that share a band bucket and a length class are compared, the later one with the
    earlier one, because the similarity depends on the order.  A round takes the first open
    texts of every bucket, compares them among each other and settles those that are among the
    first in all of their buckets; then the later texts of these buckets are compared with the
    ones that stay.  The next round takes four times as many, so the rounds grow with the
    logarithm of the unlike texts of a bucket, a group of copies is gone after one, and texts
    meet kept ones only beyond the first few.  Ids, buckets and lengths circulate; a text is
    read for a comparison only.  Null texts count as empty, equal texts as one.  ``keeper`` is
    a kept text that the row is alike; buckets may miss a pair.
    """
    spark = docs.sparkSession
    prints = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("h", F.sha2("t", 256))
    path = scratch_path(spark, "first-texts")
    prints.groupBy("h").agg(F.min("id").alias("rep"), F.first("t").alias("t")).write.parquet(path)
    firsts = spark.read.parquet(path)
    banded = numbered_rows(firsts, ["rep", F.length("t").alias("n")], band_keys(F.col("t"), bands, rows, width), "band", "bucket")
    members = banded.select("rep", "n", F.explode(length_steps(F.col("n"), threshold)).alias("step"), "band", "bucket")
    members = cut_lineage(members.select("rep", "n", F.xxhash64("step", "band", "bucket").alias("place")))
    shared = members.groupBy("place").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("place")
    waiting = cut_lineage(members.join(shared, "place"))
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    gone, prefix = [], PREFIX
    while not waiting.isEmpty():
        nth = F.row_number().over(Window.partitionBy("place").orderBy("rep"))
        front = cut_lineage(waiting.withColumn("nth", nth).filter(F.col("nth") <= prefix).select("rep", "n", "place"))
        heads = front.select(F.col("rep").alias("head"), F.col("n").alias("head_n"), "place")
        near = front.join(heads, "place").filter((F.col("head") < F.col("rep")) & length_allows(threshold)).select("rep", "head").distinct()
        edges = compared(near, firsts, threshold, tasks)
        places = waiting.groupBy("rep").agg(F.count(F.lit(1)).alias("places"))
        ready = cut_lineage(front.groupBy("rep").agg(F.count(F.lit(1)).alias("seen")).join(places, "rep").filter("seen = places").select("rep"))
        kept, dropped = settle(ready, edges)
        gone.append(dropped)
        settled = kept.select("rep").unionByName(dropped.select("rep"))
        later = cut_lineage(waiting.join(settled, "rep", "left_anti"))
        if not later.isEmpty():
            stays = heads.join(kept.select(F.col("rep").alias("head")), "head", "left_semi")
            rest = later.join(stays, "place").filter(length_allows(threshold)).select("rep", "head").distinct()
            rest = rest.filter(F.col("head") < F.col("rep")).join(near, ["rep", "head"], "left_anti")
            hit = compared(rest, firsts, threshold, tasks).groupBy("rep").agg(F.min("head").alias("keeper"))
            gone.append(cut_lineage(hit))
            later = cut_lineage(later.join(gone[-1], "rep", "left_anti"))
        waiting, prefix = later, prefix * GROWTH
    placed = prints.select("id", "h").join(firsts.select("h", "rep"), "h")
    if gone:
        placed = placed.join(reduce(DataFrame.unionByName, gone), "rep", "left")
    else:
        placed = placed.withColumn("keeper", F.lit(None).cast(placed.schema["rep"].dataType))
    out = placed.withColumn("keeper", F.coalesce("keeper", "rep"))
    return out.select(F.col("id").alias(doc_id), "keeper", (F.col("id") == F.col("keeper")).alias("is_kept"))
