"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a hashed order.  A document's virtual finish
time is the number of words its source has served when it ends, divided by the source's
weight; a queue that runs empty starts over until it has been served ``repeats`` times.
Sorted by finish time and cut where the budget is spent, the queues have been served in
proportion to their weights, and queues that ran out leave their share to the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from starloom.llm.common import BLANKS, boxed, running_sums, saved

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
BROADCAST_ROWS = 500_000  # of an id, a source name and a few numbers


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(F.col(text), BLANKS), "")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """Virtual end time and target of each source, from (source, source_size).

    Sources by code point, null last, take the weights in turn.  A source is capped at
    ``repeats`` times its size; the time at which the budget is spent follows from the
    order in which sources run out.  The window is over sources, one short row each.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    caps = sizes.withColumns({"weight": cycle, "_cap": F.col("source_size").cast("double") * repeats})
    timed = caps.withColumn("_out", F.col("_cap") / F.col("weight"))
    by_end = Window.orderBy("_out")
    whole = Window.partitionBy()
    timed = timed.withColumns({
        "_budget": F.sum(F.col("source_size").cast("double")).over(whole) * share,
        # served by the time this source runs out: all that ran out by then, and the others' weights
        "_served": F.sum("_cap").over(by_end) + F.col("_out") * (F.sum("weight").over(whole) - F.sum("weight").over(by_end)),
    })
    out = F.col("_served") <= F.col("_budget")
    left = F.col("_budget") - F.coalesce(F.sum(F.when(out, F.col("_cap"))).over(whole), F.lit(0.0))
    end = left / F.sum(F.when(~out, F.col("weight"))).over(whole)
    return timed.select("source", "source_size", "weight", F.when(out, F.col("_out")).otherwise(end).alias("end_time"),
                        F.when(out, F.col("_cap")).otherwise(end * F.col("weight")).alias("target"))


def queue(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Equal (source, id, size) rows as one entry, with its place in the source's queue.

    Only these narrow columns are written and shuffled.  The order is that of a keyed md5
    of the id, so reruns agree and no layout of the input changes it.
    """
    rows = docs.select("source", "doc_id", word_count().alias("size"))
    entries = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    written = saved(entries.withColumns({"digest": digest, "words": F.col("size") * F.col("copies")}), "queue")
    return running_sums(written, "source", "digest", ["doc_id", "size"], "words", "before")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: str = "mix") -> DataFrame:
    """One row per queue entry: targets, position and the words that the mix takes.

    The document being served at the cut is taken in part, so each source meets its target
    to the word.  Null sources are one queue; null and empty texts have size 0 and take
    nothing; an empty table gives an empty mix.
    """
    placed = queue(docs, seed)
    sizes = placed.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = saved(source_targets(sizes, weights, share, repeats), "targets").withColumnRenamed("source", "_source")
    return placed.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def served(start: Column, size: Column, repeats: int = REPEATS) -> Column:
    """Words served of a document that starts ``start`` words into each round of its queue."""
    stop = F.floor("target")
    rounds = [F.greatest(F.lit(0), F.least(size, stop - start - F.col("source_size") * r)) for r in range(repeats)]
    return sum(rounds[1:], rounds[0]).cast("bigint")


def mixed_sizes(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per document in the order of the mix, with the words taken of it.

    Rows that are equal in id, source and size stand one behind the other in the queue.
    """
    rows = mix(docs, weights, share, repeats)
    each = rows.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    start = F.col("before") + F.col("_nth") * F.col("size")
    timed = each.select("doc_id", "size", "source_size", "target", served(start, F.col("size"), repeats).alias("taken"),
                        F.coalesce(F.try_divide(start + F.col("size"), F.col("weight")), F.lit(0.0)).alias("virtual_finish"))
    return timed.orderBy("virtual_finish", "doc_id")


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """The mix itself: whole documents in the order of their virtual finish times, repeats as further rows.

    A document is in as often as it finishes before its source's target.  The one that is being
    served there is in, too, if that brings the source nearer to its target, or if the source
    would have nothing otherwise.  Documents without words finish at once and stay in once.
    Equal (source, id, size) rows finish together.  All columns stay, whatever they are called;
    an empty table gives an empty mix.
    """
    rows = mix(docs, weights, share, repeats)
    rounds = F.sequence(F.lit(0), F.lit(repeats - 1))
    end, target = F.col("before") + F.col("words"), F.floor("target")

    def taken(r):
        begins, stops = F.col("before") + r * F.col("source_size"), end + r * F.col("source_size")
        nearer = (begins < target) & ((stops - target < target - begins) | (begins == 0))
        return (stops <= target) | nearer

    ends = F.when(F.col("words") == 0, F.array(F.struct(F.try_divide(end, F.col("weight")).alias("t")))).otherwise(
        F.transform(F.filter(rounds, taken),
                    lambda r: F.struct(((end + r * F.col("source_size")) / F.col("weight")).alias("t"))))
    kept = saved(rows.select(F.col("source").alias("_source"), F.col("doc_id").alias("_id"), F.col("size").alias("_size"), ends.alias("_ends")).filter(F.size("_ends") > 0), "mix")
    same = F.col("source").eqNullSafe(F.col("_source")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (word_count() == F.col("_size"))
    # short rows below a counted limit are broadcast, so the texts move once, for the order
    side = F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept
    timed = boxed(docs, "source", "doc_id", "text").join(side, same).select("_doc", "doc_id", F.explode("_ends").alias("_end"))
    return timed.orderBy(F.col("_end.t"), F.col("doc_id")).select("_doc.*")
