"""Optimisation rounds: means, running top-k, convergence, probabilities, experience."""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starloom.operators.ordering import ordered_partitions
from starloom.operators.retrieval import top_per


def round_stats(results: DataFrame, round_: str, score: str) -> DataFrame:
    """Mean and population deviation of each round."""
    return results.groupBy(F.col(round_).alias("round")).agg(
        F.avg(score).alias("avg_score"), F.stddev_pop(score).alias("std_score")
    )


def _push(heap: list, item: tuple, k: int) -> None:
    heapq.heappush(heap, item) if len(heap) < k else heapq.heappushpop(heap, item)


def _level(heap: list, k: int) -> tuple[float, float]:
    """Mean of the kept scores and its standard error over the configured k."""
    return sum(h[0] for h in heap) / len(heap), math.sqrt(sum(h[2] ** 2 for h in heap)) / k


def running_top_k(stats: DataFrame, k: int) -> DataFrame:
    """Per round the mean of the best k rounds so far, its error and the step from the round before.

    Rounds are range-partitioned.  The k best rounds of each partition (k rows
    per partition reach the driver) give every partition its starting state, so
    the running state never requires all rounds in one task.  Equal scores
    prefer the later round.
    """
    placed = ordered_partitions(stats.select("round", "avg_score", "std_score"), [F.col("round").asc()])
    tops = top_per(placed, "__pid", [F.col("avg_score").desc(), F.col("round").desc()], k).collect()
    sizes = {r["__pid"]: r["n"] for r in placed.groupBy("__pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    start: dict[int, tuple[int, list]] = {}
    heap: list = []
    seen = 0
    for pid in sorted(sizes):
        start[pid] = (seen, list(heap))
        seen += sizes[pid]
        for r in tops:
            if r["__pid"] == pid:
                _push(heap, (r.avg_score, r["round"], r.std_score), k)

    def walk(batches):
        state = None
        for batch in batches:
            if not len(batch):
                continue
            if state is None:
                index, kept = start[int(batch["__pid"].iloc[0])]
                state = list(kept)
            out = []
            for round_, avg, std in zip(batch["round"], batch["avg_score"], batch["std_score"]):
                before = _level(state, k) if state else None
                _push(state, (avg, round_, std), k)
                y, error = _level(state, k)
                delta = y - before[0] if before else None
                spread = math.sqrt(error**2 + before[1] ** 2) if before else None
                out.append((round_, index, y, error, delta, spread))
                index += 1
            yield pd.DataFrame(out, columns=["round", "idx", "top_mean", "top_error", "delta", "delta_error"])

    kind = stats.schema["round"].dataType.simpleString()
    return placed.mapInPandas(
        walk, f"round {kind}, idx long, top_mean double, top_error double, delta double, delta_error double"
    )


def convergence(stats: DataFrame, top_k: int = 3, z: float = 0.0, consecutive: int = 5) -> DataFrame:
    """(converged, start index, stop index): the first run of ``consecutive`` steps within z errors.

    Each quiet step marks the ``consecutive`` positions it can help to end; the
    first position marked by all of them is the stop.  Fewer than top_k + 1
    rounds never converge.
    """
    steps = running_top_k(stats, top_k)
    quiet = steps.filter(F.col("delta").isNotNull() & (F.abs("delta") <= F.lit(float(z)) * F.col("delta_error")))
    marks = quiet.select(F.explode(F.sequence("idx", F.col("idx") + consecutive - 1)).alias("stop"))
    stop = marks.groupBy("stop").count().filter(F.col("count") == consecutive).agg(F.min("stop").alias("stop"))
    # both inputs are single rows; the index bound keeps a stop inside the known rounds
    n = stats.agg(F.count(F.lit(1))).first()[0]
    found = F.col("stop").isNotNull() & F.lit(n >= top_k + 1)
    return stop.select(
        found.alias("converged"),
        F.when(found, F.col("stop") - consecutive + 1).alias("start_idx"), F.when(found, F.col("stop")).alias("stop_idx"),
    )


def mixed_probabilities(rounds: DataFrame, score: str, alpha: float = 0.2, uniform: float = 0.3) -> DataFrame:
    """Softmax of score x 100 mixed with a uniform share, normalised over all rows."""
    top, n = rounds.agg(F.max(score), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("Score list is empty.")
    weight = F.exp(F.lit(alpha) * 100 * (F.col(score) - F.lit(top)))
    total = rounds.agg(F.sum(weight)).first()[0]
    return rounds.withColumn("probability", F.lit(uniform / n) + F.lit(1 - uniform) * weight / F.lit(total))


def top_rounds(stats: DataFrame, sample: int, score: str = "avg_score") -> DataFrame:
    """Round 1 and then the best others; at least one other is always taken."""
    has_first = not stats.filter("round = 1").isEmpty()
    others = max(1, sample - 1) if has_first else max(1, sample)
    best = stats.filter("round != 1").orderBy(F.col(score).desc(), F.col("round")).limit(others)
    return stats.filter("round = 1").unionByName(best)


def best_round(results: DataFrame, round_: str, succeeded: str) -> DataFrame:
    return results.filter(F.col(succeeded)).groupBy().agg(F.max_by(F.struct("*"), round_).alias("r")).select("r.*")


def experience_maps(experience: DataFrame) -> DataFrame:
    """Outcome rows per parent: score before, and each round's modification and score by success.

    Kept as rows keyed by (parent, outcome, round); ``outcome_counts`` gives the
    per-parent totals, and a parent with very many rounds stays distributed.
    """
    worked = F.when(F.col("after") > F.col("before"), "success").otherwise("failure")
    return experience.select("parent", "round", worked.alias("outcome"), "modification", F.col("after").alias("score"))


def outcome_counts(experience: DataFrame) -> DataFrame:
    return experience.groupBy("parent").agg(
        F.min_by("before", "round").alias("score"),
        F.count_if(F.col("after") > F.col("before")).alias("successes"),
        F.count_if(~(F.col("after") > F.col("before"))).alias("failures"),
    )


def already_tried(proposals: DataFrame, experience: DataFrame) -> DataFrame:
    """Proposals (parent, modification) that were tried under that parent before."""
    tried = experience.select("parent", "modification").distinct()
    return proposals.join(tried, ["parent", "modification"], "left_semi")
