"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import boxed, fold, let, saved, text_of, words_of
from starloom.llm.rules import STOP_WORDS, SYMBOLS, removed_by, removed_chars

SAMPLE = 400_000  # most labelled rows that a model is fitted on
FEATURES = 192
RIDGE = 1e-3
BINS = 2000  # of the raw score, from -0.5 to 1.5
THRESHOLD = 0.7
LIMIT = 4.0  # standard deviations
HELD_OUT = 2

STATISTICS = ["log_words", "word_length", "symbols", "stop_words", "same_lines", "capitals", "digits", "marks", "distinct", "line_words", "longest", "beyond_ascii"]


def statistics(text: str = "text") -> Column:
    """Numbers that describe one text, as an array in the order of STATISTICS; all 0 without words."""
    whole = text_of(text)
    words, lines = words_of(whole), F.filter(F.split(whole, "\n"), lambda x: x != "")
    kept = lambda pattern: F.length(F.regexp_replace(whole, pattern, "")).cast("double")

    def of(w, ls):
        n, chars = F.size(w).cast("double"), removed_chars(whole).cast("double")
        ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
        stop = F.size(F.filter(w, lambda x: F.lower(x).isin(*sorted(set(STOP_WORDS))))).cast("double")
        return F.array(
            F.log1p(n), ratio(chars, n), ratio(removed_by(whole, SYMBOLS).cast("double"), chars), ratio(stop, n),
            ratio((F.size(ls) - F.size(F.array_distinct(ls))).cast("double"), F.size(ls).cast("double")), ratio(kept("[^\\p{Lu}]+"), chars),
            ratio(kept("[^0-9]+"), chars), ratio(kept("[^!?]+"), chars), ratio(F.size(F.array_distinct(w)).cast("double"), F.sqrt(n)),
            F.log1p(ratio(n, F.size(ls).cast("double"))), F.coalesce(F.log1p(F.array_max(F.transform(w, F.length)).cast("double")), F.lit(0.0)),
            ratio(kept("[\\x00-\\x7F]+"), chars))

    return let(words, lambda w: let(lines, lambda ls: of(w, ls)))


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    turn: np.ndarray
    shift: np.ndarray
    weights: np.ndarray | None
    steps: np.ndarray
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosines whose inner products approximate a Gaussian kernel, and a constant."""
        z = np.clip((x - self.mean) / self.scale, -LIMIT, LIMIT)
        return np.hstack([np.cos(z @ self.turn + self.shift) * np.sqrt(2.0 / len(self.shift)), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        return np.clip(np.interp(self.raw(x), self.steps, self.levels), 0.0, 1.0)


def normal_equations(model: QualityModel):
    """Sums of one partition: a row of Z'Z and the entry of Z'y for each feature."""

    def run(batches):
        total = None
        for batch in batches:
            if len(batch):
                z = model.features(np.stack(batch["stats"].to_numpy()))
                part = z.T @ np.hstack([z, batch["label"].to_numpy()[:, None]])
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"i": np.arange(len(total), dtype="int32"), "row": list(total)})

    return run


def isotonic(centre: np.ndarray, mean: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; the ends of each pooled block, with its level."""
    blocks: list[list[float]] = []
    for x, y, n in zip(centre, mean, count, strict=True):
        blocks.append([x, x, y, n])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            low, _, y1, n1 = blocks[-2]
            _, high, y2, n2 = blocks.pop()
            blocks[-1] = [low, high, (y1 * n1 + y2 * n2) / (n1 + n2), n1 + n2]
    steps = np.array([e for b in blocks for e in (b[0], b[1] + 1e-9)])
    return steps, np.array([b[2] for b in blocks for _ in range(2)])


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """Statistics and mean label of labelled documents outside the held-out fold.

    Of more than ``sample`` labelled ids an even hashed share is taken; the join side is
    therefore bounded.  Null ids carry no label.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold("doc_id", 4) != HELD_OUT))
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.avg("quality").alias("label"))
    n = known.count()
    if n > sample:
        known = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * sample / n))
    rows = docs.select("doc_id", "text")
    return rows.join(F.broadcast(known), F.col("doc_id") == F.col("_id")).select(statistics().alias("stats"), "label", (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(4)) == 0).alias("calibrate"))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> QualityModel:
    """Fit on three quarters of the training rows, calibrate on the rest.

    The driver receives sums only: means, the normal equations and the binned scores, whose
    sizes depend on the parameters.  Without labels every document scores 1.
    """
    rows = saved(training_rows(docs, labels, sample), "quality-train")
    k, draw = len(STATISTICS), np.random.default_rng(20240)
    moments = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(k)],
                       *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(k)]).first()
    empty = moments["n"] == 0
    model = QualityModel(
        np.array([moments[f"m{i}"] or 0.0 for i in range(k)]), np.array([max(moments[f"s{i}"] or 0.0, 1e-6) for i in range(k)]),
        draw.normal(size=(k, features)) / np.sqrt(k / 2), draw.uniform(0, 2 * np.pi, features), None, np.zeros(1), np.ones(1))
    if empty:
        return model
    parts = rows.filter(~F.col("calibrate")).select("stats", "label").mapInPandas(normal_equations(model), "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    if not len(sums):  # too few rows to split
        return model
    equations = np.zeros((features + 1, features + 2))
    equations[sums["i"], sums["j"]] = sums["v"]
    penalty = RIDGE * max(equations[-1, -2], 1.0) * np.eye(features + 1) / 100
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(equations[:, :-1] + penalty, equations[:, -1])
    raw = F.pandas_udf(lambda s: pd.Series(model.raw(np.stack(s.to_numpy()))), "double")
    binned = rows.filter("calibrate").select("label", F.floor((F.greatest(F.lit(-0.5), F.least(F.lit(1.5), raw("stats"))) + 0.5) * (BINS / 2)).alias("bin"))
    seen = binned.groupBy("bin").agg(F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n")).orderBy("bin").toPandas()
    if len(seen):
        model.steps, model.levels = isotonic(seen["bin"].to_numpy() / (BINS / 2) - 0.5, seen["mean"].to_numpy(), seen["n"].to_numpy())
    else:
        model.steps, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def with_score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Adds ``_score``; only the statistics go to Python, the text stays where it is."""

    def calibrated(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(stats.to_numpy())) if len(stats) else [], dtype="float64")

    # the outer generator keeps the nested lambdas out of the Python expression
    described = docs.withColumn("_stats", F.explode_outer(F.array(statistics(text))))
    return described.withColumn("_score", F.pandas_udf(calibrated, "double")("_stats")).drop("_stats")


def score_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Score and verdict for every row; null and empty texts are scored like any other."""
    model = fit_quality(docs, labels, sample)
    rows = with_score(docs.select("doc_id", "text"), model)
    scored = rows.select("doc_id", (fold("doc_id", 4) == HELD_OUT).alias("held_out"), F.col("_score").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns, whatever these are called.

    Null and empty texts are scored like any other, equal rows alike, a score at the threshold
    stays; without documents the result is empty, without labels everything stays.
    """
    scored = with_score(boxed(docs, "text"), fit_quality(docs, labels, sample))
    return scored.filter(F.col("_score") >= threshold).select("_doc.*")
