"""Feature construction and selection tools."""

from __future__ import annotations

import math
from itertools import combinations, combinations_with_replacement

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType, StringType

from starloom.operators.ordering import exact_quantiles, number_rows
from starloom.operators.scaling import FeatureTool
from starloom.plans.registry import tool
from starloom.session import cut_lineage, small_side

TAGS = ("feature engineering", "machine learning")


def hash_int(key, salt) -> F.Column:
    """32 bits of md5(key|salt): the same number in any SQL engine."""
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(salt))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


@tool(*TAGS)
class PolynomialExpansion(FeatureTool):
    """Products of columns up to ``degree``; nulls count as 0.

    All columns are expanded unless ``most`` is given: then the best correlated with the
    label are kept, ties going to the earlier column.  The label's own entry is excluded
    by name.
    """

    def __init__(self, cols: list[str], label_col: str, degree: int = 2, most: int | None = None):
        super().__init__([c for c in cols if c != label_col])
        self.label_col, self.degree, self.most = label_col, degree, most

    def _fit(self, df):
        if self.most is None or len(self.features) <= self.most:
            return
        row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(self.label_col).cast("double")).alias(c)
                       for c in self.features]).first()

        def strength(c):
            return -1.0 if row[c] is None or math.isnan(row[c]) else abs(row[c])

        self.features = sorted(self.features, key=lambda c: -strength(c))[:self.most]

    def _transform(self, df):
        base = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in self.features}
        made = []
        for degree in range(1, self.degree + 1):
            for combo in combinations_with_replacement(self.features, degree):
                value = base[combo[0]]
                for c in combo[1:]:
                    value = value * base[c]
                powers = [c if combo.count(c) == 1 else f"{c}^{combo.count(c)}" for c in dict.fromkeys(combo)]
                made.append(value.alias(" ".join(powers)))
        return df.select(*[c for c in df.columns if c not in self.features], *made)


class _Lookup(FeatureTool):
    """Adds columns of a fitted (category -> value) table; null and unseen stay null.

    The table is written when fitted, and sent to every task only if it is
    small, so that the rows themselves are not shuffled.
    """

    def fit(self, df):
        super().fit(df)
        self.table = cut_lineage(self.table)
        return self

    def _transform(self, df):
        key = self.features[0]
        table = self.table.withColumnRenamed(key, "__key")
        return df.join(small_side(table), F.col(key) == F.col("__key"), "left").drop("__key")


@tool(*TAGS)
class CatCount(_Lookup):
    """``<c>_cnt``: rows holding the same category."""

    def __init__(self, col: str):
        super().__init__([col])

    def _fit(self, df):
        c = self.features[0]
        self.table = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(f"{c}_cnt"))


@tool(*TAGS)
class TargetMeanEncoder(_Lookup):
    """``<c>_target_mean``: mean label of the category."""

    def __init__(self, col: str, label: str):
        super().__init__([col])
        self.label = label

    def _fit(self, df):
        c = self.features[0]
        self.table = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.avg(self.label).alias(f"{c}_target_mean"))


@tool(*TAGS)
class KFoldTargetMeanEncoder(_Lookup):
    """``<c>_kf_target_mean``: out-of-fold mean label, averaged per category.

    Folds come from a hash of ``key``, not from a shuffle.  Everything is
    derived from (category, fold) sums: no row is visited twice.
    """

    def __init__(self, col: str, label: str, key: str, n_splits: int = 5, random_state: int = 2021):
        super().__init__([col])
        self.label, self.key, self.n_splits, self.random_state = label, key, n_splits, random_state

    def _fit(self, df):
        c = self.features[0]
        fold = F.pmod(hash_int(self.key, self.random_state), F.lit(self.n_splits))
        cells = (
            df.select(F.col(c), F.col(self.label).cast("double").alias("y"), fold.alias("fold")).groupBy(c, "fold")
            .agg(F.sum("y").alias("s"), F.count("y").alias("n"), F.count(F.lit(1)).alias("rows"))
        )
        mean = df.agg(F.avg(self.label)).first()[0]
        known = cells.filter(F.col(c).isNotNull())
        whole = known.groupBy(c).agg(F.sum("s").alias("cs"), F.sum("n").alias("cn"))
        rest = F.when(F.col("cn") - F.col("n") > 0,
                      (F.col("cs") - F.coalesce(F.col("s"), F.lit(0.0))) / (F.col("cn") - F.col("n")))
        per_cell = known.join(whole, c).withColumn("m", F.coalesce(rest, F.lit(mean)))
        self.table = per_cell.groupBy(c).agg(
            (F.sum(F.col("m") * F.col("rows")) / F.sum("rows")).alias(f"{c}_kf_target_mean")
        )


@tool(*TAGS)
class CatCross(FeatureTool):
    """``<a>_<b>``: id of a pair of categories, n_a * n_b for an unseen one.

    Ids are rank_a * n_b + rank_b over the sorted values (null last), so the
    product of the two value sets is never built.  The ranks of a column are a
    written table that is joined by value.  All columns are crossed unless
    ``max_cat_num`` is given: then every column above it is left out, also
    when two such columns are neighbours.
    """

    def __init__(self, cols: list[str], max_cat_num: int | None = None):
        super().__init__(cols)
        self.max_cat_num = max_cat_num

    def _fit(self, df):
        self.kept = self.features
        if self.max_cat_num is not None:
            sizes = df.agg(*[F.countDistinct(c).alias(c) for c in self.features]).first()
            self.kept = [c for c in self.features if sizes[c] <= self.max_cat_num]
        self.ranks = {c: cut_lineage(number_rows(df.select(c).distinct(), [c], f"__rank_{c}", start=0)) for c in self.kept}
        self.sizes = {c: ranks.count() for c, ranks in self.ranks.items()}

    def _transform(self, df):
        if len(self.kept) < 2:
            return df
        ranked = df
        for c in self.kept:
            ranks = self.ranks[c].withColumnRenamed(c, "__value")
            ranked = ranked.join(small_side(ranks), F.col(c).eqNullSafe(F.col("__value")), "left").drop("__value")
        made = {}
        for a, b in combinations(self.kept, 2):
            n_a, n_b = self.sizes[a], self.sizes[b]
            made[f"{a}_{b}"] = F.coalesce(F.col(f"__rank_{a}") * n_b + F.col(f"__rank_{b}"), F.lit(n_a * n_b)).cast("long")
        return ranked.withColumns(made).drop(*[f"__rank_{c}" for c in self.kept])


_GROUP_FUNCTIONS = {
    "mean": F.avg, "std": F.stddev_samp, "var": F.var_samp, "sum": lambda c: F.coalesce(F.sum(c), F.lit(0.0)),
    "min": F.min, "max": F.max, "count": F.count, "nunique": F.countDistinct,
}


@tool(*TAGS)
class GroupStat(_Lookup):
    """``<agg>_<fn>_by_<group>``; std and var are sample statistics, a null group gets nulls."""

    def __init__(self, group_col: str, agg_col: str, agg_funcs: list[str]):
        super().__init__([group_col])
        self.agg_col, self.agg_funcs = agg_col, agg_funcs

    def _fit(self, df):
        g = self.features[0]
        self.table = df.filter(F.col(g).isNotNull()).groupBy(g).agg(
            *[_GROUP_FUNCTIONS[f](self.agg_col).alias(f"{self.agg_col}_{f}_by_{g}") for f in self.agg_funcs]
        )


def kmeans_edges(df: DataFrame, column: str, bins: int, max_iter: int = 300, tol: float = 1e-4) -> list[float]:
    """1-D Lloyd iterations from uniform mid-points over counted values.

    The values are counted once and written; each round is one small aggregate.
    Returns outer and inner edges, inner ones half-way between centres.
    """
    counted = cut_lineage(df.select(F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias("v"))
                          .groupBy("v").agg(F.count(F.lit(1)).alias("n")))
    low, high, total, s1, s2 = counted.agg(
        F.min("v"), F.max("v"), F.sum("n"), F.sum(F.col("v") * F.col("n")), F.sum(F.col("v") * F.col("v") * F.col("n"))
    ).first()
    if low == high:
        return [low, high]
    step = (high - low) / bins
    centres = [low + step * (i + 0.5) for i in range(bins)]
    limit = tol * (s2 / total - (s1 / total) ** 2)
    for _ in range(max_iter):
        mids = [(a + b) / 2 for a, b in zip(centres, centres[1:])]
        part = sum((F.col("v") >= F.lit(m)).cast("int") for m in mids)
        got = {r.k: r.c for r in counted.groupBy(part.alias("k")).agg(
            (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("c")).collect()}
        moved = sorted(got.get(i, centres[i]) for i in range(bins))
        shift = sum((a - b) ** 2 for a, b in zip(moved, centres))
        centres = moved
        if shift <= limit:
            break
    return [low, *[(a + b) / 2 for a, b in zip(centres, centres[1:])], high]


@tool(*TAGS)
class SplitBins(FeatureTool):
    """Bin number of each value: count of inner edges at or below it; nulls count as 0."""

    def __init__(self, cols: list[str], strategy: str = "quantile", bins: int = 5):
        super().__init__(cols)
        if strategy not in ("quantile", "uniform", "kmeans"):
            raise ValueError(f"unknown strategy {strategy}")
        self.strategy, self.bins = strategy, bins

    def _fit(self, df):
        filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in self.features])
        if self.strategy == "quantile":
            edges = exact_quantiles(filled, self.features, [i / self.bins for i in range(self.bins + 1)])
            self.edges = {c: sorted(set(e)) for c, e in edges.items()}
        elif self.strategy == "uniform":
            row = filled.agg(*[F.min(c).alias(f"lo_{c}") for c in self.features],
                             *[F.max(c).alias(f"hi_{c}") for c in self.features]).first()
            self.edges = {}
            for c in self.features:
                lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
                self.edges[c] = sorted({lo + (hi - lo) * i / self.bins for i in range(self.bins)} | {hi})
        else:
            self.edges = {c: kmeans_edges(filled, c, self.bins) for c in self.features}

    def _transform(self, df):
        def binned(c):
            value = F.coalesce(F.col(c).cast("double"), F.lit(0.0))
            inner = self.edges[c][1:-1]
            return sum(((value >= F.lit(e)).cast("double") for e in inner), F.lit(0.0))

        return df.withColumns({c: binned(c) for c in self.features})


@tool(*TAGS)
class ExtractTimeComps(FeatureTool):
    """year, month, day, hour, dayofweek (Monday 1) and is_weekend; unparseable text gives null and weekend 0."""

    ALL = ("year", "month", "day", "hour", "dayofweek", "is_weekend")

    def __init__(self, time_col: str, time_comps: list[str] | None = None):
        super().__init__([time_col])
        self.time_comps = list(time_comps or self.ALL)

    def _fit(self, df):
        pass

    def _transform(self, df):
        raw = F.col(self.features[0])
        t = raw.try_cast("timestamp")
        parts = {
            "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t),
            "dayofweek": F.weekday(t) + 1, "is_weekend": F.coalesce((F.weekday(t) >= 5).cast("int"), F.lit(0)),
        }
        return df.withColumns({k: parts[k] for k in self.ALL if k in self.time_comps})


def _numeric(df: DataFrame, label: str) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name != label]


@tool(*TAGS)
class GeneralSelection(FeatureTool):
    """Drop all-null, single-valued and infinite columns and text that is unique per row.

    Both infinities count, a column failing several tests is dropped once, and
    the label is always kept.
    """

    def __init__(self, label_col: str):
        super().__init__([label_col])
        self.label_col = label_col

    def _fit(self, df):
        names = [c for c in df.columns if c != self.label_col]
        parts = [F.count(F.lit(1)).alias("__rows")]
        for c in names:
            kind = df.schema[c].dataType
            parts += [F.count(c).alias(f"n_{c}"), (F.min(c) == F.max(c)).alias(f"one_{c}")]
            if kind.typeName() in ("double", "float"):
                infinite = F.abs(F.col(c)) == F.lit(float("inf"))
                parts.append(F.max(F.coalesce(infinite, F.lit(False)).cast("int")).alias(f"inf_{c}"))
        row = df.agg(*parts).first()
        # distinct counts only for text that could still be unique per row
        texts = [c for c in names if isinstance(df.schema[c].dataType, StringType) and row[f"n_{c}"] == row["__rows"]]
        unique = set()
        for c in texts:
            # a repeat among the first rows settles it; only otherwise all values are compared
            if all(part.groupBy(c).count().filter("count > 1").isEmpty() for part in (df.select(c).limit(100_000), df)):
                unique.add(c)

        def keep(c):
            if row[f"n_{c}"] == 0 or row[f"one_{c}"]:
                return False
            return not row.asDict().get(f"inf_{c}") and c not in unique

        self.kept = [c for c in names if keep(c)]

    def _transform(self, df):
        return df.select(*self.kept, self.label_col)


@tool(*TAGS)
class VarianceBasedSelection(FeatureTool):
    """Numeric columns whose population variance exceeds the threshold, plus the label."""

    def __init__(self, label_col: str, threshold: float = 0.0):
        super().__init__([label_col])
        self.label_col, self.threshold = label_col, threshold

    def _fit(self, df):
        names = _numeric(df, self.label_col)
        row = df.agg(*[F.var_pop(c).alias(c) for c in names]).first()
        self.kept = [c for c in names if row[c] is not None and row[c] > self.threshold]

    def _transform(self, df):
        return df.select(*self.kept, self.label_col)


@tool(*TAGS)
class TreeBasedSelection(FeatureTool):
    """Numeric columns with positive importance in a tree ensemble, strongest first, plus the label."""

    def __init__(self, label_col: str, task_type: str, trees: int = 20, depth: int = 5, seed: int = 42):
        super().__init__([label_col])
        if task_type not in ("cls", "mcls", "reg"):
            raise ValueError(f"unknown task type {task_type}")
        self.label_col, self.task_type = label_col, task_type
        self.trees, self.depth, self.seed = trees, depth, seed

    def _fit(self, df):
        from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import GBTRegressor

        names = _numeric(df, self.label_col)
        filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names],
                           F.col(self.label_col).cast("double").alias("__label"))
        rows = VectorAssembler(inputCols=names, outputCol="__x").transform(filled)
        shared = dict(featuresCol="__x", labelCol="__label", maxDepth=self.depth, seed=self.seed)
        if self.task_type == "mcls":
            model = RandomForestClassifier(numTrees=self.trees, **shared).fit(rows)
        else:
            learner = GBTClassifier if self.task_type == "cls" else GBTRegressor
            model = learner(maxIter=self.trees, **shared).fit(rows)
        weights = sorted(zip(names, model.featureImportances.toArray()), key=lambda w: -w[1])
        self.importances = dict(weights)
        self.kept = [c for c, w in weights if w > 0]

    def _transform(self, df):
        return df.select(*self.kept, self.label_col)


def split_train_dev_test(df: DataFrame, key: str, seed: int = 100) -> DataFrame:
    """Adds ``split``: test 20 %, then dev 25 % of the rest, by hashes of the key."""
    outer, inner = F.pmod(hash_int(key, seed), F.lit(100)), F.pmod(hash_int(key, f"{seed}-dev"), F.lit(100))
    return df.withColumn("split", F.when(outer < 20, "test").when(inner < 25, "dev").otherwise("train"))


def target_views(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """The dev and test sets with and without their target, the target renamed ``target``."""
    out = {"train": df.filter("split = 'train'").drop("split")}
    for name in ("dev", "test"):
        part = df.filter(F.col("split") == name).drop("split")
        out[name] = part
        out[f"{name}_wo_target"] = part.drop(target)
        out[f"{name}_target"] = part.select(F.col(target).alias("target"))
    return out


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The n rows first in hash order, and the complement.

    Rows are counted per leading hash bits (65 536 numbers on the driver); only
    the bucket holding the n-th row is ordered, so n may be any share of the rows.
    """
    order = df.withColumn("__h", hash_int(key, seed))
    bucket = F.floor(F.col("__h") / 65_536)
    left, edge = n, None
    for r in sorted(order.groupBy(bucket.alias("b")).count().collect()):
        if left <= r["count"]:
            if left > 0:
                first = order.filter(bucket == r.b).select("__h", key).orderBy("__h", key).limit(left)
                edge = first.agg(F.max(F.struct("__h", key)).alias("edge")).first().edge
            break
        left -= r["count"]
    else:
        return order.drop("__h"), order.limit(0).drop("__h")
    if edge is None:
        return order.limit(0).drop("__h"), order.drop("__h")
    at_or_before = (F.col("__h") < edge["__h"]) | ((F.col("__h") == edge["__h"]) & (F.col(key) <= edge[key]))
    return order.filter(at_or_before).drop("__h"), order.filter(~at_or_before).drop("__h")


def one_row_per_task(df: DataFrame, task: str, key: str, seed: int) -> DataFrame:
    """One row per task, the first in hash order; an aggregate, so a large task is no hot spot."""
    packed = F.struct(*[F.col(c) for c in df.columns])
    pick = F.min_by(packed, F.struct(hash_int(key, seed), F.col(key)))
    return df.groupBy(F.col(task).alias("__task")).agg(pick.alias("__r")).select("__r.*")
