"""Preprocessing and feature tools on the small frames of the requirements, plus edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import features as FE
from starloom.operators import scaling as SC


@pytest.fixture
def small(spark):
    rows = [(1.0, "A", "2020-01-01"), (2.0, "B", "2020-01-02"), (None, None, "2020-01-03"), (4.0, "D", "2020-01-04"), (5.0, "A", "2020-01-05")]
    return spark.createDataFrame(rows, "num1 double, cat1 string, date1 string").withColumn("date1", F.to_timestamp("date1"))


@pytest.fixture
def wide(spark):
    rows = list(zip([1.0, 2.0, None, 4.0, 5.0, 6.0, 7.0, 3.0], [1.0, 3.0, 2.0, 1.0, None, 5.0, 6.0, 4.0], [None] * 8, ["A", "B", None, "D", "E", "C", "B", "A"], ["A"] * 8,
                    [f"2020-01-0{i}" for i in range(1, 9)], [0, 1] * 4))
    return spark.createDataFrame([tuple(r) for r in rows], "num1 double, num2 double, num3 double, cat1 string, cat2 string, date1 string, label int")


def column(df, name):
    return [r[0] for r in df.select(f"`{name}`").collect()]


def test_fill_mean(small):
    assert column(SC.FillMissingValue(["num1"]).fit_transform(small), "num1") == [1, 2, 3, 4, 5]


def test_fill_mode_prefers_the_smallest(small):
    assert column(SC.FillMissingValue(["num1"], "most_frequent").fit_transform(small), "num1")[2] == 1.0


def test_fill_text_by_mean_raises(small):
    with pytest.raises(ValueError):
        SC.FillMissingValue(["cat1"]).fit(small)


def test_min_max(small):
    got = column(SC.MinMaxScale(["num1"]).fit_transform(small.fillna(3.0)), "num1")
    assert min(got) == 0 and max(got) == 1


def test_standard(small):
    got = column(SC.StandardScale(["num1"]).fit_transform(small.fillna(3.0)), "num1")
    assert int(np.mean(got)) == 0 and np.isclose(np.std(got), 1)


def test_max_abs(small):
    assert max(abs(v) for v in column(SC.MaxAbsScale(["num1"]).fit_transform(small.fillna(3.0)), "num1")) == 1


def test_robust(small):
    assert int(np.median(column(SC.RobustScale(["num1"]).fit_transform(small.fillna(3.0)), "num1"))) == 0


def test_ordinal(small):
    assert max(v for v in column(SC.OrdinalEncode(["cat1"]).fit_transform(small), "cat1") if v is not None) == 2


def test_ordinal_unseen_raises(spark, small):
    tool = SC.OrdinalEncode(["cat1"]).fit(small)
    with pytest.raises(Exception, match="unseen value"):
        tool.transform(spark.createDataFrame([("Z",)], "cat1 string")).collect()


def test_one_hot(small):
    out = SC.OneHotEncode(["cat1"]).fit_transform(small)
    assert out.columns == ["num1", "date1", "cat1_A", "cat1_B", "cat1_D", "cat1_nan"]
    assert column(out, "cat1_A") == [1, 0, 0, 0, 1]


def test_one_hot_unknown_is_all_zero(spark, small):
    row = SC.OneHotEncode(["cat1"]).fit(small).transform(spark.createDataFrame([("Z",)], "cat1 string")).first()
    assert set(row) == {0.0}


def test_label(spark, small):
    tool = SC.LabelEncode(["cat1"]).fit(small)
    assert max(column(tool.transform(small), "cat1")) == 3
    assert max(column(tool.transform(spark.createDataFrame([(c,) for c in "ABCDE"], "cat1 string")), "cat1")) == 4


def test_empty_feature_list_changes_nothing(small):
    assert SC.MinMaxScale([]).fit_transform(small) is small


def test_column_families(small):
    assert SC.column_families(small) == {"Category": ["cat1"], "Numeric": ["num1"], "Datetime": ["date1"], "Others": []}


def test_long_numeric_list_is_whole(spark):
    df = spark.range(1).select(*[F.lit(1).alias(f"a_rather_long_name_{i}") for i in range(120)])
    assert len(SC.column_families(df)["Numeric"]) == 120


def test_polynomial(wide):
    out = FE.PolynomialExpansion(["num1", "num2", "label"], "label").fit_transform(wide)
    assert len(out.columns) == len(wide.columns) + 3
    assert {"num1^2", "num1 num2", "num2^2"} <= set(out.columns)


def test_polynomial_keeps_ten_best(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 12))
    y = x[:, :10] @ np.arange(1, 11) * 1.0
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], ", ".join(f"c{i} double" for i in range(12)) + ", y double")
    tool = FE.PolynomialExpansion([f"c{i}" for i in range(12)], "y", most=10).fit(df)
    order = sorted(range(12), key=lambda i: -abs(np.corrcoef(x[:, i], y)[0, 1]))[:10]
    assert tool.features == [f"c{i}" for i in order]
    assert len(FE.PolynomialExpansion([f"c{i}" for i in range(12)], "y").fit(df).features) == 12


def test_counts_and_means(wide):
    assert column(FE.CatCount("cat1").fit_transform(wide).orderBy("date1"), "cat1_cnt")[:3] == [2, 2, None]
    assert column(FE.TargetMeanEncoder("cat1", "label").fit_transform(wide).orderBy("date1"), "cat1_target_mean")[0] == 0.5


def test_cross(wide):
    out = FE.CatCross(["cat1", "cat2"]).fit_transform(wide)
    assert len(set(column(out, "cat1_cat2"))) == 6
    assert "cat1_cat2" not in FE.CatCross(["cat1", "cat2"], max_cat_num=3).fit_transform(wide).columns


def test_cross_of_many_categories(spark):
    rows = [(i % 3, i if i else None) for i in range(250)]
    out = FE.CatCross(["a", "b"]).fit_transform(spark.createDataFrame(rows, "a int, b int").repartition(3)).collect()
    assert sorted((r.a, r.b or 0, r.a_b) for r in out) == sorted((a, b or 0, a * 250 + (249 if b is None else b - 1)) for a, b in rows)


def test_cross_unseen(spark, wide):
    tool = FE.CatCross(["cat1", "cat2"]).fit(wide)
    assert tool.transform(spark.createDataFrame([("Z", "A")], "cat1 string, cat2 string")).first().cat1_cat2 == 6


def test_group_stat(wide):
    out = FE.GroupStat("cat1", "num1", ["mean", "std"]).fit_transform(wide).orderBy("date1").collect()
    assert out[0].num1_mean_by_cat1 == 2.0 and np.isclose(out[0].num1_std_by_cat1, np.std([1, 3], ddof=1)) and out[2].num1_mean_by_cat1 is None


@pytest.mark.parametrize("strategy", ["quantile", "uniform", "kmeans"])
def test_bins(wide, strategy):
    got = column(FE.SplitBins(["num1"], strategy).fit_transform(wide), "num1")
    assert set(got) <= {0, 1, 2, 3, 4} and max(got) == 4


def test_kmeans_edges_against_numpy(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(m, 0.3, 40) for m in (0, 5, 9)])
    centres = values.min() + (values.max() - values.min()) / 3 * (np.arange(3) + 0.5)
    for _ in range(300):
        near = np.abs(values[:, None] - centres[None, :]).argmin(axis=1)
        moved = np.array([values[near == k].mean() for k in range(3)])
        if ((moved - centres) ** 2).sum() <= 1e-4 * values.var():
            centres = moved
            break
        centres = moved
    got = FE.kmeans_edges(spark.createDataFrame([(float(v),) for v in values], "v double"), "v", 3)
    assert np.allclose(got[1:-1], (np.sort(centres)[1:] + np.sort(centres)[:-1]) / 2)


def test_time_parts(wide):
    row = FE.ExtractTimeComps("date1").fit_transform(wide).orderBy("date1").first()
    assert (row.year, row.month, row.day, row.hour, row.dayofweek, row.is_weekend) == (2020, 1, 1, 0, 3, 0)


def test_general_selection(wide):
    kept = FE.GeneralSelection("label").fit_transform(wide).columns
    assert "num3" not in kept and "cat2" not in kept and "date1" not in kept and kept[-1] == "label"


def test_variance_selection(wide):
    assert FE.VarianceBasedSelection("label").fit_transform(wide).columns == ["num1", "num2", "label"]


def test_tree_selection(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"), (F.col("id") > 100).cast("int").alias("label"))
    for task in ("cls", "mcls", "reg"):
        assert FE.TreeBasedSelection("label", task, trees=2, depth=2).fit_transform(df).columns == ["a", "label"]


def test_sample_and_complement(spark):
    df = spark.range(100)
    a, b = FE.seeded_sample(df, "id", 10, 1)
    assert a.count() == 10 and b.count() == 90 and a.join(b, "id").count() == 0


def test_split_sizes_and_target_views(spark):
    split = FE.split_train_dev_test(spark.range(5000).withColumn("y", F.col("id") % 2), "id")
    n = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert abs(n["train"] - 3000) < 200 and abs(n["dev"] - 1000) < 150 and abs(n["test"] - 1000) < 150
    views = FE.target_views(split, "y")
    assert views["dev_target"].columns == ["target"] and views["test_wo_target"].columns == ["id"]


def test_metric_names():
    assert [SC.metric_for_classes(n) for n in (0, 2, 3, 200, 201)] == ["rmse", "f1 binary", "f1 weighted", "f1 weighted", "rmse"]
    with pytest.raises(ValueError):
        SC.metric_for_classes(1)


@pytest.mark.parametrize("n", [0, 1, 50, 99, 100, 500])
def test_sample_sizes(spark, n):
    df = spark.range(100)
    a, b = FE.seeded_sample(df, "id", n, 3)
    order = [r.id for r in df.orderBy(FE.hash_int("id", 3), "id").collect()]
    assert sorted(r.id for r in a.collect()) == sorted(order[:n]) and sorted(r.id for r in b.collect()) == sorted(order[n:])
