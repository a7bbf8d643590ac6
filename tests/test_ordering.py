"""Distributed numbering, ranks, quantiles and budgets against brute force, over several partitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import ordering as O
from starloom.operators.budget import budget_triggers, spend, spend_each


@pytest.fixture(autouse=True)
def many_partitions(spark):
    """Small inputs would be merged into one partition, which hides mistakes in the offsets."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.fixture
def rows(spark):
    random.seed(3)
    # a third of the rows share one key, some values are missing
    data = [(i, "hot" if i % 3 == 0 else f"k{random.randrange(40)}", None if i % 50 == 0 else float(random.randrange(60))) for i in range(3000)]
    return data, spark.createDataFrame(data, "id long, k string, v double").repartition(5)


def test_number_rows(rows):
    data, df = rows
    got = {r.id: r.n for r in O.number_rows(df, ["k", "id"], "n").collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(data, key=lambda r: (r[1], r[0])))}
    assert got == want


def test_placed_over_several_partitions(rows):
    assert O.ordered_partitions(rows[1], [F.col("id").asc()]).select("__pid").distinct().count() > 1


def test_number_in_groups_with_a_hot_key(rows):
    data, df = rows
    got = {r.id: r.rn for r in O.number_in_groups(df, ["k"], [F.col("id").desc()]).collect()}
    want = {}
    for key in {r[1] for r in data}:
        for i, r in enumerate(sorted((r for r in data if r[1] == key), key=lambda r: -r[0])):
            want[r[0]] = i + 1
    assert got == want


def test_running_total(rows):
    data, df = rows
    out = O.running_total(df.select("id", F.lit(2).alias("w")), [F.col("id").asc()], ["w"]).collect()
    assert all(r.w_before == 2 * r.id for r in out)


@pytest.mark.parametrize("dense", [False, True])
def test_rank_rows(rows, dense):
    data, df = rows
    got = {r.id: r["rank"] for r in O.rank_rows(df.filter("v is not null"), "v", dense=dense).collect()}
    values = [r[2] for r in data if r[2] is not None]
    pool = sorted(set(values) if dense else values, reverse=True)
    assert got == {r[0]: pool.index(r[2]) + 1 for r in data if r[2] is not None}


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.2, 0.4, 0.6, 0.8, 1.0], [0.25, 0.5, 0.75]])
def test_exact_quantiles(spark, rows, probs):
    data, df = rows
    df = df.withColumn("same", F.lit(4.0)).withColumn("empty", F.lit(None).cast("double")).withColumn("id", F.col("id").cast("double"))
    got = O.exact_quantiles(df, ["v", "same", "empty", "id"], probs)
    values = [r[2] for r in data if r[2] is not None]
    assert np.allclose(got["v"], np.quantile(values, probs))
    assert np.allclose(got["id"], np.quantile(range(3000), probs))
    assert got["same"] == [4.0] * len(probs) and got["empty"] == [None] * len(probs)


def test_quantile_bracket_that_misses_is_opened(spark, rows, monkeypatch):
    data, df = rows
    real, calls = O._counts, []

    def shifted(frame, brackets):
        if not calls:  # pretend the approximation was far off
            for k in brackets:
                brackets[k] = (1000.0, 1000.0)
        calls.append(1)
        return real(frame, brackets)

    monkeypatch.setattr(O, "_counts", shifted)
    got = O.exact_quantiles(df, ["v"], [0.5])
    assert len(calls) == 2 and np.allclose(got["v"], np.quantile([r[2] for r in data if r[2] is not None], [0.5]))


def test_budget_over_partitions(spark, rows):
    data, df = rows
    weighted = df.select("id", "k", (F.col("id") % 7 + 1).alias("w"))
    got = {r.id: (r.remaining, r.triggered) for r in budget_triggers(weighted, "k", ["id"], "w", 20).collect()}
    want = {}
    for key in {r[1] for r in data}:
        mine = sorted(r[0] for r in data if r[1] == key)
        left, fired, _ = spend([i % 7 + 1 for i in mine], 20, 20)
        want |= {i: (a, b) for i, a, b in zip(mine, left, fired)}
    assert got == want


def test_budget_refills_fully():
    left, fired, state = spend([60, 60, 60, 10], 150, 150)
    assert left == [90, 30, -30, 140] and fired == [False, False, True, False] and state == 140


def test_agents_in_a_row_begin_with_their_own_budgets():
    weights, starts, entering = np.array([5, 9, 8, 1, 20, 30, 2]), np.array([0, 3, 4]), [6, 20, 3]
    left, fired = spend_each(weights, starts, entering, 20)
    wanted = [spend(part.tolist(), n, 20)[:2] for part, n in zip(np.split(weights, starts[1:]), entering)]
    assert left.tolist() == [x for part, _ in wanted for x in part] and fired.tolist() == [x for _, part in wanted for x in part]
