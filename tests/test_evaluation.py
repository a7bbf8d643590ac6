"""Scores, rounds, trees and graphs against brute force and known answers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import evals as E
from starloom.operators import graph as G
from starloom.operators import rounds as RO


def test_f1_known(spark):
    df = spark.createDataFrame([("the cat sat", "A cat sat down"), ("", "x"), ("a", "the")], "p string, e string")
    got = [r[0] for r in df.select(E.text_f1(F.col("p"), F.col("e"))).collect()]
    assert got == [pytest.approx(0.8), 0.0, 0.0]


def test_best_f1_skips_blank_answers(spark):
    row = E.best_f1(spark.createDataFrame([(1, "no|blue sky", " |blue sky|red")], "k int, p string, e string"), "k", "p", "e").first()
    assert row.score == 1.0 and not row.is_mismatch


def test_answer_scores_literal_and_fixed(spark):
    p = spark.createDataFrame([(1, "{@a[1.0] @b[Yes] @c[3]}")], "k int, prediction string")
    labels = spark.createDataFrame([(1, [["a", "1"], ["b", "yes"], ["c", "4"], ["d", "x"]])], "k int, common_answers array<array<string>>")
    score = lambda literal: {r.metric: r.is_correct for r in E.score_answers(p, labels, "k", literal).collect()}
    assert score(False) == {"a": True, "b": True, "c": False, "d": False}
    assert score(True) == {"a": True, "b": False, "c": False, "d": False}


def test_three_accuracies(spark):
    rows = [(1, True), (1, True), (2, True), (2, False), (3, False)]
    got = E.three_accuracies(spark.createDataFrame(rows, "k int, is_correct boolean"), "k").first()
    assert tuple(got) == (0.3333, 0.6, 0.5)


def test_auc_with_ties(spark):
    rng = np.random.default_rng(0)
    y, s = rng.integers(0, 2, 200), rng.integers(0, 15, 200).astype(float)
    wins = [(1.0 if a > b else 0.5 if a == b else 0.0) for a in s[y == 1] for b in s[y == 0]]
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    assert E.roc_auc(df, "y", "s").first()[0] == pytest.approx(np.mean(wins))


def test_classes_other_than_zero_one(spark):
    rows = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("b", "c")]
    got = E.classification_scores(spark.createDataFrame(rows, "t string, p string").select(
        (F.ascii("t") - 92).alias("t"), (F.ascii("p") - 92).alias("p")), "t", "p").first()
    # classes 5, 6 and a predicted 7: the smaller of the two true classes is the positive one
    assert got.accuracy == pytest.approx(0.6) and got.f1 == pytest.approx(2 / 3) and got.f1_weighted == pytest.approx(2 / 3 * 0.4 + 2 / 3 * 0.6)


def test_retrieval_scores(spark):
    found = spark.createDataFrame([(1, 1, "zz"), (1, 2, "cat"), (2, 1, "cat")], "q int, rank int, text string")
    refs = spark.createDataFrame([(1, "a cat"), (1, "a dog"), (2, "x"), (3, "y")], "q int, reference string")
    got = {r.q: (r.recall, r.hit_rate, r.mrr) for r in E.retrieval_scores(found, refs, "q").collect()}
    assert got == {1: (0.5, 1.0, 0.5), 2: (0.0, 0.0, 0.0), 3: (0.0, 0.0, 0.0)}


def test_costs(spark):
    prices = spark.createDataFrame([("m", 0.01, 0.03)], "model string, prompt_price double, completion_price double")
    use = spark.createDataFrame([("m", 1000, 100), ("m", 100, 10), ("?", 50, 5), ("", 9, 9), ("m", 0, 0)], "model string, prompt_tokens long, completion_tokens long")
    got = E.token_costs(use.withColumn("run", F.lit(1)), prices, "model", ["run"]).first()
    assert got.total_cost == pytest.approx(0.0143) and got.prompt_tokens == 1150 and got.completion_tokens == 115


def test_votes(spark):
    call = "['Player1', 'Player2']. Say ONLY: I vote to eliminate ...\n"
    lines = ["Player1(Witch): 49 | I vote to eliminate Player5", "Player2(Villager): 49 | I vote to eliminate Player5", "Player3(Villager): 49 | I vote to eliminate Player5",
             "Player5(Werewolf): 49 | I vote to eliminate Player6", "Player6(Seer): 49 | I vote to eliminate Player5"]
    second = [line.replace("eliminate Player5", "eliminate Player1") if "Seer" in line or "Witch" in line or "Player2" in line else line for line in lines]
    log = call + "\n".join(lines) + "\n" + call + "\n".join(second)
    got = {r.vote_round: r for r in E.vote_report(spark.createDataFrame([("f", "g.txt", log)], "folder string, file string, log string"), "folder", "file", "log").collect()}
    assert got["vote_1"].good_vote_rate == 1.0 and got["vote_1"].difficulty == "_1 / 5" and got["vote_2"].good_vote_rate == 0.25
    assert got["vote_1"].avg_rate == 0.625 and got["vote_1"].vote1_rate == 1.0 and got["vote_2"].vote1_rate is None


@pytest.mark.parametrize("low", [False, True])
def test_run_summary(spark, low):
    runs = spark.createDataFrame([(0, 0.5, 0.4), (1, -1.0, 0.1), (2, 0.9, 0.7), (3, 0.9, 0.8)], "i int, dev_score double, test_score double")
    got = E.run_summary(runs, "i", low).first()
    assert tuple(got) == ((0.5, 0, 0.4, 0.5, 0.4) if low else (0.9, 2, 0.7, 0.5, 0.8))


def reference_convergence(scores, stds, k, z, n):
    if len(scores) < k + 1:
        return (False, None, None)
    count, before = 0, None
    for i in range(len(scores)):
        top = sorted(range(i + 1), key=lambda j: (scores[j], j), reverse=True)[:k]
        y, err = np.mean([scores[j] for j in top]), np.sqrt(sum(stds[j] ** 2 for j in top)) / k
        if before is not None:
            if abs(y - before[0]) <= z * np.sqrt(err**2 + before[1] ** 2):
                count += 1
                if count >= n:
                    return (True, i - n + 1, i)
            else:
                count = 0
        before = (y, err)
    return (False, None, None)


@pytest.mark.parametrize("seed,k,z,n", [(0, 3, 0, 5), (1, 3, 0.2, 2), (2, 2, 0.05, 3), (3, 5, 0, 4), (4, 30, 1, 2)])
def test_convergence_over_partitions(spark, seed, k, z, n):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = np.random.default_rng(seed)
        scores, stds = rng.integers(0, 12, 25) / 10.0, rng.uniform(0, 1, 25)
        df = spark.createDataFrame([(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(scores, stds))], "round int, avg_score double, std_score double")
        got = RO.convergence(df.repartition(5), k, z, n).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(got) == reference_convergence(scores, stds, k, z, n)


def test_top_rounds_takes_two_for_sample_one(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.5), (3, 0.9)], "round int, avg_score double")
    assert sorted(r["round"] for r in RO.top_rounds(df, 1).collect()) == [1, 3]
    assert sorted(r["round"] for r in RO.top_rounds(df, 2).collect()) == [1, 3]
    assert sorted(r["round"] for r in RO.top_rounds(df.filter("round > 1"), 1).collect()) == [3]


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(i, i / 10) for i in range(8)], "round int, s double")
    assert RO.mixed_probabilities(df, "s").agg(F.sum("probability")).first()[0] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        RO.mixed_probabilities(df.limit(0), "s")


def test_levels_report_cycles(spark):
    nodes = spark.createDataFrame([(n,) for n in "abcdxyz"], "node string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("y", "z")], "src string, dst string")
    assert {r.node: r.level for r in G.dependency_levels(nodes, edges).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3, "x": None, "y": None, "z": None}


def test_reachable_with_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("d", "e")], "src string, dst string")
    assert {r.node: r.depth for r in G.reachable(edges, spark.createDataFrame([("a",)], "node string")).collect()} == {"a": 0, "b": 1, "c": 2}


def test_tree_totals_and_best(spark):
    random.seed(1)
    rows = [(0, None, 0, 1.0, 1, 0.5)] + [(i, (i - 1) // 3, i, float(random.randrange(9)), 1, float(random.randrange(4))) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "node int, parent int, place int, value double, visits long, score double")
    below = {i: [i] for i in range(40)}
    for i in range(39, 0, -1):
        below[(i - 1) // 3] += below[i]
    value = {r[0]: r[3] for r in rows}
    got = {r.node: (r.value, r.visits) for r in G.node_totals(df).collect()}
    assert got == {i: (sum(value[j] for j in below[i]), len(below[i])) for i in range(40)}

    def preorder(i):
        return [i] + [x for c in range(3 * i + 1, 3 * i + 4) if c < 40 for x in preorder(c)]

    score = {r[0]: r[5] for r in rows}
    best = max(score.values())
    assert G.best_node(df, "score").first().node == next(i for i in preorder(0) if score[i] == best)


def test_unvisited_node_score(spark):
    totals = spark.createDataFrame([("r", 3.0, 3), ("a", 2.0, 2), ("b", 0.8, 0)], "node string, value double, visits long")
    parents = spark.createDataFrame([("r", None), ("a", "r"), ("b", "r")], "node string, parent string")
    got = {r.node: r.uct for r in G.upper_confidence(totals, parents).collect()}
    assert got["b"] == pytest.approx(1.0 + 1.4 * np.sqrt(np.log(3) / 0.8)) and got["a"] == pytest.approx(1.0 + 1.4 * np.sqrt(np.log(3) / 2))


def test_triples(spark):
    t = spark.createDataFrame([("a", "p", "b", 1), ("a", "q", "b", 2), ("a", "p", "c", 3)], "subject string, predicate string, object string, seq long")
    last = G.last_edges(t)
    assert G.select(last, subject="a").count() == 2 and G.select(last, predicate="p").first().object == "c" and G.select(last).count() == 2
    rest, n = G.delete(last, predicate="q")
    assert n == 1 and rest.count() == 1 and G.delete(last)[1] == 0


def test_resolve_leaves_ambiguous_names(spark):
    rows = [("f:A", "is", "class"), ("g:A", "is", "class"), ("f:B", "is", "class"), ("x", G.IS_COMPOSITE_OF, "?:A"), ("x", G.IS_COMPOSITE_OF, "?:B"), ("x", G.IS_COMPOSITE_OF, "f:B")]
    out = G.resolve_names(spark.createDataFrame(rows, "subject string, predicate string, object string")).filter("subject = 'x'")
    assert sorted(r.object for r in out.collect()) == ["?:A", "f:B", "f:B"]
