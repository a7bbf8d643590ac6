"""Vectors, BM25, merging, messages and near duplicates against brute force and known answers."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.operators import dedupe as DD
from starloom.operators import messages as M
from starloom.operators import retrieval as R
from starloom.operators import tiles
from starloom.operators import vectors as V


@pytest.fixture
def store(spark):
    rng = np.random.default_rng(42)
    vectors = rng.normal(size=(120, 5))
    vectors[40:80] = vectors[0]  # a third of the rows are copies
    df = spark.createDataFrame([(i, [float(x) for x in v], i % 4) for i, v in enumerate(vectors)], "id int, vec array<double>, tag int")
    return vectors, df.repartition(4)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("values", [None, 50])
def test_top_k(spark, store, metric, values, monkeypatch):
    vectors, df = store
    if values:  # many tiles of both sides, and steps of one row
        for name in ("TILE_VALUES", "QUERY_VALUES", "SCORES"):
            monkeypatch.setattr(tiles, name, values)
    queries = df.filter("id < 30").select(F.col("id").alias("q"), "vec")
    got = {}
    for r in V.top_k(df, queries, "id", "q", "vec", 7, metric).collect():
        got.setdefault(r.q, []).append((r["rank"], r.id))
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for q in range(30):
        score = -(unit @ unit[q]) if metric == "cosine" else np.linalg.norm(vectors - vectors[q], axis=1)
        want = sorted(range(120), key=lambda i: (round(float(score[i]), 9), i))[:7]
        assert [i for _, i in sorted(got[q])] == want


def test_known_cosines(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0], 1), (2, [1.0, 1.0], 9), (3, [1.0, 0.0], 9)], "id int, vec array<float>, n int")
    q = spark.createDataFrame([(0, [1.0, 1.0])], "q int, vec array<float>")
    got = V.top_k(df, q, "id", "q", "vec", 2, where=F.col("n") >= 8).orderBy("rank").collect()
    assert [(r.id, round(r.score, 6)) for r in got] == [(2, 1.0), (3, 0.707107)]


def test_exclude_self(spark, store):
    _, df = store
    q = df.filter("id < 5").select(F.col("id").alias("q"), "vec")
    assert V.top_k(df, q, "id", "q", "vec", 3, exclude_self=True).filter("q = id").count() == 0


@pytest.mark.parametrize("radius", [0.05, 0.8, 2.0])
def test_near_any(spark, store, radius):
    vectors, df = store
    rng = np.random.default_rng(7)
    moved = vectors + rng.normal(scale=0.2, size=vectors.shape)
    new = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(moved)], "id int, vec array<double>")
    near = {i for i in range(120) if (np.linalg.norm(vectors - moved[i], axis=1) < radius).any()}
    assert {r.id for r in V.near_any(new, df.select("vec"), "vec", radius).collect()} == near
    assert {r.id for r in V.near_any(new, df.select("vec"), "vec", radius, negate=True).collect()} == set(range(120)) - near


@pytest.mark.parametrize("crowd, piece", [(10, 60), (3, 1 << 18)])
def test_near_any_in_split_cells(spark, monkeypatch, crowd, piece):
    """Three clusters, two of them dense, that are equal on the first axes; some rows on the edge of a cell."""
    monkeypatch.setattr(V, "CROWD", crowd)
    monkeypatch.setattr(V, "PIECE_VALUES", piece)
    rng = np.random.default_rng(11)
    centre = np.repeat(np.array([[0, 0, 5.0, -3, 1], [0, 0, -4, 2, 2], [0, 0, 1, 9, -7]]), 70, axis=0)
    points = centre + rng.normal(scale=np.repeat([1.5, 0.01, 0.4], 70)[:, None], size=centre.shape)
    points[:, :2] = 7.0
    moved = np.round(points + rng.normal(scale=0.15, size=points.shape), 2)
    stored = spark.createDataFrame([([float(x) for x in v],) for v in points], "vec array<double>")
    rows = spark.createDataFrame([(i, [float(x) for x in v], i) for i, v in enumerate(moved)] + [(900, None, 1)], "id int, vec array<double>, key int")
    near = {i for i in range(210) if (np.linalg.norm(points - moved[i], axis=1) < 0.4).any()}
    assert 20 < len(near) < 200
    got = V.near_any(rows, stored, "vec", 0.4)
    assert got.columns == rows.columns and {r.id for r in got.collect()} == near
    assert {r.id for r in V.near_any(rows, stored, "vec", 0.4, negate=True).collect()} == {*range(210), 900} - near


def test_upsert_keeps_every_row(spark, store):
    _, df = store
    out = V.upsert(df, df.filter("id < 3").withColumn("tag", F.lit(9)), "id")
    assert out.count() == 120 and out.filter("tag = 9").count() == 3


def test_memory_scores_with_equal_importance(spark):
    t = datetime.datetime(2024, 1, 1)
    rows = [(i, [1.0, float(i)], t, t + datetime.timedelta(hours=i), 5) for i in range(4)]
    m = spark.createDataFrame(rows, "id int, vec array<double>, made timestamp, seen timestamp, imp int")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "q int, vec array<double>")
    got = V.memory_retrieve(m, q, "id", "q", "vec", "made", "seen", "imp", datetime.datetime(2024, 1, 2), k=4).orderBy("rank").collect()
    # importance and recency have no range: half a point each
    assert [r.id for r in got] == [0, 1, 2, 3] and got[0].score == 2.0 and got[3].score == 1.0


def test_a_dropped_collection_is_gone(spark, store, tmp_path):
    folder = str(tmp_path / "vectors")
    store[1].write.parquet(folder)
    assert V.drop(spark, folder) and not V.drop(spark, folder) and not (tmp_path / "vectors").exists()


def test_first_wins(spark):
    a = spark.createDataFrame([(0, 1, 1, 1.0), (0, 2, 2, 0.95)], "q int, d int, rank int, score double")
    b = spark.createDataFrame([(0, 2, 1, 0.95), (0, 3, 2, 0.8)], "q int, d int, rank int, score double")
    assert [r.d for r in R.first_wins([a, b], "q", "d").orderBy("merged_rank").collect()] == [1, 2, 3]


def test_object_order(spark):
    df = spark.createDataFrame([(1, '{"s": 10}'), (2, '{"s": 20}'), (3, '{"s": 5}')], "id int, o string")
    order = lambda n, d: [r.obj_s for r in R.order_by_object_field(df, "o", "s", "int", n, d).collect()]
    assert order(5, True) == [20, 10, 5] and order(5, False) == [5, 10, 20] and order(2, True) == [20, 10]
    for bad in ('{"x": 1}', "not json"):
        with pytest.raises(Exception, match="no s in"):
            R.order_by_object_field(df.union(spark.createDataFrame([(4, bad)])), "o", "s", "int", 5).collect()


def test_bm25_add_clear_count(spark):
    docs = spark.createDataFrame([(1, "red apple"), (2, "green apple pie"), (3, "blue sky"), (4, "")], "id int, t string")
    q = spark.createDataFrame([(0, "apple pie pie")], "q int, t string")
    index = R.BM25Index(docs, "id", "t")
    assert index.count() == 4 and [r.id for r in index.top_k(q, "q", "t").orderBy("rank").collect()] == [2, 1]
    index.add(spark.createDataFrame([(5, "pie pie")], "id int, t string"))
    assert index.count() == 5 and index.top_k(q, "q", "t").filter("id = 5").count() == 1
    assert index.clear().count() == 0 and index.top_k(q, "q", "t").count() == 0


def test_bm25_after_changes_equals_a_new_index(spark):
    random.seed(4)
    words = ["the"] * 20 + [f"w{i}" for i in range(30)]
    rows = [(i, None if i == 7 else " ".join(random.choice(words) for _ in range(random.randrange(0, 20)))) for i in range(90)]
    queries = spark.createDataFrame([(i, " ".join(random.choice(words) for _ in range(5))) for i in range(8)], "q int, t string")
    docs = spark.createDataFrame(rows, "id int, t string")
    index = R.BM25Index(docs.filter("id < 50"), "id", "t", block_docs=6).delete(docs.filter("id % 5 = 1 AND id < 50"))
    index.add(docs.filter("id >= 50")).delete(docs.filter("id % 7 = 2")).delete(docs.filter("id = 3")).add(docs.filter("id = 3"))
    left = docs.filter("NOT (id % 5 = 1 AND id < 50) AND id % 7 <> 2")
    fresh = R.BM25Index(left, "id", "t")
    got, want = ({(r.q, r.id, r["rank"]): r.score for r in i.top_k(queries, "q", "t", 6).collect()} for i in (index, fresh))
    assert got == want and len(got) == 48
    assert index.count() == fresh.count() == left.count() and index.avgdl == fresh.avgdl
    assert sorted(map(tuple, index.terms.collect())) == sorted(map(tuple, fresh.terms.collect()))


def test_best_rows_carried_over_steps():
    rng = np.random.default_rng(3)
    cost = np.round(rng.random((200, 7)), 1)
    cost[rng.random(cost.shape) < 0.2] = np.inf
    cost[:, 6] = np.inf
    best = tiles.Best(9, 7)
    for at in range(0, 200, 13):
        best.add(cost[at:at + 13], at)
    query, row, found = best.kept()
    for q in range(7):
        want = [(c, i) for c, i in sorted((c, i) for i, c in enumerate(cost[:, q])) if np.isfinite(c)][:9]
        assert [(c, i) for c, i in zip(found[query == q], row[query == q])] == want


def test_search_returns_the_vector(spark, store):
    vectors, df = store
    got = V.top_k(df, df.filter("id < 3").select(F.col("id").alias("q"), "vec"), "id", "q", "vec", 2, with_vector=True).collect()
    assert len(got) == 6 and all(list(r.vec) == list(vectors[r.id]) for r in got)


def test_memory_ranges_over_many_tiles(spark, monkeypatch):
    rng = np.random.default_rng(8)
    t = datetime.datetime(2024, 1, 1)
    rows = [(i, [float(x) for x in rng.normal(size=4)], t + datetime.timedelta(hours=int(h)), t + datetime.timedelta(hours=int(h) + i % 3), float(p))
            for i, (h, p) in enumerate(zip(rng.integers(0, 300, 200), rng.integers(0, 9, 200)))]
    m = spark.createDataFrame(rows, "id int, vec array<double>, made timestamp, seen timestamp, imp double")
    asked = [(q, [float(x) for x in rng.normal(size=4)]) for q in range(9)]
    q = spark.createDataFrame(asked, "q int, vec array<double>")
    now = datetime.datetime(2024, 1, 20)
    one = V.memory_retrieve(m, q, "id", "q", "vec", "made", "seen", "imp", now, k=5).collect()
    monkeypatch.setattr(tiles, "TILE_VALUES", 60)
    monkeypatch.setattr(tiles, "QUERY_VALUES", 12)
    many = V.memory_retrieve(m, q, "id", "q", "vec", "made", "seen", "imp", now, k=5).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many)) and len(one) == 45
    vec = np.array([r[1] for r in rows])
    unit = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    scale = lambda x: (x - x.min()) / (x.max() - x.min())
    own = scale(np.array([r[4] for r in rows])) + scale(np.array([0.99 ** ((now - r[2]).days) for r in rows]))
    for i, v in asked:
        total = np.round(own + scale(unit @ (np.array(v) / np.linalg.norm(v))), 9)
        want = sorted(range(200), key=lambda j: (-total[j], -rows[j][3].timestamp(), j))[:5]
        assert [r.id for r in sorted((r for r in one if r.q == i), key=lambda r: r["rank"])] == want


def test_access_times_are_written_back(spark, tmp_path):
    t = datetime.datetime(2024, 1, 1)
    m = spark.createDataFrame([(i, [1.0, float(i)], t, t, 5, "idle" if i == 3 else "awake") for i in range(6)], "id int, vec array<double>, made timestamp, seen timestamp, imp int, key string")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "q int, vec array<double>")
    now = datetime.datetime(2024, 2, 1)
    found, touched = V.focus_retrieve(m, q, "id", "key", now, k=2, query_id="q", vector="vec", created="made", accessed="seen", importance="imp")
    after = V.write_access(m, touched, "id", "seen", str(tmp_path / "v2"))
    assert after.columns == m.columns and {r.id for r in after.collect() if r.seen == now} == {r.id for r in found.collect()} == {0, 1}


def test_latest_and_unseen(spark):
    m = spark.createDataFrame([(i, f"m{i % 5}") for i in range(10)], "seq int, content string")
    assert sorted(r.seq for r in M.latest(m, 3).collect()) == [7, 8, 9] and M.latest(m, 0).count() == 10
    new = spark.createDataFrame([(20, "m0"), (21, "m9"), (22, None)], "seq int, content string")
    assert sorted(r.seq for r in M.unseen(new, m, ["content"]).collect()) == [21, 22]
    assert sorted(r.seq for r in M.unseen(new, m, ["content"], k=2).collect()) == [20, 21, 22]


def test_vote_tie_goes_to_the_first(spark):
    v = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "a", 3), (1, "b", 4), (1, "", 5), (1, None, 6)], "g int, c string, o int")
    assert M.vote_winner(v, "g", "c", "o").first().winner == "b"


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a int, b int")
    got = {r.node: r.root for r in DD.link_components(links).collect()}
    assert set(got[i] for i in range(61)) == {0} and got[101] == 100


def test_near_duplicates(spark):
    base = " ".join(f"word{i} and thing{i * 7 % 13}" for i in range(60))
    rows = [(3, base), (1, base + " tail"), (2, base), (9, "something else entirely, nothing alike here"), (5, base.replace("word7 ", "w7 "))]
    got = {r.id: r.is_kept for r in DD.near_duplicates(spark.createDataFrame(rows, "id int, t string"), "id", "t").collect()}
    assert got == {1: True, 2: False, 3: False, 5: False, 9: True}


def test_near_duplicates_follow_the_greedy_rule(spark):
    from difflib import SequenceMatcher

    path = "/root/testdata/sf0.01/documents.parquet"
    docs = spark.read.parquet(path).filter("length(text) < 700").select("doc_id", "text")
    texts = sorted((r.doc_id, r.text) for r in docs.collect())
    kept = []
    for i, t in texts:
        if not any(2 * min(len(t), len(k)) > 0.8 * (len(t) + len(k)) and SequenceMatcher(None, t, k).ratio() > 0.8 for _, k in kept):
            kept.append((i, t))
    got = DD.near_duplicates(docs, "doc_id", "text").collect()
    mine = {r.doc_id for r in got if r.is_kept}
    by_id = dict(texts)
    for r in got:  # whatever goes is alike a kept text
        assert r.keeper in mine
        assert r.is_kept or SequenceMatcher(None, by_id[r.doc_id], by_id[r.keeper]).ratio() > 0.8
    right = {i for i, _ in kept}
    assert len(got) == len(texts) and len(mine ^ right) <= 0.01 * len(texts)


def test_near_duplicates_of_a_chain(spark):
    from difflib import SequenceMatcher

    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    a, b, c = " ".join(words[:20]), " ".join(words[100:104] + words[4:20]), " ".join(words[100:104] + words[200:204] + words[8:20])
    assert [SequenceMatcher(None, x, y).ratio() > 0.8 for x, y in ((b, a), (c, b), (c, a))] == [True, True, False]
    rows = [(1, a), (2, b), (3, c), (4, None), (5, "")]
    got = {r.id: (r.keeper, r.is_kept) for r in DD.near_duplicates(spark.createDataFrame(rows, "id int, t string"), "id", "t", bands=64, rows=1).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True), 5: (4, False)}


def test_rounds_grow_with_the_logarithm_of_a_bucket(spark, monkeypatch):
    """Unlike texts that share most of their words meet in the same buckets."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    common = [word() for _ in range(60)]
    texts = [" ".join(common[:30] + [word() for _ in range(40)] + common[30:]) for _ in range(70)]
    calls = []
    real = DD.compared
    monkeypatch.setattr(DD, "compared", lambda *a: calls.append(1) or real(*a))
    monkeypatch.setattr(DD, "PREFIX", 4)
    rounds = {}
    for n in (16, 64):
        calls.clear()
        rows = spark.createDataFrame(list(enumerate(texts[:n])), "id int, t string")
        got = DD.near_duplicates(rows, "id", "t", threshold=0.95, bands=32, rows=1).collect()
        assert len(got) == n and all(r.is_kept for r in got)
        rounds[n] = len(calls)
    assert 2 < rounds[64] <= rounds[16] + 2  # a round compares twice at most


def test_recall_merge_is_ranked(spark):
    df = spark.createDataFrame([(1, 1, 0.1), (1, 2, 0.9), (2, 1, 0.1), (2, 2, 0.9), (2, 3, 0.5)], "q int, position int, score double")
    got = {(r.q, r["rank"]): r.position for r in R.recall_merge(df, "q", 2).collect()}
    assert got == {(1, 1): 2, (1, 2): 1, (2, 1): 2, (2, 2): 3}


def test_cached_answers(spark):
    x = spark.createDataFrame([(1, "a", 10, "r1"), (2, "a", 10, "r2"), (3, "b", 9, "r3")], "exp_id int, req string, score int, resp string")
    got = {r.req: (r.hit, r.resp) for r in R.cached_answers(spark.createDataFrame([("a",), ("b",)], "req string"), x, "req").collect()}
    assert got == {"a": (True, "r1"), "b": (False, None)}


def test_index_paths(spark):
    paths = ["/data/uploads", "/data/uploads/a.txt", "/data/chats/ab1/x", "/data/chats/AB", "/data/uploadsx"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(R.index_of_path(F.col("p"))).collect()]
    assert got == ["uploads", "uploads", "chats/ab1", "other", "other"]


@pytest.mark.parametrize("block", [R.BLOCK_DOCS, 4])
def test_bm25_against_brute_force(spark, monkeypatch, block):
    import math
    import random
    from collections import Counter

    random.seed(9)
    words = ["the"] * 30 + [f"w{i}" for i in range(25)]  # a word in nearly every text
    docs = [(i, " ".join(random.choice(words) for _ in range(random.randrange(0, 25)))) for i in range(60)]
    queries = [(i, " ".join(random.choice(words + ["unknown"]) for _ in range(6))) for i in range(12)]
    if block < 10:
        monkeypatch.setattr(R, "QUERY_TERMS", 8)
        monkeypatch.setattr(R, "TILE_DOCS", 12)
    index = R.BM25Index(spark.createDataFrame(docs, "id int, t string").repartition(3), "id", "t", block_docs=block)
    got = {}
    for r in index.top_k(spark.createDataFrame(queries, "q int, t string"), "q", "t", 5).collect():
        got.setdefault(r.q, []).append((r["rank"], r.id, r.score))
    tokens = {i: t.split() for i, t in docs}
    n, avg = len(docs), sum(map(len, tokens.values())) / len(docs)
    df = Counter(w for t in tokens.values() for w in set(t))
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    for q, text in queries:
        scores = []
        for i, t in tokens.items():
            tf = Counter(t)
            shared = [w for w in text.split() if w in tf]
            if shared:
                s = sum(idf[w] * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in shared)
                scores.append((-round(s, 9), i))
        want = [i for _, i in sorted(scores)[:5]]
        assert [i for _, i, _ in sorted(got.get(q, []))] == want


def test_bm25_tiles_stay_small(spark, monkeypatch):
    """A task holds the postings of a tile several times over, so a tile is a few blocks however many documents there are."""
    index = R.BM25Index(spark.createDataFrame([(1, "a b"), (2, "b")], "id int, t string"), "id", "t")
    cuts, meet = [], tiles.meet
    monkeypatch.setattr(tiles, "meet", lambda *a: cuts.append(a[4]) or meet(*a))
    index.n = 3_000_000
    index.top_k(spark.createDataFrame([(1, "a")], "q int, t string"), "q", "t")
    assert index.n / cuts[0][0] <= 4 * R.BLOCK_DOCS


def test_equal_vectors_are_at_distance_zero(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 16)) * 1e3)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    got = V.top_k(df, df.select(F.col("id").alias("q"), "v"), "id", "q", "v", 1, "l2", digits=12).collect()
    assert len(got) == 300 and all(r.id == r.q and r.score == 0 for r in got)


def test_parent_cycles_are_named(spark):
    from starloom.operators import graph as G

    nodes = spark.createDataFrame([("a", "b", 1.0, 1), ("b", "a", 1.0, 1), ("c", None, 0.5, 2)], "node string, parent string, value double, visits int")
    with pytest.raises(ValueError, match="cycle"):
        G.reject_cycles(nodes.select("node", F.col("parent").alias("up")))
    G.reject_cycles(nodes.filter("node = 'c'").select("node", F.col("parent").alias("up")))


def test_l2_keeps_every_tie_and_close_rows_of_large_norm(spark):
    draw = np.random.default_rng(4)
    order = draw.permutation(200)
    same = [(int(i), [3.0, 1.0 + 1e-13 * int(i % 7), 2.0] if i < 100 else [4.0 + float(i), 0.0, 0.0]) for i in order]
    close = [(1000 + int(i), [1e6, 1e6, 1e6 + 1e-3 * int(i + 1)]) for i in order]
    store = spark.createDataFrame([*same, *close], "id long, v array<double>").coalesce(1)
    asked = spark.createDataFrame([(1, [3.0, 1.0, 2.0]), (2, [1e6, 1e6, 1e6])], "q long, v array<double>")
    got = V.top_k(store, asked, "id", "q", "v", k=5, metric="l2").collect()
    assert sorted(r.id for r in got if r.q == 1) == [0, 1, 2, 3, 4]
    assert sorted(r.id for r in got if r.q == 2) == [1000, 1001, 1002, 1003, 1004]


def test_near_vectors_are_looked_for_in_bounded_matrices(monkeypatch):
    import numpy as np
    import pyarrow as pa

    from starloom.operators import vectors

    rng = np.random.default_rng(4)
    stored, probes = rng.normal(size=(2000, 3)), rng.normal(size=(1500, 3))
    side = lambda name, m: pa.table({name: m.tolist(), "__cell": [1] * len(m)})
    sizes, whole = [], vectors._any_within
    monkeypatch.setattr(vectors, "_any_within", lambda some, near, radius: sizes.append(len(some) * len(near)) or whole(some, near, radius))
    got = vectors._near(0.1)(side("s", stored), side("p", probes))
    near = (np.linalg.norm(probes[:, None] - stored[None], axis=2) < 0.1).any(axis=1)
    assert got["p"].to_pylist() == probes[near].tolist() and 0 < near.sum() < 1500
    assert max(sizes) <= 1 << 19 and sum(sizes) == 2000 * 1500
