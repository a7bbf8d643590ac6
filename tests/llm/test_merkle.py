"""The Merkle manifest against plain trees, with few and many rounds, and on awkward rows."""

import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, grp string, pos string, _grp string, root string"


def hashed(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(level):
    """All levels of a tree from its leaves up."""
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([hashed(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_steps(levels, at):
    for level in levels[:-1]:
        yield [h for i, h in enumerate(level) if i // 2 == at // 2 and i != at], at % 2
        at //= 2


def plain_report(rows):
    groups = defaultdict(list)
    for i, text, lang, source, n in rows:
        code = lambda n: hashed(*[field(v) for v in (i, source, lang, n, text)])
        changed = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
        groups[lang].append((i is None, i or 0, code(n), code(n + 1) if changed else code(n), i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([r[2] for r in sorted(groups[g], key=lambda r: r[:3])]) for g in names}
    top = plain_tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for at, (_, _, leaf, used, i) in enumerate(sorted(groups[g], key=lambda r: r[:3])):
            proof, fold = "", used
            for others, right in [*plain_steps(trees[g], at), *plain_steps(top, k)]:
                proof += "".join(others)
                fold = hashed(*others, fold) if right else hashed(fold, *others)
            out.append((i, leaf, trees[g][-1][0], top[-1][0], hashed(proof), fold, fold == top[-1][0]))
    return sorted(out, key=repr)


def report(docs, height):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in columns) for r in merkle.manifest_report(docs, height).collect()), key=repr)


def awkward_rows():
    rows = [(i, f"text {i % 5}", ["de", "en", None, "ü", "", "z"][i % 6 if i % 3 else 1], f"s{i % 2}", i) for i in range(-3, 60)]
    rows += [(5, None, "en", None, None), (5, None, "en", None, None), (5, "x", "en", None, None), (None, None, None, None, None), (None, "", "en", "s", 3)]
    return [*rows, (7, "long " * 50_000, "en", "s1", 250_000), (8, "straße 😀", "alone", "", 2)]


@pytest.mark.parametrize("height", [1, 3, 10])
def test_report_equals_plain_trees(spark, height):
    rows = awkward_rows()
    docs = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], DOCS).repartition(5)
    got = report(docs, height)
    assert got == plain_report(rows)
    assert {r[6] for r in got} == {True, False}


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "a", "en", "s", 1, "", "", "", "")], DOCS)
    assert report(one, 10) == plain_report([(1, "a", "en", "s", 1)])
    assert report(one.limit(0), 10) == []


@pytest.mark.parametrize("levels", range(1, 9))
def test_layout_is_recursive_and_complete(levels):
    at = {(d, i): int(merkle.places(levels, d, np.array([i]))[0]) for d in range(levels) for i in range(1 << d)}
    assert sorted(at.values()) == list(range((1 << levels) - 1))
    # the upper half comes first, then each lower subtree in one piece
    half = levels // 2
    assert all(p < (1 << half) - 1 for (d, _), p in at.items() if d < half)
    for root in range(1 << half):
        own = sorted(p for (d, i), p in at.items() if d >= half and i >> (d - half) == root)
        assert own == list(range(own[0], own[0] + len(own)))


def test_proofs_carry_their_siblings(spark):
    leaves = spark.range(70).select(F.lit("g").alias("grp"), F.col("id").alias("key"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.lit(None).cast("binary").alias("other"))
    manifest = merkle.build_manifest(leaves, height=2)
    rows = manifest.proofs().collect()
    assert len(manifest.groups.rounds) == 4 and len(rows) == 70
    assert all(merkle.folded(bytes(r.digest), r.sides, bytes(r.path)) == manifest.root for r in rows)
    changed = bytes(32)
    assert all(merkle.folded(changed, r.sides, bytes(r.path)) != manifest.root for r in rows)
