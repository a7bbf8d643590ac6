"""Token alignment against a plain walk over both token lists."""

from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest

from starloom.llm import alignment

DOCS = "doc_id long, text string, row long, pairs string, best string, count long"
A_PATH, B_PATH = f"{alignment.FOLDER}/{alignment.BYTE_LEVEL}", f"{alignment.FOLDER}/{alignment.PIECES}"


@pytest.fixture(scope="module")
def sides():
    return alignment.Side(A_PATH), alignment.Side(B_PATH)


def tokens(side, text):
    return [(i, side.tool.bytes[i]) for i in side.tool.encode([text])[0]]


def walk(a, b):
    """Groups and links by stepping along the bytes."""
    ends = lambda ts: list(np.cumsum([len(x) for _, x in ts]))
    ea, eb = ends(a), ends(b)
    common = sorted(set(ea) & set(eb))
    links = [(a[i][0], b[j][0]) for i, x in enumerate(ea) for j, y in enumerate(eb) if x == y] if len(a) < 400 else [(a[ea.index(c)][0], b[eb.index(c)][0]) for c in common]
    groups, la, lb = [], 0, 0
    for c in common:
        ia, ib = ea.index(c) + 1, eb.index(c) + 1
        groups.append(",".join(str(t) for t, _ in a[la:ia]) + "|" + ",".join(str(t) for t, _ in b[lb:ib]))
        la, lb = ia, ib
    return groups, links


def brute(sides, rows):
    parts, counts = [], Counter()
    for i, text in rows:
        a = b = []
        if text:
            a, b = tokens(sides[0], text), tokens(sides[1], text)
            whole = (" " + text).encode()
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a = b = []
        groups, links = walk(a, b)
        counts.update(links)
        parts.append((i, len(a), len(b), groups, links))
    top = defaultdict(int)
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted(((i, na, nb, len(g), len(ls), sum(counts[p] == top[p[1]] for p in ls), sum(counts[p] for p in ls),
                    sha256(";".join(g).encode()).hexdigest() if g else "") for i, na, nb, g, ls in parts), key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def report(docs):
    return sorted((tuple(r[c] for c in COLUMNS) for r in alignment.alignment_report(docs).collect()), key=repr)


TEXTS = [None, "", " ", "  two  spaces ", "Hello world", "Hello world", "naïve café 😀😀", "▁ is a space elsewhere", "<|endoftext|> and <s> are text", "a\nb\tc\r\n", "x" * 3000, "数据 処理 данные",
         "\u0000", "e\u0301", "1234567890 12 123", "tokenization of unbelievable words " * 40, "<0x41>"]


def test_report_equals_a_plain_walk(spark, sides, monkeypatch):
    rows = [(None if k % 6 == 5 else k // 2, t) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame([(*r, 1, "a", "b", 2) for r in rows], DOCS).repartition(4)
    assert report(docs) == brute(sides, rows)
    assert report(docs.limit(0)) == []


def test_real_texts_and_small_chunks(spark, sides):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("length(text) < 3000")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert report(docs) == brute(sides, rows)


def test_counts_handed_on_early_add_up(sides, monkeypatch):
    import pyarrow as pa

    texts = [f"the tokenizers {k} disagree on {k * 7} words" for k in range(200)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(200)), "text": pa.array(texts)})

    def totals():
        out = Counter()
        for rows in alignment.align_rows(A_PATH, B_PATH, True)([batch]):
            for r in rows.to_pylist():
                if r["tally"]:
                    out.update(dict(zip(r["pairs"], r["times"], strict=True)))
        return out

    whole = totals()
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 300)
    monkeypatch.setattr(alignment, "TALLY", 10)
    assert totals() == whole and sum(whole.values()) > 1000


def test_overlaps_expand_within_groups(sides):
    a, b = [[0, 1, 2, 3]], [[0, 1, 2]]

    class Fixed:
        def __init__(self, *lengths):
            self.lengths = np.array(lengths)

    found = alignment.align(a, b, Fixed(2, 3, 1, 4), Fixed(5, 2, 3), ends_only=False)
    assert found.a_group.tolist() == [0, 0, 1, 1] and found.b_group.tolist() == [0, 1, 1]
    assert list(zip(found.one.tolist(), found.two.tolist(), strict=True)) == [(0, 0), (1, 0), (2, 1), (3, 1), (3, 2)]
    ends = alignment.align(a, b, Fixed(2, 3, 1, 4), Fixed(5, 2, 3), ends_only=True)
    assert list(zip(ends.one.tolist(), ends.two.tolist(), strict=True)) == [(1, 0), (3, 2)]


def test_fast_ids_are_the_library_ids(sides):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(A_PATH)
    library.encode_special_tokens = True
    some = [c for c in range(0, 0x110000, 97) if not 0xD800 <= c < 0xE000]
    texts = [t for t in TEXTS if t] + [f"x{chr(c)}1{chr(c)} {chr(c)}{chr(c)}  {chr(c)}y" for c in some]
    assert sides[0].tool.encode(texts) == [library.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert sides[0].tool.bytes[50256] == b"<|endoftext|>" and sides[0].tool.bytes[262] == b" the"


@pytest.mark.parametrize("text", ["x" * 300_000, " " * 300_000, "ab " * 100_000, "é" * 100_000, "1" * 200_000 + "!" * 200_000])
def test_long_runs(sides, text):
    assert sides[0].exact(text, sides[0].tool.encode([text])[0])


def test_letters_of_bytes():
    letters = alignment.byte_letters()
    assert len(letters) == 256 and sorted(letters.values()) == list(range(256))
    assert letters["Ġ"] == 32 and letters["Ċ"] == 10 and letters["a"] == 97
