"""Which tokens of one vocabulary stand for which tokens of another, by interval coalescing.

Both tokenizers cut the same bytes.  All tokens of a batch of texts lie on one axis of bytes,
are sorted by their start, and a running maximum of their ends is kept: a group breaks where a
start reaches it, which is where a token of either side ends.  Overlaps of the two sides then
expand within the groups.  Links are counted by pair of ids over all texts; tasks add up their
own counts before anything is shuffled.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructType

from starloom.llm.common import saved
from starloom.session import small_side

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 20  # of text in one pass; a longer text is a pass of its own
TALLY = 1 << 19  # different pairs that a task holds before it hands on their counts


def byte_letters() -> dict[str, int]:
    """The letter of every byte in a byte-level vocabulary: itself where it prints, else the next one from U+0100."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


# Fixed value: how a byte-level file with ``use_regex`` cuts a text before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """A byte-level BPE file; strings of special tokens are plain text.

    Where the ids of the file are in the order of its merges and nothing but the usual cut comes
    before them, they are the ranks that tiktoken merges by, which is five times faster and gives
    the same ids; any other file is left to the tokenizers library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        letters = byte_letters()
        vocabulary = held["model"]["vocab"]
        added = {t["content"]: t["id"] for t in held.get("added_tokens") or []}
        self.bytes = [b""] * (max([*vocabulary.values(), *added.values()]) + 1)
        for token, i in (vocabulary | added).items():
            self.bytes[i] = bytes(letters[c] for c in token) if token not in added and all(c in letters for c in token) else token.encode()
        cut = held.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in held["model"]["merges"]]
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not held.get("normalizer")
        plain = plain and sorted(vocabulary[x] for x in letters) == list(range(256)) and all(vocabulary.get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
        if plain:
            import tiktoken

            ranks = {self.bytes[i]: i for token, i in vocabulary.items() if token not in added}
            tool = tiktoken.Encoding("file", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
            self.one = tool.encode_ordinary
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tool = Tokenizer.from_file(path)
            tool.encode_special_tokens = True
            self.one = lambda text: tool.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.one(" " + t) for t in texts]


class Pieces:
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self.entry(i) for i in range(self.tool.get_piece_size())]

    def entry(self, i: int) -> bytes:
        piece = self.tool.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.tool.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tool.encode(texts, num_threads=1)


def vocabulary(path: str):
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


@dataclass
class Side:
    """A vocabulary with its lengths and the ids as text, followed by each separator."""

    path: str
    tool: object = field(init=False)

    def __post_init__(self):
        self.tool = vocabulary(self.path)
        self.lengths = np.array([len(b) for b in self.tool.bytes], dtype=np.int64)
        self.names = {sep: np.array([f"{i}{sep}" for i in range(len(self.lengths))], dtype=object) for sep in ",|;"}

    def exact(self, text: str, ids: list[int]) -> bool:
        """Whether the tokens are the text after a space, byte by byte."""
        known = self.tool.bytes
        return b"".join(map(known.__getitem__, ids)) == b" " + text.encode()


def coalesced(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The group of every interval: those that touch by more than an edge, or through others, are one."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    new = np.zeros(len(order), dtype=np.int64)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(new)
    return group


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of intervals that share a byte; each side is sorted and without overlaps of its own."""
    low = np.searchsorted(b_end, a_start, side="right")
    count = np.searchsorted(b_start, a_end, side="left") - low
    one = np.repeat(np.arange(len(a_start)), count)
    return one, np.arange(len(one)) - np.repeat(np.cumsum(count) - count, count) + low[one]


@dataclass
class Aligned:
    """Texts of a chunk on one axis: ids, owners, groups of both sides, and the linked pairs."""

    texts: int
    a: np.ndarray
    b: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    one: np.ndarray
    two: np.ndarray

    def per_text(self, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner, minlength=self.texts)


def align(a_ids: list[list[int]], b_ids: list[list[int]], one: Side, two: Side, ends_only: bool) -> Aligned:
    """Groups and links of texts whose tokens on both sides have the same bytes."""

    def laid(ids, side):
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=sum(map(len, ids)))
        end = np.cumsum(side.lengths[flat])
        return flat, np.repeat(np.arange(len(ids)), [len(x) for x in ids]), end - side.lengths[flat], end

    a, a_text, a_start, a_end = laid(a_ids, one)
    b, b_text, b_start, b_end = laid(b_ids, two)
    group = coalesced(np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end]))
    i, j = overlaps(a_start, a_end, b_start, b_end)
    if ends_only:
        same = a_end[i] == b_end[j]
        i, j = i[same], j[same]
    return Aligned(len(a_ids), a, b, a_text, b_text, group[:len(a)], group[len(a):], i, j)


def group_texts(found: Aligned, one: Side, two: Side) -> list[str]:
    """For every text its groups as ``a1,a2|b1;a3|b2,b3``."""
    order = np.lexsort((np.repeat([0, 1], [len(found.a), len(found.b)]), np.concatenate([found.a_group, found.b_group])))
    last_a = np.append(found.a_group[1:] != found.a_group[:-1], True)[:len(found.a)]
    last_b = np.append(found.b_group[1:] != found.b_group[:-1], True)[:len(found.b)]
    names = np.concatenate([np.where(last_a, one.names["|"][found.a], one.names[","][found.a]), np.where(last_b, two.names[";"][found.b], two.names[","][found.b])])
    names = names[order].tolist()
    cuts = np.concatenate([[0], np.cumsum(found.per_text(found.a_text) + found.per_text(found.b_text))]).tolist()
    return ["".join(names[s:e])[:-1] for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


def counted(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order and the sum of their times."""
    order = np.argsort(code, kind="stable")
    code, times = code[order], times[order]
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])[:len(code)])
    return code[first], np.add.reduceat(times, first) if len(first) else times


def align_rows(a_path: str, b_path: str, ends_only: bool):
    """Rows of documents (with their linked pairs) and, in between, rows of counts over many of them."""

    def chunks(batch):
        held, size = [], 0
        for i, value in enumerate(batch.column("text")):
            text = value.as_py() or ""
            if held and size + len(text) > CHUNK_BYTES:
                yield held
                held, size = [], 0
            held.append((i, text))
            size += len(text)
        if held:
            yield held

    def pairs(values, lengths):
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(values))

    def document_rows(ids, texts, one, two):
        a_ids, b_ids = one.tool.encode(texts), two.tool.encode(texts)
        for k, text in enumerate(texts):
            if not text or not one.exact(text, a_ids[k]) or not two.exact(text, b_ids[k]):
                a_ids[k], b_ids[k] = [], []
        found = align(a_ids, b_ids, one, two, ends_only)
        owner = found.a_text[found.one]
        code = found.a[found.one] * len(two.lengths) + found.b[found.two]
        order = np.lexsort((code, owner))
        code, owner = code[order], owner[order]
        first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1]))[:len(code)])
        times = np.diff(np.append(first, len(code)))
        lengths = found.per_text(owner[first])
        # a group has tokens of both sides, so those of one side tell all of them
        begins = np.append(True, found.a_group[1:] != found.a_group[:-1])[:len(found.a)]
        digests = [sha256(t.encode()).hexdigest() if t else "" for t in group_texts(found, one, two)]
        rows = {"doc_id": ids, "tally": pa.array([False] * len(texts)), "n_a": pa.array(found.per_text(found.a_text)), "n_b": pa.array(found.per_text(found.b_text)),
                "n_groups": pa.array(found.per_text(found.a_text[begins])), "n_links": pa.array(found.per_text(owner)), "groups_sha256": pa.array(digests, pa.string()),
                "pairs": pairs(code[first], lengths), "times": pairs(times, lengths)}
        return pa.RecordBatch.from_pydict(rows), code[first], times

    def tally_row(kind, code, times):
        rows = {"doc_id": pa.nulls(1, kind), "tally": pa.array([True])}
        rows |= {n: pa.array([0], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")} | {"groups_sha256": pa.array([""])}
        return pa.RecordBatch.from_pydict(rows | {"pairs": pairs(code, [len(code)]), "times": pairs(times, [len(code)])})

    def rows(batches):
        one, two = Side(a_path), Side(b_path)
        codes, sums = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        kind = None
        for batch in batches:
            kind = batch.column("doc_id").type
            for held in chunks(batch):
                ids = batch.column("doc_id").take(pa.array([i for i, _ in held], pa.int64()))
                out, code, times = document_rows(ids, [t for _, t in held], one, two)
                yield out
                codes, sums = counted(np.concatenate([codes, code]), np.concatenate([sums, times]))
                if len(codes) > TALLY:
                    yield tally_row(kind, codes, sums)
                    codes, sums = codes[:0], sums[:0]
        if len(codes):
            yield tally_row(kind, codes, sums)

    return rows


@dataclass
class Alignment:
    """Written results: one row per document, and the corpus counts of all linked pairs."""

    documents: DataFrame
    counts: DataFrame
    b_size: int


def align_documents(docs: DataFrame, a_path: str, b_path: str, ends_only: bool = True) -> Alignment:
    """Align both vocabularies over all texts; links are pairs that end together, or else all that overlap.

    Texts that are null, empty or not given back byte by byte by either side have no tokens.
    Every row is a document, also where ids are null or repeat.  ``counts`` has (a, b, count).
    """
    longs = ArrayType(LongType())
    schema = StructType().add("doc_id", docs.schema["doc_id"].dataType).add("tally", BooleanType())
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, LongType())
    schema = schema.add("groups_sha256", StringType()).add("pairs", longs).add("times", longs)
    b_size = len(vocabulary(b_path).bytes)
    found = docs.select("doc_id", "text").mapInArrow(align_rows(a_path, b_path, ends_only), schema)
    rows = saved(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    each = rows.filter("tally").select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
    ids = each.select(F.expr(f"int(pair div {b_size})").alias("a"), (F.col("pair") % b_size).cast("int").alias("b"), "pair", "count")
    return Alignment(rows.filter(~F.col("tally")), saved(ids, "pair-counts"), b_size)


def alignment_report(docs: DataFrame, a_path: str = f"{FOLDER}/{BYTE_LEVEL}", b_path: str = f"{FOLDER}/{PIECES}") -> DataFrame:
    """Per document its tokens, groups and links, and how common its links are in the whole corpus.

    A pair whose tokens end together has one token's bytes at the end of the other's, so there
    are no more pairs than bytes in both vocabularies, whatever the corpus; their counts are
    broadcast after counting them.
    """
    aligned = align_documents(docs, a_path, b_path)
    highest = F.max("count").over(Window.partitionBy("b"))
    best = saved(aligned.counts.select(F.col("pair").alias("_pair"), "count", (F.col("count") == highest).alias("best")), "best-pairs")
    keys = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    each = aligned.documents.select(*keys, F.explode_outer(F.arrays_zip("pairs", "times")).alias("p")).select(*keys, F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    found = each.join(small_side(best), F.col("pair") == F.col("_pair"), "left")
    n_best = F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), F.lit(0)).alias("n_best")
    total = F.coalesce(F.sum(F.col("times") * F.col("count")), F.lit(0)).alias("count_sum")
    return found.groupBy(*keys).agg(n_best, total).drop("row")
