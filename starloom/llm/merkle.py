"""Merkle manifest of a data set: binary trees per group and one over their roots, in van Emde Boas order.

A tree is cut into aligned blocks of ``2 ** HEIGHT`` leaves.  A block is one row that holds its
whole subtree as one byte string: the upper half of its levels first, then every subtree of the
lower half, each laid out the same way.  The place of a node follows from the number of levels,
its depth and its index alone, for the writing of parents as for the reading of siblings.  The
roots of the blocks are the leaves of the next round, until one block holds the whole tree.
Proofs go down the rounds: a block adds its own siblings before those that its root was given.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from starloom.llm.common import saved

HEIGHT = 10  # levels of a block above its leaves
BYTES = 32
TAMPERED = 7  # one id in so many, by checksum
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LEFT, RIGHT, NONE = "<", ">", "-"  # where the sibling of a step stands


def places(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` of one depth in the layout of a tree of so many levels."""
    at = np.zeros(len(index), dtype=np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        depth -= top
        levels -= top
        at += (1 << top) - 1 + (index >> depth) * ((1 << levels) - 1)
        index = index & ((1 << depth) - 1)
    return at


def parent(left: bytes, right: bytes = b"") -> bytes:
    return sha256((left.hex() + right.hex()).encode()).digest()


def levels_above(n: int, height: int) -> int:
    """Steps from the leaves to the root of a block in a tree of n leaves."""
    return min((n - 1).bit_length(), height)


def subtree(leaves: list[bytes], steps: int) -> bytes:
    """All nodes above the leaves in van Emde Boas order; places without a node stay zero."""
    nodes = np.zeros(((2 << steps) - 1, BYTES), dtype=np.uint8)
    level = leaves
    for depth in range(steps, -1, -1):
        nodes[places(steps + 1, depth, np.arange(len(level)))] = np.frombuffer(b"".join(level), dtype=np.uint8).reshape(-1, BYTES)
        level = [parent(*level[i:i + 2]) for i in range(0, len(level), 2)]
    return nodes.tobytes()


def siblings(nodes: bytes, steps: int, leaves: int) -> tuple[list[str], list[bytes]]:
    """Of every leaf of a block: the sides of its siblings, one letter a step, and the siblings in a row."""
    stored = np.frombuffer(nodes, dtype=np.uint8).reshape(-1, BYTES)
    sides = np.full((leaves, steps), NONE)
    found = np.zeros((leaves, steps, BYTES), dtype=np.uint8)
    there, width = np.zeros((leaves, steps), dtype=bool), leaves
    for step in range(steps):
        other = (np.arange(leaves) >> step) ^ 1
        has = np.flatnonzero(other < width)
        found[has, step] = stored[places(steps + 1, steps - step, other[has])]
        sides[:, step] = np.where(other >= width, NONE, np.where(other & 1, RIGHT, LEFT))
        there[has, step] = True
        width = (width + 1) // 2
    return ["".join(row) for row in sides.tolist()], [found[i, there[i]].tobytes() for i in range(leaves)]


def folded(digest: bytes, sides: str, path: bytes) -> bytes:
    """The root that a leaf and the siblings on its way lead to."""
    at = 0
    for side in sides:
        other = path[at:at + BYTES]
        at += 0 if side == NONE else BYTES
        digest = parent(digest) if side == NONE else parent(other, digest) if side == LEFT else parent(digest, other)
    return digest


def block_schema(key) -> StructType:
    out = StructType().add("grp", StringType()).add("block", LongType()).add("n", LongType()).add("leaves", LongType())
    return out.add("root", BinaryType()).add("nodes", BinaryType()).add("keys", ArrayType(key)).add("others", ArrayType(BinaryType()))


def build_block(height: int):
    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        n = rows["n"][0].as_py()
        nodes = subtree(rows["digest"].to_pylist(), levels_above(n, height))
        one = {"grp": rows["grp"].slice(0, 1).combine_chunks(), "block": pa.array([rows["pos"][0].as_py() >> height], pa.int64()), "n": pa.array([n], pa.int64()),
               "leaves": pa.array([rows.num_rows], pa.int64()), "root": pa.array([nodes[:BYTES]], pa.binary()), "nodes": pa.array([nodes], pa.binary())}
        for name, column in (("keys", "key"), ("others", "other")):
            one[name] = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows[column].combine_chunks())
        return pa.table(one)

    return build


def expand_paths(height: int, keyed: bool):
    """From blocks with the path of their root to one row per leaf with its whole path."""

    def expand(batches):
        for batch in batches:
            for r in batch.to_pylist():
                nodes, steps, size = r["nodes"], levels_above(r["n"], height), r["leaves"]
                sides, paths = siblings(nodes, steps, size)
                out = {"grp": pa.array([r["grp"]] * size, pa.string()), "subroot": pa.array([r["subroot"]] * size, pa.binary()),
                       "sides": pa.array([s + r["sides"] for s in sides], pa.string()), "path": pa.array([p + r["path"] for p in paths], pa.binary())}
                if keyed:
                    at = places(steps + 1, steps, np.arange(size)) * BYTES
                    out["key"] = pa.array(r["keys"], batch.schema.field("keys").type.value_type)
                    out["digest"] = pa.array([nodes[a:a + BYTES] for a in at.tolist()], pa.binary())
                    out["other"] = pa.array(r["others"], pa.binary())
                else:
                    out["block"] = pa.array(range(r["block"] << height, (r["block"] << height) + size), pa.int64())
                yield pa.RecordBatch.from_pydict(out)

    return expand


def same_group(one: str, two: str) -> Column:
    return F.col(one).eqNullSafe(F.col(two))


def positions(rows: DataFrame, within: list[Column]) -> DataFrame:
    """``pos`` of every row in its group, in the order given, and the group's size ``n``.

    Rows are dealt by ranges of the group and that order, so a hot group spreads over many
    tasks; the offsets are one row per group and range.
    """
    order = [F.col("grp").asc_nulls_first(), *within]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = saved(dealt.select("*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")), "manifest-leaves")
    group = Window.partitionBy("grp")
    counted = dealt.groupBy("grp", "pid").agg(F.count(F.lit(1)).alias("rows"), F.min("nth").alias("first"))
    before = F.coalesce(F.sum("rows").over(group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = saved(counted.select(F.col("grp").alias("_grp"), F.col("pid").alias("_pid"), (before - F.col("first")).alias("_offset"), F.sum("rows").over(group).alias("n")), "manifest-offsets")
    found = dealt.join(offsets, same_group("grp", "_grp") & (F.col("pid") == F.col("_pid")))
    return found.select("grp", "key", "digest", "other", (F.col("nth") + F.col("_offset")).alias("pos"), "n")


@dataclass
class Forest:
    """The blocks of one tree per group, round by round; each round is a written table."""

    rounds: list[DataFrame]
    height: int

    def whole(self, blocks: DataFrame) -> DataFrame:
        """Blocks that hold the root of their tree."""
        return blocks.filter(F.col("n") <= (1 << self.height))

    def roots(self) -> DataFrame:
        out = self.whole(self.rounds[0]).select("grp", "root")
        for blocks in self.rounds[1:]:
            out = out.union(self.whole(blocks).select("grp", "root"))
        return out

    def paths(self, above: DataFrame) -> DataFrame:
        """Every leaf with its siblings; ``above`` has the path (sides, path) and ``subroot`` of every group's root."""
        key = self.rounds[0].schema["keys"].dataType.elementType.simpleString()
        given = above.select("grp", "subroot", "sides", "path")
        below = None
        for k in range(len(self.rounds) - 1, -1, -1):
            blocks = self.rounds[k]
            over = self.whole(blocks).select(F.col("grp").alias("_grp"), "block").join(given, same_group("_grp", "grp")).select("grp", "block", "subroot", "sides", "path")
            over = over if below is None else over.unionByName(below)
            over = saved(over.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "subroot", "sides", "path"), "manifest-paths")
            held = blocks.join(over, same_group("grp", "_grp") & (F.col("block") == F.col("_block"))).drop("_grp", "_block")
            schema = "grp string, subroot binary, sides string, path binary, "
            below = held.mapInArrow(expand_paths(self.height, k == 0), schema + (f"key {key}, digest binary, other binary" if k == 0 else "block bigint"))
        return below


def grow(rows: DataFrame, height: int, within: list[Column]) -> Forest:
    """Trees over rows of (grp, key, digest, other); ``other`` is carried along with its leaf."""
    nodes, rounds = positions(rows, within), []
    while True:
        schema = block_schema(nodes.schema["key"].dataType)
        blocks = nodes.groupBy("grp", F.shiftright("pos", height).alias("block")).applyInArrow(build_block(height), schema)
        rounds.append(saved(blocks, "manifest-blocks"))
        width = 1 << height
        up = rounds[-1].filter(F.col("n") > width)
        if up.isEmpty():
            return Forest(rounds, height)
        nodes = up.select("grp", F.lit(None).cast("bigint").alias("key"), F.col("root").alias("digest"), F.lit(None).cast("binary").alias("other"),
                          F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"))


@dataclass
class Manifest:
    """The trees of all groups, the tree over their roots, and the root of that."""

    groups: Forest
    top: Forest
    root: bytes | None

    def proofs(self) -> DataFrame:
        """(grp, subroot, key, digest, other, sides, path) of every leaf, its siblings up to the root of all."""
        start = self.top.roots().select("grp", F.lit(b"").alias("subroot"), F.lit("").alias("sides"), F.lit(b"").alias("path"))
        above = self.top.paths(start).select(F.col("key").alias("grp"), F.col("digest").alias("subroot"), "sides", "path")
        return self.groups.paths(saved(above, "manifest-top"))


def build_manifest(leaves: DataFrame, height: int = HEIGHT) -> Manifest:
    """Manifest of rows of (grp string, key, digest binary, other binary).

    Leaves of a group stand in ascending order of the key, a null key last, equal keys by their
    digest; rows equal in both are leaves of their own.  Groups stand by the bytes of their name,
    null first.  Without rows there is no root.
    """
    groups = grow(saved(leaves, "manifest-input"), height, [F.col("key").asc_nulls_last(), F.col("digest").asc()])
    roots = groups.roots().select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("root").alias("digest"), F.lit(None).cast("binary").alias("other"))
    top = grow(saved(roots, "manifest-subroots"), height, [F.col("key").asc_nulls_first()])
    first = top.roots().first()
    return Manifest(groups, top, None if first is None else bytes(first.root))


def encoded(columns: list[Column]) -> Column:
    """Every value as its length in bytes, a colon and the value; null is a dash."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaf of every document by language, and beside it the leaf it would have after tampering (else null)."""
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    other = F.when(hit, F.unhex(F.sha2(encoded(changed), 256)))
    return docs.select(F.col("lang").alias("grp"), F.col("doc_id").alias("key"), F.unhex(F.sha2(encoded([F.col(c) for c in COLUMNS]), 256)).alias("digest"), other.alias("other"))


def fold_rows(batches):
    """The root that the carried leaf, or else the leaf itself, leads to."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("digest", "other", "sides", "path")), strict=True)
        found = [folded(digest if other is None else other, sides, path) for digest, other, sides, path in rows]
        kept = [batch.column(c) for c in ("key", "digest", "subroot", "path")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.binary())], names=["key", "digest", "subroot", "path", "folded"])


def manifest_report(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per document its leaf, roots, the digest of its proof, and the root that the tampered document leads to.

    Tampering adds 1 to ``n_chars`` where 7 divides the checksum of the decimal id; a null
    ``n_chars`` stays, and so does a document without id.  Nulls in any column have their own
    code, a null language is a group of its own.  Only the five named columns are read.
    """
    manifest = build_manifest(document_leaves(docs), height)
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = manifest.proofs().mapInArrow(fold_rows, f"key {key}, digest binary, subroot binary, path binary, folded binary")
    root = F.lit(manifest.root).cast("binary")
    text = lambda c: F.lower(F.hex(c))
    return rows.select(F.col("key").alias("doc_id"), text(F.col("digest")).alias("leaf"), text(F.col("subroot")).alias("subroot"), text(root).alias("root"),
                       F.sha2(text(F.col("path")), 256).alias("proof_sha256"), text(F.col("folded")).alias("folded_root"), (F.col("folded") == root).alias("verified"))
