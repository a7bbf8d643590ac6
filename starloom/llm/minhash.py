"""Near duplicates by ProbMinHash: Poisson arrivals of distinct shingles, banding, exact verification, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import boxed, let, plain_words, saved, windows_of

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: Shingles of equal weight make a register agree with the probability of the set similarity that is
#: checked, however often a text repeats a shingle.  At 0.8 the mean is 96 with a deviation of 4.4, so
#: fewer than one pair in a million of exactly that similarity is not looked at further.
LEAST_AGREE = 73
DRAWS = 4
PACK = 7  # eight-bit registers in one number of a sketch
BROADCAST_ROWS = 2_000_000  # of short ids

_MIX1, _MIX2, _GOLD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def scrambled(x: np.ndarray) -> np.ndarray:
    """Even 64-bit hashes of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def distinct_shingles(words: np.ndarray) -> np.ndarray:
    """Distinct shingle hashes of one text; none without words."""
    n = max(len(words) - SHINGLE + 1, 1) if len(words) else 0
    h = np.full(n, np.uint64(len(words) if len(words) < SHINGLE else SHINGLE))
    for k in range(min(SHINGLE, len(words))):
        h = scrambled(h * _GOLD + words[k:k + n])
    return np.unique(h)


def prob_minhash(owner: np.ndarray, shingles: np.ndarray, weights: np.ndarray, texts: int, registers: int = REGISTERS) -> np.ndarray:
    """The shingle that arrives first in each register, for all texts of a batch together.

    Every shingle arrives at exponential intervals whose rate is its weight, each time in a
    register drawn by its hash.  A shingle stops as soon as its next arrival is later than
    the latest first arrival of its text: from then on it can change nothing.
    """
    first = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, dtype=np.uint64)
    time, state = np.zeros(len(shingles)), scrambled(shingles + _GOLD)
    while len(owner):
        state = scrambled(state + _GOLD)
        time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights
        alive = time < first.reshape(texts, registers).max(axis=1)[owner]
        owner, shingles, weights, state, time = owner[alive], shingles[alive], weights[alive], state[alive], time[alive]
        at = owner * registers + (scrambled(state ^ _MIX2) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = shingles[won]
    return winner.reshape(texts, registers)


def signatures(batches):
    """Band keys, sketch and number of shingles for rows of word hashes."""
    names = ["doc_id", "node", "n_shingles", "bands", "sketch"]
    for whole in batches:
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            column = batch.column("hashes").combine_chunks() if isinstance(batch.column("hashes"), pa.ChunkedArray) else batch.column("hashes")
            ends = np.asarray(column.offsets)
            values = np.asarray(column.values).view(np.uint64)
            sets = [distinct_shingles(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            sizes = np.array([len(s) for s in sets])
            with np.errstate(over="ignore"):
                winner = prob_minhash(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), np.ones(sizes.sum()), len(sets))
                keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(sets), 1)) * _GOLD
                for k in range(ROWS):
                    keys = scrambled(keys * _GOLD + winner[:, k::ROWS])
            bands = pa.ListArray.from_arrays(np.arange(0, len(sets) * BANDS + 1, BANDS, dtype=np.int32), pa.array(keys.reshape(-1).view(np.int64)))
            packed = np.zeros((len(sets), -(-REGISTERS // PACK)), dtype=np.uint64)
            for k in range(REGISTERS):
                packed[:, k // PACK] |= (winner[:, k] & np.uint64(255)) << np.uint64(8 * (k % PACK))
            width = packed.shape[1]
            sketch = pa.ListArray.from_arrays(np.arange(0, len(sets) * width + 1, width, dtype=np.int32), pa.array(packed.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("node"), pa.array(sizes.astype(np.int32)), bands, sketch], names=names)


def node_of(words: Column, doc_id: Column, text: Column) -> Column:
    """128-bit key of the normalised words; of the raw text without words, of the id for a null text."""
    return F.when(text.isNull(), F.concat(F.lit("null|"), F.coalesce(doc_id.cast("string"), F.lit("")))).when(
        F.size(words) == 0, F.md5(F.concat(F.lit("raw|"), text).cast("binary"))).otherwise(F.md5(F.array_join(words, " ").cast("binary")))


def sketched(docs: DataFrame) -> DataFrame:
    """One narrow row per document with its node, and band keys and sketch where it has words."""
    rows = docs.select("doc_id", let(plain_words(F.coalesce("text", F.lit(""))), lambda w: F.struct(
        node_of(w, F.col("doc_id"), F.col("text")).alias("node"), F.transform(w, lambda x: F.xxhash64(x)).alias("hashes"))).alias("_s"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, node string, n_shingles int, bands array<bigint>, sketch array<bigint>"
    return saved(rows.select("doc_id", F.col("_s.node").alias("node"), F.col("_s.hashes").alias("hashes")).mapInArrow(signatures, schema), "signatures")


def representatives(signed: DataFrame) -> DataFrame:
    """One row per distinct text."""
    return saved(signed.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "texts")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast narrow written rows after counting them; more of them keep their shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def agreeing(one: str, two: str) -> Column:
    """Registers in which two sketches agree: equal bytes of the packed numbers, counted by bits."""
    low = F.lit(int("7f" * PACK, 16))
    packs = -(-REGISTERS // PACK)

    def equal_bytes(k):
        differ = F.col(one)[k].bitwiseXOR(F.col(two)[k])
        marked = (differ.bitwiseAND(low) + low).bitwiseOR(differ).bitwiseOR(low)  # a byte's top bit is 0 where it is equal
        return 8 * PACK - F.bit_count(marked)

    return sum((equal_bytes(k) for k in range(1, packs)), equal_bytes(0)) - (packs * PACK - REGISTERS)


def similar(one: str, two: str) -> Column:
    """Jaccard similarity of two sets of at least SIMILARITY, with one intersection."""
    return F.size(F.array_intersect(one, two)) * (1 + SIMILARITY) >= SIMILARITY * (F.size(one) + F.size(two)) - 1e-9


def shingle_sets(nodes: DataFrame, texts: DataFrame, docs: DataFrame) -> DataFrame:
    """Distinct shingles of the given nodes, built in one pass over the documents."""
    wanted = texts.select(F.col("node").alias("_node"), F.col("rep").alias("_rep")).join(nodes.withColumnRenamed("node", "_n"), F.col("_node") == F.col("_n"), "left_semi")
    found = docs.select("doc_id", "text").join(small(saved(wanted, "wanted")), F.col("doc_id").eqNullSafe(F.col("_rep")))
    built = let(plain_words(F.coalesce("text", F.lit(""))), lambda w: F.when(node_of(w, F.col("doc_id"), F.col("text")) == F.col("_node"), F.when(
        F.size(w) >= SHINGLE, F.array_distinct(windows_of(w, SHINGLE))).otherwise(F.array(F.xxhash64(w)))))
    return saved(found.select(F.col("_node").alias("node"), built.alias("set")).filter("set is not null").dropDuplicates(["node"]), "shingles")


def verified(pairs: DataFrame, texts: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose exact Jaccard similarity of shingle sets reaches the limit.

    Sketches, of fixed size, are compared first, so few sets meet.
    """
    left, right = (texts.select(F.col("node").alias(f"{s}_node"), F.col("n").alias(f"{s}_n"), F.col("sketch").alias(f"{s}_sketch")) for s in "ab")
    ratio = F.least("a_n", "b_n") >= SIMILARITY * F.greatest("a_n", "b_n")
    close = pairs.join(left, F.col("a") == F.col("a_node")).join(right, F.col("b") == F.col("b_node")).filter(ratio & (agreeing("a_sketch", "b_sketch") >= LEAST_AGREE))
    one, two = (sets.select(F.col("node").alias(f"_{s}"), F.col("set").alias(f"_set_{s}")) for s in "ab")
    both = close.select("a", "b").join(one, F.col("a") == F.col("_a")).join(two, F.col("b") == F.col("_b"))
    return saved(both.filter(similar("_set_a", "_set_b")).select("a", "b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for all nodes of the links, root being the least node of the component.

    Large-star and small-star rounds in turn: each takes only minima and joins them back,
    so a hot node is aggregated before the shuffle and never gathered.  The edge set
    shrinks to stars in a number of rounds that grows with the log of the longest path.
    """
    edges = saved(links.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, F.col("u") == F.col("_u")).filter("v > u").select(F.col("m").alias("u"), "v")
        up = saved(large.filter("u != v").distinct(), "large-star")
        low = up.groupBy(F.col("v").alias("_v")).agg(F.min("u").alias("m"))
        pair = F.array(F.struct(F.col("m").alias("u"), "v"), F.struct(F.col("m").alias("u"), F.col("u").alias("v")))
        small_star = up.join(low, F.col("v") == F.col("_v")).select(F.explode(pair).alias("e"))
        edges = saved(small_star.select("e.u", "e.v").filter("u != v").distinct(), "small-star")
        # done when every node hangs on one root, and no root on another
        roles = edges.select("v", F.lit(1).alias("below")).union(edges.select("u", F.lit(0).alias("below")).distinct())
        if roles.groupBy("v").agg(F.sum("below").alias("n"), F.min("below").alias("least")).filter("n > 1 or (n = 1 and least = 0)").isEmpty():
            break
    return saved(edges.select(F.col("v").alias("node"), F.col("u").alias("root")).union(edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()), "components")


def mixed_buckets(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    known = shared.select("band", "node", "n").join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").withColumn("root", F.coalesce("root", "node")).drop("_node")
    mixed = known.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").select(F.col("band").alias("_band"))
    return saved(known.join(mixed, F.col("band") == F.col("_band"), "left_semi"), "mixed-buckets")


def head_pairs(mixed: DataFrame, turn: int) -> DataFrame:
    """Every member with a drawn member of its bucket that lies in another component: at most a pair a row."""
    drawn = mixed.groupBy("band").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "root", "n")).alias("head")).withColumnRenamed("band", "_band")
    other = (F.col("band") == F.col("_band")) & (F.col("root") != F.col("head.root")) & (F.least("n", "head.n") >= SIMILARITY * F.greatest("n", "head.n"))
    return mixed.join(drawn, other).select(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b")).distinct()


def cross_links(mixed: DataFrame, texts: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among all pairs of one bucket that still lie in different components.

    Size, packed sketch and exact similarity are tested inside the join, in this order, and
    the join puts out links only.
    """
    rows = saved(mixed.join(texts.select(F.col("node").alias("_node"), "sketch", "bands"), F.col("node") == F.col("_node")).drop("_node")
                 .join(sets.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")).select("band", "node", "n", "root", "sketch", "bands", "set"), "cross-members")
    left, right = (rows.select(*[F.col(c).alias(f"{s}{c}") for c in rows.columns]) for s in "xy")
    # a pair is looked at in the first of the buckets that it shares
    first = F.coalesce(*[F.when(F.col("xbands")[k] == F.col("ybands")[k], F.col("xbands")[k]) for k in range(BANDS)]) == F.col("xband")
    close = (F.least("xn", "yn") >= SIMILARITY * F.greatest("xn", "yn")) & (agreeing("xsketch", "ysketch") >= LEAST_AGREE) & first & similar("xset", "yset")
    pairs = left.join(right, (F.col("xband") == F.col("yband")) & (F.col("xroot") < F.col("yroot")) & close)
    return saved(pairs.select(F.least("xnode", "ynode").alias("a"), F.greatest("xnode", "ynode").alias("b")).distinct(), "links")


def untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    old = tested.select(F.col("a").alias("_a"), F.col("b").alias("_b"))
    return saved(pairs.join(old, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left_anti"), "pairs")


def near_classes(docs: DataFrame, draws: int = DRAWS) -> DataFrame:
    """(doc_id, node, root) per document: equal roots are one class of near duplicates.

    Texts of equal words are one node.  In every bucket all nodes are compared with its
    least node, then with some drawn nodes of other components, each time a pair a row at
    most.  Whatever still lies in different components of a bucket is then compared inside
    one join.  So every pair that shares a bucket is either linked through others or has
    been compared itself, however large the bucket is.
    """
    signed = sketched(docs)
    texts = representatives(signed.filter("n_shingles > 0"))
    placed = texts.select("node", "n", F.explode("bands").alias("band"))
    heads = placed.groupBy("band").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("_size")).filter("_size > 1").select(F.col("band").alias("_band"), "head")
    shared = saved(placed.join(heads, F.col("band") == F.col("_band")).select("band", "node", "n", "head"), "buckets")
    sets = shingle_sets(shared.select("node").distinct(), texts, docs)
    tested = saved(shared.filter("node != head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = verified(tested, texts, sets)
    roots = components(links)
    mixed = mixed_buckets(shared, roots)
    drawn = head_pairs(mixed, 0)
    for draw in range(1, draws):
        drawn = drawn.union(head_pairs(mixed, draw))
    more = verified(untested(drawn.distinct(), tested), texts, sets)
    if not more.isEmpty():
        links = links.union(more)
        roots = components(links)
        mixed = mixed_buckets(mixed, roots)
    last = cross_links(mixed, texts, sets)
    if not last.isEmpty():
        roots = components(links.union(last))
    joined = signed.select("doc_id", "node").join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    return joined.select("doc_id", "node", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document with its class, the class's size and whether it is the one that stays.

    The class id is the least doc_id of the class.  A null text is a class of its own; texts
    without words are classed with equal ones; repeated rows share their class.
    """
    placed = saved(near_classes(docs), "classes")
    classes = placed.groupBy(F.col("root").alias("_root")).agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    joined = placed.join(saved(classes, "class-ids"), F.col("root") == F.col("_root"))
    return joined.select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("stays"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The document with the least id of every class, with all its columns, whatever these are called.

    Of rows repeated in id and words one stays; an empty table gives none.
    """
    placed = saved(near_classes(docs), "classes")
    chosen = saved(placed.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("c")).select(F.col("c.doc_id").alias("_id"), F.col("c.node").alias("_node")), "chosen")
    words = plain_words(F.coalesce("text", F.lit("")))
    keyed = boxed(docs, "doc_id", "text").withColumn("_key", let(words, lambda w: node_of(w, F.col("doc_id"), F.col("text"))))
    kept = keyed.join(chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_node")), "left_semi")
    repeated = placed.groupBy(F.col("doc_id").alias("_id"), F.col("node").alias("_node")).count().filter("count > 1").select("_id", "_node")
    if not repeated.isEmpty():
        again = saved(repeated, "repeated")
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_node"))
        kept = kept.join(again, same, "left_anti").union(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "_key"]))
    return kept.select("_doc.*")
