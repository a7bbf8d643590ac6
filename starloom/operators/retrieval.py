"""BM25 over a corpus, ranked-list merging, hybrid retrieval and index upkeep."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StructField, StructType

from starloom.functions.rows import element_rows, numbered_rows
from starloom.operators import tiles
from starloom.session import cut_lineage, scratch_path, small_side, spread

# The published Okapi defaults.
K1, B, EPSILON = 1.5, 0.75, 0.25
# the blanks that separate tokens, the same in Java and here
WHITESPACE = re.compile(r"[ \t\n\x0b\f\r]+")
BLOCK_DOCS = 2048  # documents of one block of the index
TILE_DOCS = 1 << 13  # documents that meet a tile of queries at once; a task holds their postings several times over
QUERY_TERMS = 1 << 20  # query terms in one tile


def whitespace_tokens(text: Column, lower: bool = False) -> Column:
    cleaned = F.lower(text) if lower else text
    return F.filter(F.split(cleaned, r"\s+"), lambda t: t != "")


def block_postings(id_type: pa.DataType, part: int, size: int):
    """Postings of blocks of documents as they lie in a partition; no (document, term) pair is shuffled.

    Row per (block, term): places in the block with their term counts, the greatest count and
    the least length.  The empty term lists the whole block: its counts are the lengths, and it
    alone carries the ids.
    """

    def post(piece: pa.RecordBatch, block: int) -> pa.RecordBatch:
        found, lengths = {}, []
        for at, text in enumerate(piece.column(1).to_pylist()):
            words = [w for w in WHITESPACE.split(text or "") if w]
            lengths.append(len(words))
            for term, n in Counter(words).items():
                places, counts = found.setdefault(term, ([], []))
                places.append(at)
                counts.append(n)
        found[""] = (list(range(piece.num_rows)), lengths)
        terms = sorted(found)
        sizes = [len(found[t][0]) for t in terms]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        at = pa.array([p for t in terms for p in found[t][0]], pa.int32())
        n = pa.array([c for t in terms for c in found[t][1]], pa.int32())
        entries = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([at, n], names=["at", "n"]))
        ids = pa.array([piece.column(0).to_pylist() if t == "" else None for t in terms], pa.list_(id_type))
        rows = {"term": pa.array(terms), "part": pa.array([part] * len(terms), pa.int32()), "block": pa.array([block] * len(terms), pa.int64()), "entries": entries,
                "most": pa.array([max(found[t][1]) for t in terms], pa.int32()), "least": pa.array([min(lengths[p] for p in found[t][0]) for t in terms], pa.int32()), "ids": ids}
        return pa.RecordBatch.from_pydict(rows)

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                yield post(batch.slice(at, size), block)
                block += 1

    return run


class BM25Index:
    """Inverted index over whitespace tokens, as written tables.

    Postings are rows of (term, part, block): a common term is split by the blocks of its
    documents.  Added documents become a part of their own; deleted ones have their blocks
    written again without them, the old rows of these blocks are left out when reading.  The
    document frequencies follow by adding up what changed.  A null text is an empty document,
    and a repeated id is a document for every row.
    """

    def __init__(self, docs: DataFrame, doc_id: str, text: str, lower: bool = False, block_docs: int = BLOCK_DOCS):
        self.doc_id, self.text, self.lower, self.block_docs = doc_id, text, lower, block_docs
        self.spark, self.id_type = docs.sparkSession, docs.schema[doc_id].dataType
        self._reset()
        self.add(docs)

    def _reset(self) -> None:
        self.parts: list[DataFrame] = []
        self.replaced: list[DataFrame] = []  # (part, block) whose rows have been written again
        self.n, self.length, self.written = 0, 0, 0
        self.terms = self.spark.createDataFrame([], "term string, df bigint")

    def _schema(self) -> StructType:
        entry = StructType().add("at", "integer").add("n", "integer")
        return (StructType().add("term", "string").add("part", "integer").add("block", "long").add("entries", ArrayType(entry))
                .add("most", "integer").add("least", "integer").add("ids", ArrayType(self.id_type)))

    def _keep(self, postings: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "postings")
        postings.write.parquet(path)
        self.parts.append(self.spark.read.schema(self._schema()).parquet(path))
        self.written += 1
        return self.parts[-1]

    def _count(self, changes: DataFrame) -> None:
        """Add (term, df, length) to the frequencies; the empty term stands for the documents themselves."""
        changed = cut_lineage(changes.groupBy("term").agg(F.sum("df").alias("df"), F.sum("length").alias("length")))
        documents = changed.filter("term = ''").first()
        if documents:
            self.n, self.length = self.n + documents.df, self.length + documents.length
        both = self.terms.select("term", "df").unionByName(changed.filter("term <> ''").select("term", "df"))
        self.terms = cut_lineage(both.groupBy("term").agg(F.sum("df").alias("df")).filter("df > 0"))

    @property
    def avgdl(self) -> float:
        return (self.length / self.n if self.n else 0.0) or 1.0

    def live(self) -> DataFrame:
        """All postings in force."""
        rows = reduce(DataFrame.unionByName, self.parts, self.spark.createDataFrame([], self._schema()))
        return rows.join(small_side(reduce(DataFrame.unionByName, self.replaced)), ["part", "block"], "left_anti").select(*self._schema().names) if self.replaced else rows

    def add(self, docs: DataFrame) -> BM25Index:
        """Index these documents only."""
        text = F.lower(self.text) if self.lower else F.col(self.text)
        rows = docs.select(self.doc_id, text.alias("__text"))
        posting = block_postings(to_arrow_type(self.id_type), self.written, self.block_docs)
        new = self._keep(spread(rows).mapInArrow(posting, self._schema()))
        lengths = F.when(F.col("term") == "", F.aggregate("entries", F.lit(0).cast("bigint"), lambda a, e: a + e["n"])).otherwise(0)
        self._count(new.select("term", F.size("entries").cast("bigint").alias("df"), lengths.alias("length")))
        return self

    def delete(self, ids: DataFrame) -> BM25Index:
        """Take out all documents with these ids; only the blocks that hold them are read and written."""
        places = self.live().filter("term = ''").select("part", "block", F.posexplode("ids").alias("at", "__id"))
        asked = ids.select(F.col(self.doc_id).alias("__id")).distinct()
        gone = cut_lineage(places.join(asked, "__id", "left_semi").groupBy("part", "block").agg(F.collect_set("at").alias("gone"))
                           .withColumn("fresh", F.monotonically_increasing_id()))
        rows = self.live().join(small_side(gone, 10_000), ["part", "block"])
        left = F.filter("entries", lambda e: ~F.array_contains("gone", e["at"]))
        lost = F.filter("entries", lambda e: F.array_contains("gone", e["at"]))
        cut = cut_lineage(rows.select("term", F.col("fresh").alias("block"), left.alias("entries"), "most", "least", "ids", lost.alias("lost")))
        lengths = F.when(F.col("term") == "", F.aggregate("lost", F.lit(0).cast("bigint"), lambda a, e: a - e["n"])).otherwise(0)
        self._count(cut.select("term", (-F.size("lost").cast("bigint")).alias("df"), lengths.alias("length")))
        fresh = cut.filter((F.size("entries") > 0) | (F.col("term") == "")).select("term", F.lit(self.written).alias("part"), "block", "entries", "most", "least", "ids")
        self._keep(fresh)
        self.replaced.append(gone.select("part", "block"))
        return self

    def clear(self) -> BM25Index:
        self._reset()
        return self

    def count(self) -> int:
        return self.n

    def _asked(self, queries: DataFrame, query_id: str, query_text: str) -> DataFrame:
        """(query, term, weight): known terms of each query, repeats counted, times the term's idf."""
        raw = F.ln(F.lit(self.n) - F.col("df") + 0.5) - F.ln(F.col("df") + 0.5)
        # a term in more than half of the documents gets a share of the mean idf instead of a negative one
        floor = EPSILON * (self.terms.agg(F.avg(raw)).first()[0] or 0.0)
        idf = F.when(raw < 0, F.lit(floor)).otherwise(raw)
        tokens = element_rows(queries, [query_id], whitespace_tokens(F.col(query_text), self.lower), "term")
        counted = tokens.groupBy(query_id, "term").agg(F.count(F.lit(1)).alias("n"))
        return cut_lineage(counted.join(self.terms.select("term", idf.alias("idf")), "term").select(query_id, "term", (F.col("n") * F.col("idf")).alias("weight")))

    def top_k(self, queries: DataFrame, query_id: str, query_text: str, k: int = 5, digits: int = 9) -> DataFrame:
        """Best k documents per query with their rank, among those sharing a term; equal scores go to the lower id.

        Common terms join nearly every query with nearly every document, so the pairs are not
        shuffled: tiles of blocks and tiles of query terms meet, and k rows per query leave a
        task.  In a tile the most promising block comes first, and a block is passed over for
        all queries whose k-th score is above the most that its term maxima allow.
        """
        schema = StructType([StructField(query_id, queries.schema[query_id].dataType), StructField(self.doc_id, self.id_type)]).add("score", "double")
        if not self.n:
            return top_per(self.spark.createDataFrame([], schema), query_id, [F.col("score").desc(), F.col(self.doc_id)], k)
        asked = self._asked(queries, query_id, query_text)
        terms = asked.select("term").distinct().union(self.spark.sql("SELECT '' AS term"))
        postings = self.live().join(small_side(terms), "term", "left_semi").withColumn("__block", F.struct("part", "block"))
        cores, blocks = self.spark.sparkContext.defaultParallelism, -(-self.n // self.block_docs)
        cut = max(-(-self.n // TILE_DOCS), min(cores, blocks)), tiles.tiles_for(asked.count(), 1, QUERY_TERMS)
        found = tiles.meet(postings, asked, "__block", query_id, cut, self._scorer(query_id, k, digits), schema)
        return top_per(found, query_id, [F.col("score").desc(), F.col(self.doc_id)], k)

    def _scorer(self, query_id: str, k: int, digits: int):
        avgdl, doc_id = self.avgdl, self.doc_id

        def gain(n, length):
            return n * (K1 + 1) / (n + K1 * (1 - B + B * length / avgdl))

        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            asked = QueryTerms(right, query_id)
            blocks = [Block(rows, asked, gain) for rows in block_rows(left)] if len(asked.names) else []
            blocks = sorted((b for b in blocks if len(b.ids)), key=lambda b: -b.bound.sum())
            ids = pa.chunked_array([b.ids for b in blocks]) if blocks else pa.chunked_array([], left["ids"].type.value_type)
            rank = np.empty(len(ids), dtype=np.int64)  # place among the ids, which breaks ties
            rank[np.asarray(pc.sort_indices(ids))] = np.arange(len(ids))
            best = np.full((0, len(asked.names)), np.inf), np.zeros((0, len(asked.names)), dtype=np.int64), np.zeros((0, len(asked.names)), dtype=np.int64)
            at = 0
            for block in blocks:
                limit = best[0][k - 1] if len(best[0]) >= k else np.full(len(asked.names), np.inf)
                open_ = np.flatnonzero(np.isfinite(block.bound) & (-block.bound - 10.0**-digits <= limit))
                step = max(1, tiles.SCORES // len(block.ids))
                for some in (open_[i:i + step] for i in range(0, len(open_), step)):
                    cost = -np.round(block.scores(asked, some), digits)
                    best = merged(best, some, cost, rank[at:at + len(block.ids)], at, k)
                at += len(block.ids)
            row, query = np.nonzero(np.isfinite(best[0]))
            return pa.table({query_id: asked.names.take(pa.array(query)), doc_id: ids.take(pa.array(best[2][row, query])), "score": 0.0 - best[0][row, query]})

        return search


class QueryTerms:
    """The terms of a tile of queries, grouped by term."""

    def __init__(self, rows: pa.Table, query_id: str):
        who = tiles.flat(rows[query_id]).dictionary_encode()
        terms = tiles.flat(rows["term"]).dictionary_encode()
        self.names, self.terms = who.dictionary, terms.dictionary
        number = np.asarray(terms.indices)
        order = np.argsort(number, kind="stable")
        self.starts = np.searchsorted(number[order], np.arange(len(self.terms) + 1))
        self.who, self.weight = np.asarray(who.indices)[order], np.asarray(rows["weight"])[order]

    def asking(self, term: int) -> slice:
        return slice(self.starts[term], self.starts[term + 1])


def block_rows(postings: pa.Table) -> list[pa.Table]:
    """One table per block of the postings."""
    rows = postings.sort_by([("part", "ascending"), ("block", "ascending"), ("term", "ascending")])
    key = np.stack([np.asarray(rows["part"]), np.asarray(rows["block"])]) if rows.num_rows else np.zeros((2, 0), dtype=np.int64)
    starts = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))[:rows.num_rows]).tolist()
    return [rows.slice(a, b - a) for a, b in pairwise([*starts, rows.num_rows])]


class Block:
    """Postings of the asked terms in one block, and the most that each query can score there."""

    def __init__(self, rows: pa.Table, asked: QueryTerms, gain):
        entries = tiles.flat(rows["entries"])
        self.ids = tiles.flat(rows["ids"])[0].values  # the empty term is the first
        cuts = np.asarray(entries.offsets)
        values = entries.values
        at, n = np.asarray(values.field("at")), np.asarray(values.field("n")).astype(np.float64)
        length = np.zeros(len(self.ids))
        length[at[cuts[0]:cuts[1]]] = n[cuts[0]:cuts[1]]
        number = pc.index_in(tiles.flat(rows["term"]), value_set=asked.terms).to_pylist()
        top = gain(np.asarray(rows["most"]).astype(np.float64), np.asarray(rows["least"]))
        self.lists, bound, touched = [], np.zeros(len(asked.names)), np.zeros(len(asked.names), dtype=bool)
        for r, term in enumerate(number):
            if term is not None:
                places = at[cuts[r]:cuts[r + 1]]
                self.lists.append((term, places, gain(n[cuts[r]:cuts[r + 1]], length[places])))
                span = asked.asking(term)
                bound[asked.who[span]] += np.maximum(asked.weight[span] * top[r], 0.0)
                touched[asked.who[span]] = True
        self.bound = np.where(touched, bound, -np.inf)

    def scores(self, asked: QueryTerms, some: np.ndarray) -> np.ndarray:
        """(documents, queries) of the block for some queries; minus infinity without a common term."""
        column = np.full(len(asked.names), -1)
        column[some] = np.arange(len(some))
        total, touched = np.zeros((len(self.ids), len(some))), np.zeros((len(self.ids), len(some)), dtype=bool)
        for term, places, gains in self.lists:
            span = asked.asking(term)
            where = column[asked.who[span]]
            cells = np.ix_(places, where[where >= 0])
            total[cells] += gains[:, None] * asked.weight[span][where >= 0][None, :]
            touched[cells] = True
        return np.where(touched, total, -np.inf)


def merged(best, some: np.ndarray, cost: np.ndarray, rank: np.ndarray, first: int, k: int):
    """The best k of before (costs, ranks, rows) and of a block's costs, for some of the queries."""
    order = np.lexsort((np.broadcast_to(rank[:, None], cost.shape), cost), axis=0)[:k]
    new = np.take_along_axis(cost, order, axis=0), rank[order], order + first
    both = [np.concatenate([old[:, some], part]) for old, part in zip(best, new, strict=True)]
    order = np.lexsort((both[1], both[0]), axis=0)[:k]
    height = max(len(best[0]), len(order))
    out = []
    for old, part, empty in zip(best, both, (np.inf, 0, 0), strict=True):
        whole = np.full((height, old.shape[1]), empty, dtype=old.dtype)
        whole[:len(old)] = old
        whole[:, some] = empty
        whole[:len(order), some] = np.take_along_axis(part, order, axis=0)
        out.append(whole)
    return tuple(out)


def top_per(df: DataFrame, key: str | list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows per key (one or several columns) with their rank; Spark trims each task's rows to k before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def by_time_after_top_k(df: DataFrame, key: str, score: list[Column], k: int, time: list[Column]) -> DataFrame:
    """The best k rows per key, then put in order of time."""
    best = top_per(df, key, score, k).drop("rank")
    return best.withColumn("position", F.row_number().over(Window.partitionBy(key).orderBy(*time)))  # k rows per key


def first_wins(lists: list[DataFrame], query_id: str, doc_id: str, position: str = "rank") -> DataFrame:
    """Ranked lists one after another, each document kept where it first appears; scores are not fused.

    Each list needs ``position``; the result is ordered by (list_no, position) and numbered in ``merged_rank``.
    """
    columns = [query_id, doc_id, position, "score"]
    tagged = reduce(DataFrame.unionByName, [d.select(*columns, F.lit(i).alias("list_no")) for i, d in enumerate(lists)])
    place = F.struct("list_no", position)
    kept = tagged.groupBy(query_id, doc_id).agg(
        F.min(place).alias("__place"), F.min_by("score", place).alias("score")
    ).select(query_id, doc_id, "score", F.col("__place.list_no").alias("list_no"), F.col(f"__place.{position}").alias(position))
    w = Window.partitionBy(query_id).orderBy("list_no", position)  # at most lists x k rows per query
    return kept.withColumn("merged_rank", F.row_number().over(w))


def recall_merge(found: DataFrame, query_id: str, k: int, score: str = "score") -> DataFrame:
    """The best k result rows per query, ranked by score.

    ``found`` holds ``position``, the order of arrival, which also breaks ties.
    """
    return top_per(found, query_id, [F.col(score).desc(), F.col("position")], k)


def half_windows(text: Column) -> Column:
    """The two overlapping parts (0-60 % and 40-100 %) that stand for an over-long text."""
    tenth = F.floor(F.length(text) / 10).cast("int")
    return F.array(F.substr(text, F.lit(1), tenth * 6), F.substr(text, tenth * 4 + 1))


def order_by_object_field(nodes: DataFrame, obj: str, field: str, kind: str, n: int, descending: bool = True) -> DataFrame:
    """Top n by a field of a JSON object column; a missing or unreadable field raises on any row."""
    value = F.get_json_object(F.col(obj), f"$.{field}").try_cast(kind)
    checked = F.coalesce(value, F.raise_error(F.concat(F.lit(f"no {field} in "), F.col(obj))).cast(kind))
    keyed = nodes.withColumn(f"obj_{field}", checked)
    ids = [F.col(c) for c in nodes.columns if c != obj]
    first = F.col(f"obj_{field}").desc() if descending else F.col(f"obj_{field}").asc()
    return keyed.orderBy(first, *ids).limit(n)


def as_object_nodes(df: DataFrame, class_name: str, key: Column) -> DataFrame:
    """Rows as retrieval nodes: key text, JSON form and class tag."""
    return df.select(key.alias("text"), F.lit(True).alias("is_obj"),
                     F.to_json(F.struct(*df.columns)).alias("obj_json"), F.lit(class_name).alias("obj_cls_name"))


def objects_back(nodes: DataFrame, schema: str) -> DataFrame:
    return nodes.select(F.from_json("obj_json", schema).alias("__o")).select("__o.*")


def change_state(new: DataFrame, stored: DataFrame, path: str, content: str, tokens: Column,
                 low: int = 10_000, high: int = 100_000_000) -> DataFrame:
    """new / changed / unchanged / not-indexable per file, by SHA-256 of the content."""
    prints = new.select(path, F.sha2(content, 256).alias("fingerprint"), tokens.between(low, high).alias("__fits"))
    old = stored.select(F.col(path).alias("__path"), F.col("fingerprint").alias("__old"))
    state = (
        F.when(~F.col("__fits"), "not-indexable").when(F.col("__old").isNull(), "new")
        .when(F.col("__old") != F.col("fingerprint"), "changed").otherwise("unchanged")
    )
    return prints.join(old, F.col(path) == F.col("__path"), "left").select(path, "fingerprint", state.alias("state"))


def build_index(docs: DataFrame, path: str, content: str, pieces: Column, folder: str) -> DataFrame:
    """Chunk rows (file_path, pos, text, fingerprint of the file) written to ``folder`` and read back."""
    marked = docs.select(F.col(path).alias("file_path"), F.sha2(content, 256).alias("fingerprint"), pieces.alias("__pieces"))
    chunks = numbered_rows(marked, ["file_path", "fingerprint"], F.col("__pieces"), "pos", "text")
    chunks.write.mode("overwrite").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def replace_files(index: DataFrame, added: DataFrame, path: str) -> DataFrame:
    """Index rows of the added files are replaced by the new ones."""
    return index.join(added.select(path).distinct(), path, "left_anti").unionByName(added)


def delete_files(index: DataFrame, paths: DataFrame, path: str) -> DataFrame:
    return index.join(paths.select(path).distinct(), path, "left_anti")


# Folders that have an index of their own.
UPLOADS, CHATS = r"^/data/uploads($|/.*)", r"^/data/chats/[a-z0-9]+($|/.*)"


def index_of_path(path: Column) -> Column:
    """Index a path belongs to: uploads, one per chat, or other."""
    chat = F.concat(F.lit("chats/"), F.regexp_extract(path, r"^/data/chats/([a-z0-9]+)", 1))
    return F.when(path.rlike(UPLOADS), "uploads").when(path.rlike(CHATS), chat).otherwise("other")


def filter_after_top_k(ranked: DataFrame, condition: Column) -> DataFrame:
    """Filter applied to the k rows found, so fewer than k may remain."""
    return ranked.filter(condition)


def cached_answers(requests: DataFrame, experiences: DataFrame, req: str, perfect: int = 10) -> DataFrame:
    """Each request with the response of an equal one that scored perfectly, or a miss."""
    best = experiences.filter(F.col("score") == perfect).groupBy(req).agg(F.min_by("resp", "exp_id").alias("resp"))
    return requests.join(best, req, "left").withColumn("hit", F.col("resp").isNotNull())
