"""Benchmark decontamination: broadcast hashes of test n-grams, a scan of all training windows, exact check of hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.llm.common import boxed, let, plain_words, saved, text_of, windows_of

N = 10
BROADCAST_BYTES = 64 << 20
ANY_CASE = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # a word before lower-casing


def benchmark_windows(items: DataFrame, key: str = "item_id", text: str = "text", n: int = N) -> DataFrame:
    """Distinct windows of the items with the ids of the items they occur in.

    An item of fewer than n words, but at least one, is a single window.  A null id is
    not listed, but its windows still count as hits.
    """
    words = items.select(F.col(key).cast("string").alias("_item"), plain_words(text_of(text)).alias("_words")).filter(F.size("_words") > 0)
    length = F.least(F.size("_words"), F.lit(n))
    cut = F.transform(F.sequence(F.lit(1), F.size("_words") - length + 1), lambda i: F.slice("_words", i, length))
    rows = words.select("_item", length.alias("_len"), F.explode(cut).alias("_window"))
    return rows.groupBy("_len", "_window").agg(F.collect_set("_item").alias("_items")).withColumn("_hash", F.xxhash64("_window"))


def window_hits(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text", n: int = N) -> DataFrame:
    """One row per (partition, id, text): words, number of equal rows, hit spans and item ids.

    The windows are broadcast only when their measured bytes stay below a fixed limit;
    beyond it the same equality is a shuffle join.  A hash match counts only when the
    words are equal.  Hits are gathered per document, never per window or item.
    """
    windows = saved(benchmark_windows(items, item_key, text, n), "windows")
    measured = windows.groupBy("_len").agg(F.sum(F.length(F.array_join("_window", " ")) + F.length(F.array_join("_items", " ")) + 64).alias("b")).collect()
    lengths = sorted(r["_len"] for r in measured) or [n]
    small = sum(r["b"] for r in measured) <= BROADCAST_BYTES
    base = docs.select(F.col(doc_key).alias("_id"), F.xxhash64(text).alias("_th"), F.spark_partition_id().alias("_part"), plain_words(text_of(text)).alias("_words"))
    per_length = base.withColumn("_size", F.explode(F.array(*[F.lit(k) for k in lengths])))
    hashes = F.lit(None).cast("array<bigint>")
    for k in lengths:
        hashes = F.when(F.col("_size") == k, windows_of(F.col("_words"), k)).otherwise(hashes)
    # the outer form: the plain one makes the optimizer compute the hashes twice
    probe = per_length.select("_id", "_th", "_part", "_words", "_size", F.posexplode_outer(hashes).alias("_pos", "_h"))
    first = (F.col("_size") == lengths[0]) & (F.coalesce(F.col("_pos"), F.lit(0)) == 0)
    probe = probe.withColumns({"_n": F.when(first, F.size("_words")), "_pos": F.coalesce("_pos", F.lit(0))})
    here = F.slice("_words", F.col("_pos") + 1, F.col("_size"))
    if small:
        side, equal = F.broadcast(windows), (F.col("_h") == F.col("_hash")) & (F.col("_size") == F.col("_len")) & (here == F.col("_window"))
    else:  # the words of a row must not travel once per window
        probe = probe.withColumn("_here", here).drop("_words")
        side, equal = windows, (F.col("_h") == F.col("_hash")) & (F.col("_size") == F.col("_len")) & (F.col("_here") == F.col("_window"))
    found = probe.join(side, equal, "left").filter(F.col("_len").isNotNull() | F.col("_n").isNotNull())
    span = F.when(F.col("_len").isNotNull(), F.struct(F.col("_pos").alias("pos"), F.col("_len").alias("len")))
    return found.groupBy("_part", "_id", "_th").agg(
        F.max("_n").cast("bigint").alias("n_words"),
        F.count("_n").alias("_rows"),
        F.array_sort(F.collect_set(span)).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("_items")))).alias("_found"),
    )


def _covered(spans: Column) -> Column:
    """Positions in the union of the sorted spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("sum"))

    def step(acc, s):
        end = s["pos"] + s["len"]
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["sum"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], s["pos"]))).alias("sum"))

    return F.aggregate(spans, start, step, lambda acc: acc["sum"])


def contamination_report(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """Per document its words, hit words, items and whether any window of an item occurs.

    Null and empty texts have no words and no hits; repeated rows are reported once each;
    without items nothing is contaminated.
    """
    hits = window_hits(docs, items, n=n)
    one = hits.select(F.col("_id").alias("doc_id"), "n_words", _covered(F.col("_spans")).alias("n_hit"), F.size("_found").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("_found", ","), 256).alias("items_sha256"), "_rows")
    rows = one.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rows")))).drop("_rows", "_again")
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


def remove_contaminated(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns, whatever these are called.

    Null and empty texts and all documents of a table without items stay; repeated rows stay or go together.
    """
    bad = window_hits(docs, items, n=n).filter(F.size("_spans") > 0).select(F.col("_id").alias("_bad_id"), F.col("_th").alias("_bad_th")).distinct()
    rows = boxed(docs, "doc_id", F.xxhash64("text").alias("_th"))
    return rows.join(saved(bad, "contaminated"), F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.col("_th") == F.col("_bad_th")), "left_anti").select("_doc.*")


def remove_spans(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """All documents, without the words inside occurrences of item windows; other characters stay."""
    bad = window_hits(docs, items, n=n).filter(F.size("_spans") > 0).groupBy(F.col("_id").alias("_bad_id"), F.col("_th").alias("_bad_th")).agg(F.first("_spans").alias("_spans"))
    rows = boxed(docs, "doc_id", "text")
    joined = rows.join(saved(bad, "spans"), F.col("doc_id").eqNullSafe(F.col("_bad_id")) & (F.xxhash64("text") == F.col("_bad_th")), "left")

    def rebuilt(ws):
        gaps = F.split(F.col("text"), ANY_CASE)
        hit = lambda i: F.exists("_spans", lambda s: (i >= s["pos"]) & (i < s["pos"] + s["len"]))
        return let(gaps, lambda g: F.concat(g[0], F.array_join(F.transform(ws, lambda w, i: F.concat(F.when(hit(i), F.lit("")).otherwise(w), g[i + 1])), "")))

    words = F.regexp_extract_all(F.col("text"), F.lit(ANY_CASE), F.lit(0))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(let(words, rebuilt))
    return joined.withColumn("_new", text).select(*[F.col("_new").alias("text") if c == "text" else F.col(f"_doc.`{c}`") for c in docs.columns])
