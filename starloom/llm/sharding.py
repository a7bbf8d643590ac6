"""Sharding by longest processing time first: groups that stay together go to the least-loaded shard."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starloom.llm.common import running_sums, saved, text_of

SHARDS = 40
PARCELS = 200  # small groups travel in this many parcels a shard
OVERHEAD = 16


def longest_first(shards: int):
    """Assign parcels, largest first, to the shard with the least bytes."""

    def assign(batches):
        parcels = pd.concat(batches, ignore_index=True).sort_values(["bytes", "parcel"], ascending=[False, True])
        load = [(0, s) for s in range(shards)]
        chosen = []
        for size in parcels["bytes"]:
            least, shard = load[0]
            heapq.heapreplace(load, (least + int(size), shard))
            chosen.append(shard)
        yield pd.DataFrame({"parcel": parcels["parcel"], "shard": pd.Series(chosen, index=parcels.index, dtype="int32")})

    return assign


def shard_map(rows: DataFrame, shards: int = SHARDS, parcels: int = PARCELS) -> DataFrame:
    """Shard of every parcel, from rows of (group, size).

    Groups above 1/(shards x parcels) of all bytes, of which there can be no more than
    shards x parcels, are parcels of their own; the others share as many hashed parcels.
    So the heap sees a bounded table, whatever the number of groups, and its error is that
    of the smallest parcels: about one in ``parcels`` of a shard.
    """
    groups = saved(rows.groupBy("group").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    heavy = F.col("bytes") * (shards * parcels) > F.lit(total)
    named = groups.select(F.when(heavy, F.concat(F.lit("g"), "group")).otherwise(parcel_of(shards, parcels)).alias("parcel"), "bytes")
    sums = named.groupBy("parcel").agg(F.sum("bytes").alias("bytes"))
    return saved(sums.coalesce(1).mapInPandas(longest_first(shards), "parcel string, shard int"), "shard-map")


def parcel_of(shards: int, parcels: int):
    return F.concat(F.lit("p"), F.pmod(F.xxhash64("group"), F.lit(shards * parcels)).cast("string"))


def with_shard(rows: DataFrame, shards: int = SHARDS, parcels: int = PARCELS) -> DataFrame:
    """Rows with a ``group`` and a ``size`` get their ``shard``; both lookups are bounded by shards x parcels rows."""
    chosen = shard_map(rows, shards, parcels)
    own = chosen.filter(F.col("parcel").startswith("g")).select(F.expr("substring(parcel, 2)").alias("_group"), F.col("shard").alias("_own"))
    shared = chosen.filter(F.col("parcel").startswith("p")).select(F.col("parcel").alias("_parcel"), F.col("shard").alias("_shared"))
    found = rows.join(F.broadcast(own), F.col("group") == F.col("_group"), "left").join(F.broadcast(shared), parcel_of(shards, parcels) == F.col("_parcel"), "left")
    return found.withColumn("shard", F.coalesce("_own", "_shared")).drop("_group", "_own", "_parcel", "_shared")


def shard_documents(docs: DataFrame, shards: int = SHARDS, parcels: int = PARCELS) -> DataFrame:
    """One row per document: its size, shard and gapless slot in it.

    Equal texts are one group; null texts are one group of size ``OVERHEAD`` a row with
    the checksum of nothing.  Equal (id, text) rows take neighbouring slots.
    """
    whole = text_of()
    digest = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null"))
    size = (F.octet_length(whole) + OVERHEAD).cast("bigint")
    # one entry for equal rows: neither their sum nor their numbering meets them one by one
    entries = docs.select("doc_id", size.alias("bytes_each"), F.crc32(whole.cast("binary")).alias("text_crc32"), digest.alias("group"))
    entries = entries.groupBy("doc_id", "bytes_each", "text_crc32", "group").agg(F.count(F.lit(1)).alias("copies"))
    place = F.md5(F.concat_ws("|", "group", F.col("doc_id").cast("string")).cast("binary"))
    rows = saved(entries.withColumns({"size": F.col("bytes_each") * F.col("copies"), "place": place}), "entries")
    placed = saved(with_shard(rows, shards, parcels).select("doc_id", "bytes_each", "text_crc32", "copies", "place", "shard"), "placed")
    numbered = running_sums(placed, "shard", "place", ["doc_id"], "copies", "_first")
    each = numbered.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
    return each.select("doc_id", F.col("bytes_each").alias("size"), "text_crc32", F.lit("bytes").alias("law"), "shard",
                       (F.col("_first") + F.col("_nth")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
