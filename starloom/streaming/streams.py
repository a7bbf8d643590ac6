"""Structured Streaming forms; each equals its batch operator on the same input."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from starloom.functions import scalars as S
from starloom.operators.budget import spend_each
from starloom.operators.messages import ALL_RECIPIENTS
from starloom.session import scratch_path


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Stream over a folder (or one file) of a known schema."""
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if "." in name:
        reader, path = reader.option("pathGlobFilter", name), folder
    return reader.load(path)


STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def drain(stream: DataFrame, label: str, mode: str = "append", target: str | None = None, rocksdb: bool = False) -> DataFrame:
    """Run a stream over what is available now into parquet and read the result.

    Output and checkpoint lie in the shared folder, so a restarted run goes on
    where the lost one stopped.  ``rocksdb`` names that state store for this run.
    """
    spark = stream.sparkSession
    target = target or scratch_path(spark, label)
    before = spark.conf.get(STORE)
    if rocksdb:
        spark.conf.set(STORE, ROCKSDB)
    try:
        query = (stream.writeStream.format("parquet").outputMode(mode).option("path", f"{target}/data")
                 .option("checkpointLocation", f"{target}/state").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(STORE, before)
    return spark.read.schema(stream.schema).parquet(f"{target}/data")


def for_each(stream: DataFrame, handler: Callable[[DataFrame, int], None], label: str, state: str | None = None) -> None:
    """Subscription: every micro-batch is handed to the callback."""
    place = state or scratch_path(stream.sparkSession, label)
    stream.writeStream.foreachBatch(handler).option("checkpointLocation", place).trigger(availableNow=True).start().awaitTermination()


def load_increments(spark: SparkSession, folder: str, schema, target: str, fmt: str = "csv") -> DataFrame:
    """Load files that arrived since the last run; the checkpoint next to the target remembers the others."""
    reader = spark.readStream.schema(schema).format(fmt)
    stream = (reader.option("header", True) if fmt == "csv" else reader).load(folder)
    return drain(stream, "increments", target=target)


def _timed(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need a timestamp with a zone; times without one are read in the session's zone."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def without_repeats(messages: DataFrame, key: list[str], time: str, delay: str = "1 day") -> DataFrame:
    """First message per key; a repeat within the delay is dropped and the state stays bounded."""
    return _timed(messages, time).withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def daily_counts(events: DataFrame, time: str, kind: str, delay: str = "1 day") -> DataFrame:
    """Counts per UTC day and kind, written once the watermark has passed the day; later rows are dropped."""
    return _timed(events, time).withWatermark(time, delay).groupBy(F.window(time, "1 day"), S.safe_key(F.col(kind)).alias("event_type")).agg(
        F.count(F.lit(1)).alias("interaction_count"), F.sum("value").alias("total_value")
    ).select(F.col("window.start").cast("date").alias("day"), "event_type", "interaction_count", "total_value")


def routed(messages: DataFrame, recipients: DataFrame, message_id: str, recipient: str) -> DataFrame:
    """Stream of (message, recipient); the recipients are a static table, a broadcast is one row to ``<all>``."""
    sent = messages.select(message_id, F.explode(F.array_distinct("send_to")).alias("address"))
    homes = recipients.select(recipient, F.explode(F.array_distinct("addresses")).alias("address"))
    direct = sent.join(homes, "address").select(message_id, recipient)
    loud = sent.filter(F.col("address") == ALL_RECIPIENTS).select(message_id, F.lit(ALL_RECIPIENTS).alias(recipient))
    return direct.unionByName(loud)


BUCKETS = 16


def committed(spark: SparkSession, target: str, before: int | None = None) -> list:
    """(bucket, version) of the last committed epoch, or of the last one before an epoch; one row per bucket."""
    try:
        commits = spark.read.parquet(f"{target}/commits")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    commits = commits if before is None else commits.filter(F.col("epoch") < before)
    newest = commits.agg(F.max("epoch")).first()[0]
    return [] if newest is None else commits.filter(F.col("epoch") == newest).select("bucket", "version").collect()


def read_status(spark: SparkSession, target: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The committed rows, of some buckets only if asked; None before the first commit."""
    rows = [r for r in committed(spark, target, before) if buckets is None or r.bucket in buckets]
    return spark.read.parquet(*[f"{target}/v{r.version}/bucket={r.bucket}" for r in rows]) if rows else None


def latest_status(target: str, key: str, order: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Batch handler keeping the newest row per job, in buckets of the key.

    An epoch merges its rows into the buckets that they touch and writes these only, as a
    version of its own; then it commits a pointer from every bucket to its version.  Readers
    follow the last commit.  An epoch that is run again starts from the commit before it and
    writes the same version, so it changes nothing.
    """

    def merge(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        placed = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = sorted(r.bucket for r in placed.select("bucket").distinct().collect())
        if not touched:
            return
        old = read_status(spark, target, epoch, touched)
        rows = batch if old is None else old.select(*batch.columns).unionByName(batch)
        others = [c for c in batch.columns if c != key]
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*others), order).alias("__r")).select(key, "__r.*")
        newest.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/v{epoch}")
        versions = {r.bucket: r.version for r in committed(spark, target, epoch)} | dict.fromkeys(touched, epoch)
        pointer = spark.createDataFrame(list(versions.items()), "bucket int, version long")
        pointer.coalesce(1).write.mode("overwrite").parquet(f"{target}/commits/epoch={epoch}")

    return merge


CHUNK = 4096  # events or agents in one row of the state


class BudgetProcessor(StatefulProcessor):
    """Keeps the events of a bucket of agents until the watermark has passed them, then spends each budget in their order.

    The state is rows of arrays and is read and written once per bucket and micro-batch; agents
    with a full budget take no place in it.  Agents are told apart by their text.
    """

    def __init__(self, time: str, ties: dict[str, str], budget: int):
        self.time, self.ties, self.budget = time, ties, budget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = {"agent": "string", "us": "bigint", **self.ties, "w": "bigint"}
        self.waiting = handle.getListState("waiting", ", ".join(f"`{c}` array<{kind}>" for c, kind in kinds.items()))
        self.left = handle.getListState("left", "agent array<string>, remaining array<bigint>")
        self.settled = handle.getValueState("settled", "mark bigint")

    def names(self) -> list[str]:
        return ["agent", "us", *self.ties, "w"]

    def mark(self) -> int:
        found = self.settled.get()
        return -1 if found is None else found[0]

    @staticmethod
    def rows(state, names: list[str]) -> pd.DataFrame | None:
        chunks = list(state.get())
        columns = [[v for chunk in chunks for v in chunk[i]] for i in range(len(names))]
        return pd.DataFrame({c: pd.Series(v, dtype=object if None in v else None) for c, v in zip(names, columns)}) if chunks else None

    @staticmethod
    def keep(state, rows: pd.DataFrame) -> None:
        plain = rows.astype(object).where(rows.notna(), None)
        if len(rows):
            state.put([tuple(plain[c].iloc[at:at + CHUNK].tolist() for c in rows.columns) for at in range(0, len(rows), CHUNK)])
        else:
            state.clear()

    def spent(self, ready: pd.DataFrame) -> pd.DataFrame:
        """The events that use up a budget; the budgets that are left are kept."""
        ready = ready.assign(who=pd.factorize(ready["agent"], use_na_sentinel=False)[0]).sort_values(["who", "us", *self.ties], kind="stable")
        who = ready["who"].to_numpy()
        starts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        agents = ready["agent"].iloc[starts].tolist()
        left = self.rows(self.left, ["agent", "remaining"])
        budgets = {} if left is None else dict(zip(left["agent"], left["remaining"].tolist()))
        remaining, fired = spend_each(ready["w"].to_numpy(dtype=np.int64), starts, [budgets.pop(a, self.budget) for a in agents], self.budget)
        lasts = np.append(starts[1:], len(ready)) - 1
        budgets |= {a: int(n) for a, n, full in zip(agents, remaining[lasts], fired[lasts]) if not full}
        self.keep(self.left, pd.DataFrame({"agent": pd.Series(list(budgets), dtype=object), "remaining": list(budgets.values())}))
        return ready[fired]

    def settle(self, rows: pd.DataFrame, held: bool, mark: int) -> Iterator[pd.DataFrame]:
        """Events before the watermark (milliseconds) are spent; the first of the others sets the next timer."""
        due = (rows["us"] < mark * 1000).to_numpy(dtype=bool)
        rest = rows[~due]
        if due.any() or not held:
            self.keep(self.waiting, rest)
        if due.any():
            out = self.spent(rows[due])
            if len(out):
                yield pd.DataFrame({"agent": out["agent"], self.time: pd.to_datetime(out["us"].astype("int64"), unit="us", utc=True)} | {c: out[c] for c in self.ties})
        self.settled.update((mark,))
        if len(rest):
            self.handle.registerTimer(int(rest["us"].min()) // 1000 + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        settled = self.mark()
        # an event behind what is settled is late
        parts = [part.loc[part["us"] >= settled * 1000, self.names()] for part in rows]
        parts = [part for part in (self.rows(self.waiting, self.names()), *parts) if part is not None and len(part)]
        if parts:
            yield from self.settle(pd.concat(parts, ignore_index=True), False, max(timerValues.getCurrentWatermarkInMs(), 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = max(timerValues.getCurrentWatermarkInMs(), 0)
        rows = self.rows(self.waiting, self.names()) if self.mark() < mark else None  # else settled with the rows of this micro-batch
        if rows is not None:
            yield from self.settle(rows, True, mark)

    def close(self) -> None:
        pass


AGENT_BUCKETS = 1024


def budget_stream(events: DataFrame, agent: str, time: str, ties: list[str], weight: str, budget: int, delay: str = "1 day", buckets: int = AGENT_BUCKETS) -> DataFrame:
    """Triggered events of each agent, in the order of time and ``ties``, whatever order they arrive in.

    An event waits until the watermark has passed it, so files may overlap in time by up to the
    delay; later ones are dropped, and no more than that span is held.  Agents share buckets, so a
    call of the state serves many of them.  Needs the RocksDB state store (``drain(..., rocksdb=True)``).
    """
    kind, kinds = events.schema[agent].dataType, {c: events.schema[c].dataType.simpleString() for c in ties}
    timed = _timed(events, time).withWatermark(time, delay)
    bucket = F.pmod(F.xxhash64(agent), F.lit(buckets)).cast("int")
    lean = timed.select(bucket.alias("__bucket"), F.col(agent).cast("string").alias("agent"), time, F.unix_micros(time).alias("us"), *ties, F.col(weight).cast("long").alias("w"))
    out = f"agent string, `{time}` timestamp" + "".join(f", `{c}` {k}" for c, k in kinds.items())
    fired = lean.groupBy("__bucket").transformWithStateInPandas(BudgetProcessor(time, kinds, budget), out, "append", "EventTime")
    return fired.select(F.col("agent").cast(kind).alias(agent), time, *ties)
