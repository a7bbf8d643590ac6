"""Session defaults, shared scratch folder and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app: str = "starloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster
    executors cannot see each other's disks, so the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="starloom-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Give a small input with few splits to all cores before costly per-row work.

    A large input already has more splits than cores and is left alone, so no
    shuffle is added where it would hurt.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


BROADCAST_ROWS = 1_000_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a join side of narrow rows after counting them; a larger one keeps its shuffle join.

    For sides whose size the optimizer cannot know, such as written or
    aggregated tables.  Counting stops just above the limit.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the rows column by column to the shared scratch folder and continue from there.

    Positions and partition ids taken before stay valid after it, a later step reads only the
    columns that it uses, and the folder goes when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and continue from there.

    Partition ids and row positions taken before the call stay valid after it,
    also when an executor is lost and its tasks are run again.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)
