"""Session set-up and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Short rows of a few numbers for one task of an iteration.
ROWS_PER_TASK = 8192
_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(app_name: str = "quillspark", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with adaptive execution and skew handling on.

    Partition counts, memory and the checkpoint folder are left to the cluster;
    pass them as keyword arguments (dots written as double underscores).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder. On a
    cluster a machine-local folder would vanish with its machine, so a missing
    setting is an error there.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="quillspark-")
    return _local_scratch.name


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/quillspark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors and computes the input a single
    time, after which the file sizes give the optimizer exact statistics.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrowed(df: DataFrame, rows: int) -> DataFrame:
    """Merge the partitions of ``df``, which has ``rows`` rows at most, so that a small table isn't dealt over many tiny tasks.

    A large table keeps its partitions. Adaptive execution does the same where it may; iterations can't rely on it.
    """
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a file scan out to all cores when it has fewer splits than cores.

    A table in one small file would otherwise be cleaned by a single task. A large
    table has more splits than cores and passes unchanged, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def packed(table: DataFrame, row_bytes: int, rows: int, part_bytes: int = 4 * 1024 * 1024) -> DataFrame:
    """Merge the splits of a small table that an iterative fit reads again and again.

    The number of splits follows the size of the data, so that a tiny table does
    not pay for many tasks in every iteration and a large one stays spread out.
    """
    wanted = max(1, -(-row_bytes * rows // part_bytes))
    return table.coalesce(wanted) if wanted < table.rdd.getNumPartitions() else table
