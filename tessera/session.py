"""Session construction and shared job settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for these jobs: AQE on (runtime coalescing, skew-join
    splitting, broadcast conversion of small sides by measured size), UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of data no longer referenced are deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder.

    On a cluster the folder is named by ``spark.checkpoint.dir`` (a shared file
    system); it is used as given, and a job without it is refused.  A private
    scratch folder is made only where driver and executors are one process
    (a ``local`` master, as in tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for intermediate files that
    must survive executor loss (written tables, CSV round trips)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and read it from
    there: for tables several branches of a plan consume (Spark does not share
    their computation otherwise), and to cut lineage.  Survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """As ``materialize``, as compressed Parquet: a fraction of the disk of
    checkpoint files, and later readers read only the columns they use."""
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def load_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread_input(df) if spread else df


def spread_input(df: DataFrame, per_core: int = 2) -> DataFrame:
    """Make sure heavy per-row work (regex tokenization, byte-pair pieces)
    runs on every core.  A large scan already has many splits and is left
    alone; a scan with fewer splits than the cluster's cores (e.g. one
    oversized row group) is redistributed round-robin (deterministic on
    recomputation: Spark sorts before a round-robin repartition)."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()  # planning only, no job
    except Exception:  # noqa: BLE001  (a remote session: leave the scan as is)
        return df
    if splits >= cores:
        return df
    return df.repartition(cores * per_core)
