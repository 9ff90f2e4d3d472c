"""Session defaults and the shared scratch folder."""
from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: int | str = "*", app: str = "tellmark", **conf: str) -> SparkSession:
    """A local session with the settings the library is tuned for.

    On a cluster the session comes from spark-submit; the adaptive settings
    below are the ones that matter there (coalescing small shuffle partitions,
    splitting skewed ones).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        # Hash instead of sort where the measured partitions of one side fit well in memory.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    Without the setting it is the context's checkpoint folder, and a temporary folder only on a
    local master, as in tests; on a cluster each executor would have its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tellmark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, unique per call."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that is made inside go as soon as it is done, where Spark can do so."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark.conf.get(cleanup, None)  # none where only the default holds
    with contextlib.suppress(Exception):
        spark.conf.get(cleanup)  # fails where Spark does not know it
        spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(cleanup)
        else:
            spark.conf.set(cleanup, own)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: lineage ends here, later reads are
    pruned column by column, and a lost executor costs no recomputation. The shuffle files
    that led to the table go as soon as it is written. Tables are packed with zstd, as texts and
    sets in them are most of what a job holds on disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with without_shuffle_files(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)
