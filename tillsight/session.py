"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans in this package rely on: Spark's default and ours.  They
# are only filled in where the user has not chosen a value.
#
# forceOptimizeSkewedJoin lets AQE split a hot join key even when the join's
# partitioning would otherwise be reused by the aggregation above it.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": ("true", "true"),
    "spark.sql.adaptive.coalescePartitions.enabled": ("true", "true"),
    "spark.sql.adaptive.skewJoin.enabled": ("true", "true"),
    "spark.sql.adaptive.forceOptimizeSkewedJoin": ("false", "true"),
}

# Sales queries shuffle all order lines, and a task sorts and groups what one
# partition holds.  Shuffles begin with PARTITIONS parts, or as many as the
# user's own number, and AQE joins them up to 16 MB: a quarter of its default,
# under which a task holds over 1 GB for 64 MB of compressed lines.  200 parts
# is the most that a map task writes without holding its rows.
PARTITIONS = 200
PART_SIZE = "16m"


def tune(spark: SparkSession) -> SparkSession:
    """Fill in the adaptive-execution settings the user has left open.

    A setting counts as chosen when the context was started with it, or when
    the session holds another value than Spark's own default.
    """
    started = {key for key, _ in spark.sparkContext.getConf().getAll()}
    for key, (own, value) in _DEFAULTS.items():
        if key not in started and spark.conf.get(key) == own:
            spark.conf.set(key, value)
    return spark


def tune_sales(spark: SparkSession) -> SparkSession:
    """``tune``, and shuffles in small parts, where the user has left their size and number open."""
    number = max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in (("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(number)),
                       ("spark.sql.adaptive.advisoryPartitionSizeInBytes", PART_SIZE)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Where it is unset on a local master - a test or a trial on one machine -
    it is set here, once for the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="tillsight-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tillsight/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's part of it."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged; frames read from it end with it."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """``df`` in as many partitions as a shuffle has, also where AQE would join small ones: for iterative training."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the copy.

    Used where several jobs read the same intermediate result.  The copy cuts
    lineage, survives the loss of executors and keeps column pruning.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside has its shuffle files deleted once it is written: for loops that stage every round."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(staged: DataFrame) -> None:
    """Delete the copy behind a frame from ``stage`` that nothing reads any more."""
    spark = staged.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path(folder), True)
