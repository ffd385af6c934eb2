"""Session helpers: local sessions for tests and benches, and a shared
checkpoint folder read from the session's own configuration."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wordloom") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (``local[...]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir,
    as a URI with its scheme.

    Only a local session without one gets a scratch folder; on a cluster a
    driver-side folder would be invisible to the executors, so a missing
    setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="wordloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Folders written by :func:`cut_lineage`, by application.
_WRITTEN: dict[str, list[str]] = {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from it: lineage is cut, the data survives executor loss,
    and later reads are columnar (faster than ``checkpoint()``'s
    row-serialised files).  :func:`drop_written` removes the tables."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/wordloom-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.parquet(path)


def drop_written(spark: SparkSession) -> int:
    """Delete the tables this application wrote through :func:`cut_lineage`
    and return their number.  Call it when no DataFrame built on them is
    needed any more."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    return len(paths)


def broadcast_checked(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most
    ``max_rows`` rows; a larger side keeps its shuffle join."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def path_missing(error: Exception) -> bool:
    """Whether a read failed because nothing is stored there, and not for
    any other reason."""
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table with fewer files than cores evenly over the
    cores (round-robin: no key, so no hot key).  For local runs on small
    files; on a cluster scans have splits enough."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def table(spark: SparkSession, sf_dir: str, name: str, deal: bool | None = None) -> DataFrame:
    """One of the driver tables, ``{sf_dir}/{name}.parquet``.  ``deal``
    spreads its rows over the cores; by default only in a local session."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if (is_local(spark) if deal is None else deal) else df
