"""Session helpers: a local session for tests and benchmarks, and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CHECKPOINT_KEY = "spark.checkpoint.dir"

# Largest lookup table that is sent to every executor.
BROADCAST_ROWS = 200_000


def local_session(cores: int | str, app: str, scratch: str) -> SparkSession:
    """Session for tests and local benchmarks, with ``scratch`` as its shared folder; clusters bring their own."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config(_CHECKPOINT_KEY, scratch)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Small local partitions would otherwise all be put into one task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        # Joins of more than tiny tables are broadcast on measured sizes only, not on estimates.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "32m")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    named = spark.conf.get(_CHECKPOINT_KEY, None) or context.getConf().get(_CHECKPOINT_KEY)
    named = named or context.getCheckpointDir()
    if named is None:
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch_root(spark: SparkSession) -> str:
    """The application's own folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/cohortflow-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's folder; nothing is ever written there twice."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application has written down; results not yet read or saved elsewhere are lost."""
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def written(df: DataFrame, label: str = "rows", compression: str = "snappy") -> DataFrame:
    """The rows as a table in the shared folder: made once, and safe from the loss of executors.

    Later reads of it take only the columns they need.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(lookup: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The lookup table, marked for broadcast if counting proves that it has at most ``rows`` rows.

    A larger one is left to an ordinary join. Meant for narrow tables that many rows look up, where
    a shuffle by the few lookup keys would put most rows into a few tasks.
    """
    return F.broadcast(lookup) if lookup.limit(rows + 1).count() <= rows else lookup


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors of a cluster where it is not installed.

    Listing files, hashing them, and the operators for training data run Python there.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # Served to executors by the driver, so its own folder will do.
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "cohortflow"), "zip", root, "cohortflow")
    spark.sparkContext.addPyFile(archive)


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few fixed rows as a local table, whose size the optimizer knows."""
    names = T.StructType.fromDDL(schema).names
    listed = pa.Table.from_pylist([dict(zip(names, row)) for row in rows])
    return spark.createDataFrame(listed, schema)
