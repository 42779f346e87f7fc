"""Incremental run discovery: each run is reported once, however often its files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortflow.functions import ids
from cohortflow.operators.planning import below, discovery_folders


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def runs_once(arrivals: DataFrame, keys: tuple[str, ...] = ("folder", "run_id")) -> DataFrame:
    """Each run of a stream of file arrivals, when it is first seen.

    The runs seen are the state of the stream, by key in its checkpoint. No event time is involved, so late
    files and files with old times count, and a run is never reported again, however late its files.
    """
    return arrivals.select(*keys).dropDuplicates(list(keys))


def report_runs(runs: DataFrame, path: str, state: str) -> StreamingQuery:
    """Append the runs to the table at ``path``, whose log of files replaces listing its folder; all that has arrived at a time.

    The state store keeps what does not fit in memory on disk, and its changes in the checkpoint folder ``state``.
    """
    spark = runs.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        # The query keeps the settings it was started with.
        writer = runs.writeStream.format("parquet").option("path", path).option("checkpointLocation", state)
        return writer.trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def arrivals_from_files(files: DataFrame, root: str, pattern: str = r"\.bam$") -> DataFrame:
    """Folder, run and time of each read file of a stream (or table) of file listings."""
    inner = below(F.col("path"), root)
    return files.filter(F.col("path").rlike(pattern)).select(
        ids.path_part(inner, 1).alias("folder"),
        ids.path_part(inner, 2).alias("run_id"),
        "modificationTime",
    )


def with_types(runs: DataFrame) -> DataFrame:
    """Analysis types served by each run's folder; the lookup has eight fixed rows."""
    return runs.join(F.broadcast(discovery_folders(runs.sparkSession)), "folder")
