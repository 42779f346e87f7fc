"""Writers of tabular outputs. None of them writes to a path its own plan reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import __version__
from cohortflow import fixed_values as V
from cohortflow.functions import ids, values
from cohortflow.operators import run_sheets
from cohortflow.session import broadcast_if_small, written
from cohortflow.sinks import commits
from cohortflow.sources.results import path_exists
from cohortflow.sources.tables import check_format, read_run_sheets


def stamp_version(df: DataFrame, version: str = __version__) -> DataFrame:
    """Add the version of the code that made the rows."""
    return df.withColumn("producer_version", F.lit(version))


def report_empty(df: DataFrame, message: str) -> bool:
    """True, with a message, if there is nothing to write."""
    empty = df.isEmpty()
    if empty:
        print(message)
    return empty


# Layout for many individuals: a folder per site, individuals side by side in its files.
SITE_LAYOUT = V.SHEET_KEYS[:2]


def write_run_sheets(
    sheet: DataFrame,
    path: str,
    previous: DataFrame | None = None,
    only_changed: bool = False,
    layout: Sequence[str] = V.SHEET_KEYS,
    digests: str | None = None,
) -> DataFrame:
    """Write run sheets, replacing only the individuals in ``sheet``; returns the unnamed rows.

    The usual layout has one folder per individual. ``SITE_LAYOUT`` keeps the folder count small
    however many individuals there are; there the other individuals of the sites that are
    rewritten are carried over from ``previous``, the sheets as they are, which is read from
    ``path`` if not given. With ``only_changed``, individuals whose rows equal the previous ones
    are left alone, so their files do not become newer. ``digests`` is a table of the digest of each sheet as it was last
    written (:mod:`cohortflow.sinks.commits`, made if missing); with it no old sheet is read to find those that differ.
    A write that stops before the digests are stored is simply repeated.
    """
    named, unnamed = run_sheets.reject_unnamed(sheet)
    keys, columns = list(V.SHEET_KEYS), [*V.SHEET_KEYS, *V.SHEET_COLUMNS]
    named = named.select(*columns)
    spark = sheet.sparkSession
    if digests is not None:
        fresh = written(run_sheets.sheet_digests(named, keys), "digests")
        stored = read_digests(spark, digests)
        if only_changed:
            fresh = written(fresh.join(stored, [*keys, "digest"], "left_anti"), "changed")
            if fresh.isEmpty():
                return unnamed
            # Few of many sheets change as a rule; then the others are not shuffled to find these.
            named = named.join(broadcast_if_small(fresh.select(*keys)), keys, "left_semi").select(*columns)
    elif only_changed:
        if previous is None:
            raise ValueError("only_changed needs the previous sheets or their digests")
        changed = run_sheets.changed_individuals(named, previous.select(*columns), keys)
        named = named.join(changed, keys, "left_semi").select(*columns)
    if "target_ind" not in layout:
        if previous is None and path_exists(spark, path):
            previous = read_run_sheets(spark, path, layout)
        if previous is not None:
            # The new rows are read twice from here on, and the old ones lie where they are replaced.
            named = written(named, "sheets")
            # A shuffle of the old rows by their few sites would put them into a few tasks.
            sites = broadcast_if_small(named.select(*layout).distinct())
            individuals = broadcast_if_small(named.select(*keys).distinct())
            inside = run_sheets.matching(previous.select(*columns), sites, layout, "left_semi")
            carried = run_sheets.matching(inside, individuals, keys, "left_anti")
            named = named.unionByName(written(carried, "carried"))
    # Rebalancing puts a folder's rows together and splits those of a very large one over several
    # tasks and files; lanes keep the order.
    (
        named.hint("rebalance", *[F.col(key) for key in layout])
        .sortWithinPartitions(*keys, "Lane")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", V.SHEET_MISSING)
        .partitionBy(*layout)
        .csv(path)
    )
    if digests is not None:
        commits.add(spark, digests, lambda base: {"digests": fresh.withColumn("written", F.lit(base + 1).cast("long"))})
    return unnamed


_DIGESTS = ", ".join([*(f"{key} string" for key in V.SHEET_KEYS), "digest string", "written bigint"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """The digest of each individual's sheet as it was last written; the table is made if there is none."""
    if not path_exists(spark, f"{path}/commits"):
        commits.create(spark, path)
    rows = commits.read(spark, path, "digests", _DIGESTS)
    return rows.groupBy(*V.SHEET_KEYS).agg(F.max_by("digest", "written").alias("digest"))


def merge_digests(spark: SparkSession, path: str) -> int:
    """Keep one digest per individual, so that later reads start from there."""
    return commits.add(
        spark,
        path,
        lambda base: {"digests": read_digests(spark, path).withColumn("written", F.lit(base + 1).cast("long"))},
        whole=True,
    )


def write_versions(sheet: DataFrame, path: str, version: str = __version__) -> None:
    """Append the producer version of each individual's sheet, and when it was written, to a small table."""
    individuals = sheet.select(*V.SHEET_KEYS).distinct()
    stamped = stamp_version(individuals, version).withColumn("written_at", F.current_timestamp())
    stamped.write.mode("append").parquet(path)


def latest_versions(spark: SparkSession, path: str) -> DataFrame:
    """The producer version of each individual's newest sheet."""
    newest = F.max(F.struct("written_at", "producer_version")).alias("_newest")
    versions = spark.read.parquet(path).groupBy(*V.SHEET_KEYS).agg(newest)
    return versions.select(*V.SHEET_KEYS, F.col("_newest.producer_version").alias("producer_version"))


def write_debug(df: DataFrame, path: str) -> None:
    """The whole result as tab-separated text with a header in each part, for looking things up."""
    df.write.option("sep", "\t").option("header", True).option(
        "nullValue", V.SHEET_MISSING
    ).csv(path)


def write_metadata(df: DataFrame, path: str) -> None:
    """Metadata as text, missing values as ``n/a``, to a new path."""
    values.textify(df).write.option("sep", "\t").option("header", True).option(
        "emptyValue", ""
    ).csv(path)


def ind_lines(index: DataFrame, fmt: str) -> DataFrame:
    """Columns of the sample index in file order, sex encoded where the format wants a code."""
    check_format(fmt)
    if fmt == "PLINK":
        index = index.withColumn("sex_code", values.encode_sex(F.col("Genetic_Sex")))
    return index.select(*V.IND_COLUMNS[fmt])


def write_ind(index: DataFrame, path: str, fmt: str, order: str | None = None) -> None:
    """Sample index without header; parts follow each other in ``order`` if one is given."""
    ordered = index.orderBy(order) if order else index
    ind_lines(ordered, fmt).write.option("sep", "\t").option("emptyValue", "").csv(path)


def write_queue(queue: DataFrame, path: str) -> None:
    """One command per line; part files and lines follow the task numbers."""
    queue.orderBy("task_id").select("command").write.text(path)


def write_snapshot(processed: DataFrame, counts: DataFrame, root: str, stamp: Column | None = None):
    """Append the processed list, its unique form and the counts under a dated folder."""
    moment = ids.date_stamp() if stamp is None else stamp
    tables = {
        "processed": processed,
        "unique": processed.select("individual").distinct(),
        "counts": counts,
    }
    for name, table in tables.items():
        table.withColumn("snapshot", moment).write.mode("append").partitionBy("snapshot").parquet(
            f"{root}/{name}"
        )
