"""What has to be done: new runs, stale results, package states, and the work queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import ids
from cohortflow.operators.numbering import GROUP_LIMIT, number_rows
from cohortflow.session import fixed_table


def newer_than(left: Column, right: Column) -> Column:
    """True if the left file is newer, or only the left one exists; a missing left is never newer."""
    return F.when(left.isNull(), False).when(right.isNull(), True).otherwise(left > right)


def recent(files: DataFrame, now: Column, hours: int = 24, mtime: str = "modificationTime"):
    """Files changed within the last ``hours`` before ``now``."""
    return files.filter(F.col(mtime) >= now - F.expr(f"interval {hours} hours"))


def discovery_folders(spark: SparkSession) -> DataFrame:
    """Fixed lookup ``(analysis_type, folder)`` of the result folder each type is found in."""
    rows = list(V.DISCOVERY_FOLDERS.items())
    return fixed_table(spark, rows, "analysis_type string, folder string")


def below(path: Column, root: str) -> Column:
    """The part of a path below ``root``."""
    return F.split_part(path, F.lit(f"{root.rstrip('/')}/"), F.lit(2))


def new_runs(
    files: DataFrame,
    now: Column,
    root: str,
    folders: DataFrame | None = None,
    hours: int = 24,
    run_pattern: str = "^2",
    name_pattern: str = r"\.bam$",
) -> DataFrame:
    """Distinct runs per analysis type with a recently changed read file.

    ``files`` has ``path`` and ``modificationTime``; below ``root`` come the folder, the run, and
    the files at any depth. A folder may serve several analysis types. The folder lookup has eight
    fixed rows unless given.
    """
    if folders is None:
        folders = F.broadcast(discovery_folders(files.sparkSession))
    inner = below(F.col("path"), root)
    found = (
        recent(files, now, hours)
        .filter(F.col("path").rlike(name_pattern))
        .select(
            ids.path_part(inner, 1).alias("folder"),
            ids.path_part(inner, 2).alias("run_id"),
        )
        .filter(F.col("run_id").rlike(run_pattern))
        .distinct()
    )
    return found.join(folders, "folder").select("analysis_type", "run_id").distinct()


def pending_runs(
    inputs: DataFrame, reports: DataFrame, on: Sequence[str] = ("analysis_type", "individual")
) -> DataFrame:
    """Inputs without a report, or with one older than themselves.

    Both sides have the ``on`` columns and ``modificationTime``; several files of one key count by
    their newest.
    """
    keys = list(on)
    done = reports.groupBy(*keys).agg(F.max("modificationTime").alias("_reported"))
    return (
        inputs.join(done, keys, "left")
        .filter(newer_than(F.col("modificationTime"), F.col("_reported")))
        .drop("_reported")
    )


def queue_command(df: DataFrame, settings: dict[str, str], template: str = V.COMMAND) -> DataFrame:
    """Add ``command``: the template filled from the row's columns and the given settings.

    A name in braces is a column of ``df`` if there is one, else a setting. Blanks are squeezed after filling in.
    """
    pieces: list[Column] = []
    for text in template.split("{"):
        name, closed, rest = text.partition("}")
        if closed:
            pieces.append(F.col(name) if name in df.columns else F.lit(settings[name]))
            pieces.append(F.lit(rest))
        else:
            pieces.append(F.lit(text))
    return df.withColumn("command", F.trim(ids.squeeze_blanks(F.concat(*pieces))))


def with_task_id(
    df: DataFrame,
    order: Sequence[str] = ("analysis_type", "site_id", "individual"),
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Number the queue from 1 in a fixed order, however long it is."""
    return number_rows(df, [], order, "task_id", limit=limit)


def task(queue: DataFrame, number: int) -> DataFrame:
    """The row of one task number."""
    return queue.filter(F.col("task_id") == number)


def queue_size(queue: DataFrame) -> DataFrame:
    return queue.agg(F.count(F.lit(1)).alias("n_tasks"))


# Package states, in the order they are tested.
PACKAGE_STATES = (
    "ERROR_NO_DIR",
    "ERROR_NO_GENO",
    "CREATE_MIXED",
    "CREATE_SINGLE",
    "UPDATE_MIXED",
    "UPDATE_SINGLE",
    "NO_CHANGE",
)


def genotype_states(files: DataFrame, on: str = "individual") -> DataFrame:
    """Genotype file state per individual from rows ``(individual, name, modificationTime)``.

    Rows are result files; any row proves that the result directory exists.
    """
    time = F.col("modificationTime")
    return files.groupBy(on).agg(
        F.max(F.when(F.col("name") == V.SINGLE_GENOTYPES, time)).alias("single_time"),
        F.max(F.when(F.col("name") == V.DOUBLE_GENOTYPES, time)).alias("double_time"),
    )


def plan_packages(
    wanted: DataFrame, files: DataFrame, packages: DataFrame, on: str = "individual"
) -> DataFrame:
    """State of each wanted individual's package.

    ``wanted`` has one row per individual, ``files`` the result files of ``genotype_states``,
    ``packages`` one ``modificationTime`` per existing package (NULL if its genotypes are missing).
    """
    results = genotype_states(files, on).withColumn("_has_results", F.lit(True))
    existing = packages.select(
        on, F.col("modificationTime").alias("package_time"), F.lit(True).alias("_has_package")
    )
    joined = wanted.select(on).join(results, on, "left").join(existing, on, "left")
    single, double = F.col("single_time"), F.col("double_time")
    both = single.isNotNull() & double.isNotNull()
    stale = newer_than(single, F.col("package_time")) | newer_than(double, F.col("package_time"))
    no_package = F.col("_has_package").isNull()
    state = (
        F.when(F.col("_has_results").isNull(), "ERROR_NO_DIR")
        .when(single.isNull() & double.isNull(), "ERROR_NO_GENO")
        .when(no_package & both, "CREATE_MIXED")
        .when(no_package, "CREATE_SINGLE")
        .when(stale & both, "UPDATE_MIXED")
        .when(stale, "UPDATE_SINGLE")
        .otherwise("NO_CHANGE")
    )
    return joined.select(on, "single_time", "double_time", "package_time", state.alias("state"))
