"""New reads to run sheets, and run sheets to the queue: one job for all runs and individuals."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import __version__
from cohortflow import fixed_values as V
from cohortflow.functions import ids, values
from cohortflow.operators import cohorts, lims, planning, restriction, run_sheets
from cohortflow.operators.numbering import GROUP_LIMIT, group_bound
from cohortflow.session import written
from cohortflow.sinks.tables import SITE_LAYOUT, report_empty, write_run_sheets, write_versions


def cohort_rows(
    tables: Mapping[str, DataFrame],
    runs: DataFrame,
    policy: str = "union",
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Consented, not excluded rows of every individual the runs touch, per analysis type.

    ``runs`` has ``run_id``, and may name an ``analysis_type`` for each run. What ``keep`` drops is not written down, and
    brings no other individual in.
    """
    return _flat_and_cohorts(tables, runs, policy, keep)[1]


def _flat_and_cohorts(
    tables: Mapping[str, DataFrame], runs: DataFrame, policy: str, keep: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """The usable flat rows, written down, and those of them that :func:`cohort_rows` returns."""

    def usable(flat: DataFrame) -> DataFrame:
        rows = lims.not_excluded(lims.consented(values.enforce_types(flat, lims.FLAGS)))
        return keep(lims.with_analysis_type(rows))

    # Runs are looked up several times; as a small table they need no shuffle of the rows by run.
    named = [name for name in ("run_id", "analysis_type") if name in runs.columns]
    runs = written(runs.select(*named).distinct(), "runs")
    tables = {**tables, "analysis": lims.of_known_pipelines(tables["analysis"])}
    flat = cohorts.flat_of_runs(tables, runs, keep=usable)
    return flat, cohorts.expand_cohorts(flat, runs, ["analysis_type"], policy=policy, settled=True)


def prepare_run_sheets(
    tables: Mapping[str, DataFrame],
    runs: DataFrame,
    protocols: DataFrame,
    sensitive: DataFrame | None = None,
    whitelist: DataFrame | None = None,
    rebase: tuple[str, str] | None = None,
    rename: bool = False,
    policy: str = "union",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Run sheets of all touched individuals.

    ``sensitive`` lists restricted sequencing IDs and ``whitelist`` target individuals, one ``id``
    per row. Both are applied to whole individuals, so the lanes of the others do not change.
    """
    target = ids.canonical_id(F.col(cohorts.FULL), F.col(cohorts.MAIN))

    # Before anything is numbered or written down, so that no restricted row reaches the shared folder.
    def unrestricted(rows: DataFrame) -> DataFrame:
        if sensitive is None:
            return rows
        return restriction.scrub(rows.withColumn("target_ind", target), sensitive, "target_ind").drop("target_ind")

    flat, rows = _flat_and_cohorts(tables, runs, policy, unrestricted)
    if whitelist is not None:
        # Settled with the whitelist as it is now.
        rows = run_sheets.whitelisted(rows.withColumn("target_ind", target), whitelist).drop("target_ind")
        return run_sheets.build_run_sheet(rows, protocols, rebase=rebase, rename=rename, limit=limit)
    # Each of ``rows`` is one of ``flat``, which is written down already.
    largest = group_bound(flat.withColumn("target_ind", target), ["analysis_type", "target_ind"])
    return run_sheets.build_run_sheet(rows, protocols, rebase=rebase, rename=rename, limit=limit, largest=largest)


def publish_run_sheets(
    sheet: DataFrame,
    path: str,
    versions: str,
    layout: Sequence[str] = SITE_LAYOUT,
    version: str = __version__,
) -> bool:
    """Write the sheets and the versions that made them; False, with a message, if there is nothing to write."""
    sheet = written(sheet, "sheet")
    named, _ = run_sheets.reject_unnamed(sheet)
    if report_empty(named, "No new rows for any run sheet."):
        return False
    write_run_sheets(named, path, layout=layout)
    write_versions(named, versions, version)
    return True


def sheet_files(files: DataFrame, root: str) -> DataFrame:
    """Run sheet files below ``root`` as ``analysis_type, site_id, individual`` and their paths.

    The folders are named ``key=value`` by the writer; plain names work as well.
    """
    inner = planning.below(F.col("path"), root)

    def folder(position: int) -> Column:
        return F.substring_index(ids.path_part(inner, position), "=", -1)

    return files.select(
        folder(1).alias("analysis_type"),
        folder(2).alias("site_id"),
        folder(3).alias("individual"),
        "path",
        "modificationTime",
    )


def sheet_individuals(sheets: DataFrame, changed: DataFrame) -> DataFrame:
    """Inputs of :func:`plan_queue` in any layout: the individuals that sheet rows name, and when each changed.

    ``sheets`` are rows as read back, ``changed`` has the sheet keys, ``path`` and ``modificationTime``: what
    a caller keeps of each write (``written_at``). File names are not used, so it does not matter how
    many individuals share a file.
    """
    keys = list(V.SHEET_KEYS)
    named = sheets.select(*keys).distinct()
    newest = changed.groupBy(*keys).agg(
        F.max("modificationTime").alias("modificationTime"), F.min("path").alias("path")
    )
    return named.join(newest, keys).select(
        "analysis_type", "site_id", F.col("target_ind").alias("individual"), "path", "modificationTime"
    )


def written_at(sheet: DataFrame, path: str, moment: Column) -> DataFrame:
    """Which individuals a write of ``sheet`` to ``path`` touched, and when."""
    return (
        sheet.filter(F.col("target_ind").isNotNull())
        .select(*V.SHEET_KEYS)
        .distinct()
        .withColumns({"path": F.lit(path), "modificationTime": moment})
    )


def plan_queue(
    sheets: DataFrame,
    reports: DataFrame,
    output_root: str,
    settings: dict[str, str],
    sensitive: DataFrame | None = None,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Numbered commands for every individual whose sheet is newer than its report.

    ``sheets`` comes from ``sheet_files``; ``reports`` has the same keys and ``modificationTime``.
    The parts of one sheet count as one input, as new as its newest part.
    """
    keys = ["analysis_type", "site_id", "individual"]
    newest = F.max("modificationTime").alias("modificationTime")
    inputs = sheets.groupBy(*keys).agg(newest, F.min("path").alias("path"))
    pending = planning.pending_runs(inputs, reports, keys)
    if sensitive is not None:
        pending = restriction.scrub(pending, sensitive, "individual")
    path = F.col("path")
    directory = F.substring_index(path, "/", -1)
    commands = planning.queue_command(
        pending.withColumn(
            "directory", F.substr(path, F.lit(1), F.length(path) - F.length(directory) - 1)
        ).withColumn("outdir", F.concat_ws("/", F.lit(output_root), *keys)),
        settings,
    )
    return planning.with_task_id(commands.select(*keys, "command"), keys, limit)
