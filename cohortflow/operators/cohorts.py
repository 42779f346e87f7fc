"""Cohorts: which individuals a sequencing run touches, and all of their rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions import ids
from cohortflow.operators import lims
from cohortflow.session import broadcast_if_small, written

FULL = "full_individual_id"
MAIN = "main_individual_id"


def cohort_ids(
    rows: DataFrame, keys: Sequence[str] = (), full: str = FULL, main: str = MAIN
) -> DataFrame:
    """Distinct full IDs and non-empty main IDs of ``rows`` (per ``keys``), in one ID column."""
    both = F.array(F.col(full), F.when(F.col(main) != "", F.col(main)))
    return rows.select(*keys, F.explode(F.array_compact(both)).alias(full)).distinct()


# From a sequencing up to its individual: each table, and the column that names the one above.
_ANCESTORS = (("capture", "library"), ("library", "extract"), ("extract", "sample"), ("sample", "individual"))


def flat_of_runs(
    tables: Mapping[str, DataFrame],
    runs: DataFrame,
    by: str = "full",
    analysis_type: str | None = None,
    keep: Callable[[DataFrame], DataFrame] = lambda flat: flat,
) -> DataFrame:
    """The flat lab rows of all individuals that the runs (``run_id``) may touch, made once and written down.

    Which individuals these are is looked up first, from the runs' sequencings upwards through narrow columns. The ten-table join then
    begins with these individuals only, so the big tables below are read once and give few rows. Individuals whose
    analyses are all deleted may be among them; :func:`expand_cohort` and :func:`expand_cohorts` work on the
    result as on all flat rows. ``keep`` drops rows that must not be written down.
    """
    keys = tables["sequencing"].join(runs.select("run_id").distinct(), "run_id", "left_semi").select("capture")
    for name, above in _ANCESTORS:
        keys = tables[name].join(keys.select(F.col(name).alias("id")), "id", "left_semi").select(above)
    people = tables["individual"]
    touched = people.join(keys.select(F.col("individual").alias("id")), "id", "left_semi").select(FULL, MAIN)
    touched = written(touched, "touched")
    if by == "full":
        found = broadcast_if_small(cohort_ids(touched))
        people = people.join(found, FULL, "left_semi")
    else:
        target = ids.canonical_id(F.col(FULL), F.col(MAIN), null_main_is_missing=True)
        found = broadcast_if_small(touched.select(target.alias("_target")).distinct())
        people = people.withColumn("_target", target).join(found, "_target", "left_semi").drop("_target")
    return written(keep(lims.lims_flat({**tables, "individual": people}, analysis_type)), "flat")


def expand_cohort(flat: DataFrame, run_id: str, by: str = "full") -> DataFrame:
    """Every row, of any run, of every individual that ``run_id`` touches.

    ``by="full"`` matches on the full ID only; ``by="canonical"`` also pulls in other individuals
    that share a main ID with a touched one.
    """
    if by == "full":
        return flat.join(cohort_ids(lims.of_run(flat, run_id)), FULL, "left_semi")
    if by != "canonical":
        raise ValueError(f"by must be 'full' or 'canonical', not {by!r}")
    target = ids.canonical_id(F.col(FULL), F.col(MAIN), null_main_is_missing=True)
    keyed = flat.withColumn("_target", target)
    touched = lims.of_run(keyed, run_id).select("_target").distinct()
    return keyed.join(touched, "_target", "left_semi").drop("_target")


def expand_cohorts(
    flat: DataFrame,
    runs: DataFrame,
    keys: Sequence[str] = (),
    policy: str = "union",
    settled: bool = False,
) -> DataFrame:
    """Cohort expansion for many runs at once, linear in the rows.

    ``runs`` holds one ``run_id`` per row; ``keys`` (such as the analysis type) keep cohorts apart. If
    ``runs`` has key columns too, a run counts for those keys only.
    ``union`` returns the rows of an individual that any of the runs touches. ``last_run`` returns
    for each target individual what its last run alone would, as when runs are handled one after
    another and each rewrites the sheet. Rows are matched against distinct IDs only, so no row is
    multiplied by the number of runs. ``last_run`` looks at the rows from three sides, so the joins that
    make them run once and their result is written to the shared folder, unless they are ``settled`` there already.
    """
    if policy == "last_run" and not settled:
        flat = written(flat, "flat")
    by = ["run_id", *[key for key in keys if key in runs.columns]]
    of_runs = flat.join(runs.select(*by).distinct(), by, "left_semi")
    if policy == "union":
        return flat.join(cohort_ids(of_runs, keys), [*keys, FULL], "left_semi")
    if policy != "last_run":
        raise ValueError(f"policy must be 'union' or 'last_run', not {policy!r}")
    touched = cohort_ids(of_runs, [*keys, "run_id"])
    target = ids.canonical_id(F.col(FULL), F.col(MAIN))
    keyed = flat.withColumn("_target", target)
    # A row without a result directory never reaches a sheet, so it cannot make a run the last.
    members = (
        keyed.filter(F.col("result_directory").isNotNull()).select(*keys, "_target", FULL).distinct()
    )
    last = (
        members.join(touched, [*keys, FULL])
        .groupBy(*keys, "_target")
        .agg(F.max("run_id").alias("_last"))
    )
    latest = touched.withColumnRenamed("run_id", "_last")
    return (
        keyed.join(last, [*keys, "_target"])
        .join(latest, [*keys, "_last", FULL], "left_semi")
        .select(*flat.columns)
    )
