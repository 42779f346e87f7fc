"""Run sheets: one block of rows per individual and analysis type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import ids
from cohortflow.operators import lims
from cohortflow.operators.numbering import GROUP_LIMIT, number_distinct, number_rows

# Columns that identify a run sheet row; copies made by the analysis table collapse on them.
SOURCE_COLUMNS = (
    "full_individual_id",
    "main_individual_id",
    "organism",
    "full_library_id",
    "protocol",
    "result_directory",
    "sequencing_id",
    "full_sequencing_id",
    "single_stranded",
)
LANE_ORDER = (
    "full_individual_id",
    "full_library_id",
    "sequencing_id",
    "full_sequencing_id",
    "result_directory",
    "protocol",
    "organism",
    "single_stranded",
    "main_individual_id",
)


def with_lane(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = LANE_ORDER,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Add ``Lane``, restarting at 1 for each key, in a total order.

    The joins that make the rows run once: their result is written to the shared folder first.
    """
    return number_rows(df, keys, order, "Lane", settle=True, limit=limit)


def build_run_sheet(
    rows: DataFrame,
    protocols: DataFrame,
    keys: Sequence[str] = ("analysis_type",),
    rebase: tuple[str, str] | None = None,
    rename: bool = False,
    null_main_is_missing: bool = False,
    limit: int = GROUP_LIMIT,
    largest: int | None = None,
) -> DataFrame:
    """Shape cohort rows into run sheet rows, keyed by ``keys``, site and target individual.

    Lanes are counted after rows without a result directory are gone. ``rebase`` is an old and a
    new storage prefix. ``rename`` replaces dots in library IDs. A NULL target individual stays
    in the result; ``reject_unnamed`` separates it before writing.

    ``largest`` is a number of rows that no key and target individual exceeds, copies included, where the caller knows one
    and ``rows`` are cheap to make. Up to ``limit``, nothing is written down before the lanes are counted.
    """
    with_directory = rows.filter(F.col("result_directory").isNotNull()).withColumn(
        "target_ind",
        ids.canonical_id(
            F.col("full_individual_id"), F.col("main_individual_id"), null_main_is_missing
        ),
    )
    sources = with_directory.select(*keys, "target_ind", *SOURCE_COLUMNS)
    if largest is not None and largest <= limit:
        numbered = number_distinct(sources, [*keys, "target_ind"], LANE_ORDER, "Lane")
    else:
        numbered = with_lane(sources.distinct(), [*keys, "target_ind"], limit=limit)
    specified = lims.infer_library_specs(numbered, protocols)

    directory = F.col("result_directory")
    if rebase is not None:
        directory = ids.rebase_path(directory, *rebase)
    stranded = F.col("single_stranded")
    library = ids.single_stranded_library(F.col("full_library_id"), stranded)
    sheet = specified.select(
        *keys,
        ids.site_id(F.col("target_ind")).alias("site_id"),
        "target_ind",
        ids.single_stranded_name(F.col("target_ind"), stranded).alias("Sample_Name"),
        library.alias("Library_ID"),
        "Lane",
        F.lit(V.COLOUR_CHEMISTRY).alias("Colour_Chemistry"),
        F.lit(V.SEQ_TYPE).alias("SeqType"),
        F.col("organism").alias("Organism"),
        "Strandedness",
        "UDG_Treatment",
        F.lit(None).cast("string").alias("R1"),
        F.lit(None).cast("string").alias("R2"),
        ids.read_file_path(directory, F.col("full_sequencing_id")).alias("BAM"),
    )
    return rename_dots(sheet) if rename else sheet


def rename_dots(sheet: DataFrame) -> DataFrame:
    """Dots of library IDs as underscores; every key column stays."""
    return sheet.withColumn("Library_ID", ids.dots_to_underscores(F.col("Library_ID")))


def strandedness_conflicts(sheet: DataFrame) -> DataFrame:
    """Rows whose name suffix (sequencing flag) and strandedness (protocol) disagree."""
    named_single = F.col("Sample_Name").endswith(ids.SINGLE_STRANDED_SUFFIX)
    return sheet.filter(named_single != (F.col("Strandedness") == "single"))


def whitelisted(sheet: DataFrame, listed: DataFrame, on: str = "target_ind") -> DataFrame:
    """Rows of listed individuals; ``listed`` holds one ``id`` per row."""
    return sheet.join(listed.select(F.col("id").alias(on)), on, "left_semi")


def matching(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on key columns; missing and empty keys, which folder names cannot tell apart, match."""

    def key(side: DataFrame, name: str):
        return F.coalesce(side[name], F.lit(""))

    condition = [key(left, name) == key(right, name) for name in keys]
    return left.join(right, condition, how)


def reject_unnamed(sheet: DataFrame, on: str = "target_ind") -> tuple[DataFrame, DataFrame]:
    """Rows with a target individual, and the rows that have none."""
    return sheet.filter(F.col(on).isNotNull()), sheet.filter(F.col(on).isNull())


def prepare_report(sheet: DataFrame, keys: Sequence[str] = ("analysis_type",)) -> DataFrame:
    """Number of individuals with a sheet per analysis type; a NULL individual counts as one."""
    individuals = sheet.select(*keys, "target_ind").distinct()
    return individuals.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_individuals"))


def changed_individuals(
    new: DataFrame, old: DataFrame, keys: Sequence[str] = V.SHEET_KEYS
) -> DataFrame:
    """Keys of the sheets whose rows differ from what was written before, compared exactly.

    Only keys present in ``new`` are returned: a sheet that is not prepared again is not touched.
    """
    columns = new.columns
    # Copies are counted up in the new rows and down in the old ones; what is left differs.
    signed = new.withColumn("_n", F.lit(1)).unionByName(
        old.select(*columns).withColumn("_n", F.lit(-1))
    )
    differing = (
        signed.groupBy(*columns)
        .agg(F.sum("_n").alias("_n"))
        .filter(F.col("_n") != 0)
        .select(*keys)
        .distinct()
    )
    return differing.join(new.select(*keys).distinct(), list(keys), "left_semi")


def sheet_digests(sheet: DataFrame, keys: Sequence[str] = V.SHEET_KEYS) -> DataFrame:
    """``keys, digest``: one digest of all rows of each individual, whatever their order."""
    rest = [c for c in sheet.columns if c not in keys]
    # Rows become digests before they are grouped, so that grouping sorts no whole rows.
    # Missing values and empty text differ, and so do values that meet at other borders.
    row = F.md5(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in rest]), {"ignoreNullFields": "false"}))
    rows = F.sort_array(F.collect_list("_row"))
    return sheet.select(*keys, row.alias("_row")).groupBy(*keys).agg(F.md5(F.array_join(rows, ",")).alias("digest"))
