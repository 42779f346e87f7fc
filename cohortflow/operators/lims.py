"""Lab database tables: the flat result, readable IDs, consent and exclusion, library specs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import fixed_values as V
from cohortflow.functions import values
from cohortflow.session import broadcast_if_small, fixed_table


# Columns of the flat result that are flags, however the database spells them.
FLAGS = (
    T.StructType()
    .add("ethically_culturally_sensitive", T.BooleanType())
    .add("exclude", T.BooleanType())
)


def pipeline_names(spark: SparkSession) -> DataFrame:
    """Fixed lookup ``(analysis_type, analysis_id)``: 16 rows."""
    rows = [(code, name) for code, names in V.PIPELINE_NAMES.items() for name in names]
    return fixed_table(spark, rows, "analysis_type string, analysis_id string")


def not_deleted(analyses: DataFrame) -> DataFrame:
    return analyses.filter(F.col("deleted") == "false")


def of_analysis(df: DataFrame, analysis_type: str) -> DataFrame:
    """Rows of one analysis type, by both spellings of its pipeline name."""
    check_type(analysis_type)
    return df.filter(F.col("analysis_id").isin(*V.PIPELINE_NAMES[analysis_type]))


def of_known_pipelines(df: DataFrame) -> DataFrame:
    """Rows that ``with_analysis_type`` keeps, by a filter that needs no join."""
    return df.filter(F.col("analysis_id").isin(*[name for names in V.PIPELINE_NAMES.values() for name in names]))


def with_analysis_type(df: DataFrame) -> DataFrame:
    """Add the analysis type of each row's pipeline; rows of foreign pipelines go.

    The lookup has 16 fixed rows, so broadcasting it is safe at any data size.
    """
    return df.join(F.broadcast(pipeline_names(df.sparkSession)), "analysis_id")


def check_type(analysis_type: str) -> None:
    """Fail before a job is built if the analysis type is not known."""
    if analysis_type not in V.ANALYSIS_TYPES:
        accepted = ", ".join(V.ANALYSIS_TYPES)
        raise ValueError(f"invalid analysis type {analysis_type!r}; accepted: {accepted}")


def invalid_types(df: DataFrame, column: str = "analysis_type") -> DataFrame:
    """Rows whose analysis type is missing or not known."""
    known = F.col(column).isin(*V.ANALYSIS_TYPES)
    return df.filter(F.col(column).isNull() | ~known)


def lims_flat(tables: Mapping[str, DataFrame], analysis_type: str | None = None) -> DataFrame:
    """Inner join of the ten lab tables, one row per undeleted analysis.

    ``site`` and ``batch`` add no column but still demand a match. The tree is joined in two
    halves, so that the big analysis side is not shuffled once per ancestor: ancestors of a
    library first, then sequencings with their library, then analyses.
    """
    sites = tables["site"].select(F.col("id").alias("site"))
    batches = tables["batch"].select(F.col("id").alias("batch"))
    individuals = (
        tables["individual"]
        .join(sites, "site", "left_semi")
        .select(
            F.col("id").alias("individual"),
            "full_individual_id",
            "main_individual_id",
            "organism",
        )
    )
    samples = (
        tables["sample"]
        .join(individuals, "individual")
        .withColumnRenamed("id", "sample")
        .drop("individual")
    )
    extracts = (
        tables["extract"].join(samples, "sample").withColumnRenamed("id", "extract").drop("sample")
    )
    libraries = (
        tables["library"]
        .join(extracts, "extract")
        .withColumnRenamed("id", "library")
        .drop("extract")
    )
    captures = (
        tables["capture"]
        .join(libraries, "library")
        .withColumnRenamed("id", "capture")
        .drop("library")
    )
    sequencings = (
        tables["sequencing"]
        .join(batches, "batch", "left_semi")
        .join(captures, "capture")
        .withColumnRenamed("id", "sequencing")
        .drop("capture", "batch")
    )
    raw_data = (
        tables["raw_data"]
        .join(sequencings, "sequencing")
        .withColumnRenamed("id", "raw_data")
        .drop("sequencing")
    )
    analyses = not_deleted(tables["analysis"])
    if analysis_type is not None:
        analyses = of_analysis(analyses, analysis_type)
    return analyses.join(raw_data, "raw_data").select(
        "full_individual_id",
        "main_individual_id",
        "organism",
        "ethically_culturally_sensitive",
        "full_library_id",
        "protocol",
        "analysis_id",
        "result_directory",
        "sequencing_id",
        "run_id",
        "full_sequencing_id",
        "single_stranded",
        "exclude",
    )


def resolve_ids(df: DataFrame, lookups: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Replace foreign-key numbers by readable values.

    ``lookups`` maps a column of ``df`` to ``(table, key, value)``. Unmatched numbers become NULL.
    """
    resolved = df
    for column, (table, key, value) in lookups.items():
        names = table.select(F.col(key).alias(column), F.col(value).alias("_value"))
        resolved = resolved.join(broadcast_if_small(names), column, "left").drop(column)
        resolved = resolved.withColumnRenamed("_value", column)
    return resolved.select(*df.columns)


def consented(df: DataFrame, column: str = "ethically_culturally_sensitive") -> DataFrame:
    """Rows explicitly marked as not sensitive; unknown consent is dropped."""
    return df.filter(~F.col(column))


def not_excluded(df: DataFrame, column: str = "exclude") -> DataFrame:
    """Rows not marked for exclusion; a missing mark counts as "no"."""
    return df.filter(~F.coalesce(F.col(column), F.lit(False)))


def of_run(df: DataFrame, run_id: str, column: str = "run_id") -> DataFrame:
    return df.filter(F.col(column) == run_id)


def infer_library_specs(
    df: DataFrame, protocols: DataFrame, protocol: str = "protocol"
) -> DataFrame:
    """Add ``Strandedness`` and ``UDG_Treatment`` from the protocol lookup, ``Unknown`` if absent."""
    lookup = protocols.select(
        F.col("protocol").alias(protocol),
        F.col("strandedness").alias("_strand"),
        F.col("udg").alias("_udg"),
    )
    strand = F.coalesce("_strand", F.lit("Unknown"))
    udg = F.coalesce("_udg", F.lit("Unknown"))
    return (
        df.join(broadcast_if_small(lookup), protocol, "left")
        .withColumn("Strandedness", strand)
        .withColumn("UDG_Treatment", values.udg_fallback(strand, udg))
        .drop("_strand", "_udg")
    )
