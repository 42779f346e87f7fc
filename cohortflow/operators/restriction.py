"""Ethically restricted individuals: leave them out of any table, and report where they appear."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import ids


def restricted_individuals(sensitive: DataFrame, column: str = "id") -> DataFrame:
    """Distinct individuals of a list of sensitive sequencing IDs, by the rule of :func:`scrub`."""
    return sensitive.select(ids.individual_id(F.col(column)).alias("individual")).distinct()


def scrub(df: DataFrame, sensitive: DataFrame, on: str, column: str = "id") -> DataFrame:
    """Rows that belong to no restricted individual; rows without an individual stay.

    ``on`` is an individual or sample ID: the part before the first dot, without the
    single-stranded suffix, is what counts.
    """
    restricted = restricted_individuals(sensitive, column)
    keyed = df.withColumn("_individual", ids.individual_id(F.col(on)))
    banned = restricted.select(F.col("individual").alias("_individual"))
    return keyed.join(banned, "_individual", "left_anti").select(*df.columns)


def scrub_audit(
    sensitive: DataFrame,
    files: DataFrame,
    types: tuple[str, ...] = V.ANALYSIS_TYPES,
    column: str = "id",
) -> DataFrame:
    """Restricted individual, analysis type and stage wherever data of one really exists.

    ``files`` has ``individual``, ``analysis_type`` and ``stage``. Starting from what exists gives
    the same rows as trying each individual with each type and stage, without the combinations.
    """
    restricted = restricted_individuals(sensitive, column).withColumnRenamed("individual", "_individual")
    return (
        files.filter(F.col("analysis_type").isin(*types))
        .select("individual", "analysis_type", "stage")
        .distinct()
        .withColumn("_individual", ids.individual_id(F.col("individual")))
        .join(restricted, "_individual", "left_semi")
        .select("individual", "analysis_type", "stage")
    )
