"""Processed individuals, counts per analysis type, and lists of what may be cleared."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.functions import ids


def processed_individuals(files: DataFrame, part: int = -2) -> DataFrame:
    """Analysis type and individual of each report folder, from rows ``(analysis_type, path)``."""
    return files.select("analysis_type", ids.path_part(F.col("path"), part).alias("individual"))


def unique_individuals(processed: DataFrame) -> DataFrame:
    """Sorted list of the individuals that any analysis type has processed."""
    return processed.select("individual").distinct().orderBy("individual")


def processed_counts(files: DataFrame, types: DataFrame) -> DataFrame:
    """Number of reports per analysis type; a type without one is listed with zero."""
    counted = files.groupBy("analysis_type").agg(F.count("path").alias("n"))
    return types.join(counted, "analysis_type", "left").select(
        "analysis_type", F.coalesce("n", F.lit(0)).alias("n_processed")
    )


def whole_word(column: Column, words: tuple[str, ...]) -> Column:
    """True if any of the words occurs with no word character next to it."""
    either = "|".join(re.escape(word) for word in words)
    return column.rlike(rf"(?<!\w)({either})(?!\w)")


def purge_candidates(files: DataFrame, keep: tuple[str, ...] = V.KEPT_DIRECTORIES) -> DataFrame:
    """Result directories that do not match a protected name; ``files`` has ``path``."""
    return files.filter(~whole_word(F.col("path"), keep))


def purge_plan(
    listed: DataFrame,
    files: DataFrame,
    types: tuple[str, ...] = V.ANALYSIS_TYPES,
    keep: tuple[str, ...] = V.KEPT_DIRECTORIES,
) -> DataFrame:
    """Directories to clear for the listed individuals; a list only, nothing is deleted.

    ``files`` has ``individual``, ``analysis_type`` and ``path``. Only what exists is looked at.
    """
    wanted = listed.select(F.col("id").alias("individual"))
    of_types = files.filter(F.col("analysis_type").isin(*types))
    return purge_candidates(of_types, keep).join(wanted, "individual", "left_semi")


def work_directories(
    listed: DataFrame,
    files: DataFrame,
    types: tuple[str, ...] = V.ANALYSIS_TYPES,
    names: tuple[str, ...] = V.WORK_DIRECTORIES,
) -> DataFrame:
    """Cache directories of the listed individuals, to be cleared."""
    wanted = listed.select(F.col("id").alias("individual"))
    caches = files.filter(
        F.col("analysis_type").isin(*types) & ids.path_part(F.col("path"), -1).isin(*names)
    )
    return caches.join(wanted, "individual", "left_semi")
