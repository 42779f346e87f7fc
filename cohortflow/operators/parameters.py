"""Effective read-processing parameters: profiles laid over each other."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow import fixed_values as V
from cohortflow.session import fixed_table


def default_profiles(
    spark: SparkSession,
    paths: Mapping[str, str] | None = None,
    type_paths: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """The parameter rows ``(profile, key, value)`` of the base profiles and of every analysis type.

    Where files lie differs from site to site: ``paths`` gives them by key (``V.SITE_PATHS``), and
    ``type_paths`` those that single analysis types use instead (``V.TYPE_SITE_PATHS``).
    """
    base, site = V.BASE_PROFILES
    rows = [(base, key, value) for key, value in V.BASE_PARAMETERS.items()]
    for key, value in (paths or {}).items():
        if key not in V.SITE_PATHS:
            raise ValueError(f"unknown path {key!r}; must be one of {', '.join(V.SITE_PATHS)}")
        rows.append((site, key, value))
    for code in V.ANALYSIS_TYPES:
        absent = V.TYPE_WITHOUT.get(code, ())
        settings = {k: v for k, v in V.SHARED_PARAMETERS.items() if k not in absent}
        settings.update(V.TYPE_PARAMETERS.get(code, {}))
        settings.update((type_paths or {}).get(code, {}))
        rows.extend((code, key, value) for key, value in settings.items())
    return fixed_table(spark, rows, "profile string, key string, value string")


def profile_order(spark: SparkSession, base: tuple[str, ...] = V.BASE_PROFILES) -> DataFrame:
    """Profiles used for each analysis type and their precedence; the type's own comes last."""
    rows = [
        (code, profile, place)
        for code in V.ANALYSIS_TYPES
        for place, profile in enumerate((*base, code))
    ]
    return fixed_table(spark, rows, "analysis_type string, profile string, precedence int")


def resolve_params(params: DataFrame, order: DataFrame) -> DataFrame:
    """Effective ``(analysis_type, key, value)``: the profile of highest precedence wins.

    A later explicit NULL overrides an earlier value, and stays in the result as NULL.
    """
    layered = params.join(order, "profile")
    winner = F.max(F.struct("precedence", "value"))
    return (
        layered.groupBy("analysis_type", "key")
        .agg(winner.alias("_w"))
        .select("analysis_type", "key", F.col("_w.value").alias("value"))
    )


def clip_lengths(params: DataFrame) -> DataFrame:
    """Bases to clip ``(analysis_type, strandedness, udg, clip_left, clip_right)``."""
    key = F.col("key")
    pattern = r"^bamutils_clip_(\w+)_stranded_(\w+)_udg_(left|right)$"
    side = F.regexp_extract(key, pattern, 3)
    bases = F.col("value").cast("int")
    return (
        params.filter(key.rlike(pattern))
        .groupBy(
            "analysis_type",
            F.regexp_extract(key, pattern, 1).alias("strandedness"),
            F.regexp_extract(key, pattern, 2).alias("udg"),
        )
        .agg(
            F.max(F.when(side == "left", bases)).alias("clip_left"),
            F.max(F.when(side == "right", bases)).alias("clip_right"),
        )
    )
