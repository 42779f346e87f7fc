"""Sample metadata: overwrite joins, lab columns, and the sample index that follows them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.functions import ids


def overwrite_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    right_on: str | None = None,
    keep_left_when_null: bool = False,
) -> DataFrame:
    """Left join in which columns of the same name take the value of the right side.

    That includes NULL, also for rows without a match, unless ``keep_left_when_null``. Columns only
    the left side has come first, then the right side's in its own order.
    """
    right_key = right_on or on
    shared = [c for c in right.columns if c in left.columns and c not in (on, right_key)]
    added = [c for c in right.columns if c not in (on, right_key)]
    renamed = right.select(
        F.col(right_key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in added]
    )

    def fresh(column: str):
        value = F.col(f"_new_{column}")
        if keep_left_when_null and column in shared:
            value = F.coalesce(value, F.col(column))
        return value.alias(column)

    kept = [c for c in left.columns if c not in shared]
    joined = left.join(renamed, F.col(on) == F.col("_key"), "left")
    return joined.select(*kept, *[fresh(c) for c in added])


def attach_lims(samples: DataFrame, lims: DataFrame, on: str = "individual") -> DataFrame:
    """Lab columns for each sample, by individual; both sides keep their unmatched rows.

    The individual is used for matching only and is dropped. The two halves of the full join are
    made apart, because a left join can be split where one individual has very many samples.
    """
    matched = samples.join(lims, on, "left")
    without_sample = lims.join(samples.select(on).distinct(), on, "left_anti")
    return matched.unionByName(without_sample, allowMissingColumns=True).drop(on)


def with_individual(samples: DataFrame, key: str) -> DataFrame:
    """Add the individual a sample ID belongs to."""
    return samples.withColumn("individual", ids.individual_id(F.col(key)))


def one_per_sample(results: DataFrame) -> DataFrame:
    """One row per ``Sample_Name``: that of most libraries, of equal ones the largest row.

    A sample whose libraries differ in strandedness has a row for each build; the metadata has room for one.
    """
    rest = [name for name in results.columns if name != "Sample_Name"]
    if not rest:
        return results.distinct()
    first = [name for name in ("Nr_Libraries",) if name in rest]
    ordered = [*first, *[name for name in rest if name not in first]]
    chosen = results.groupBy("Sample_Name").agg(F.max(F.struct(*ordered)).alias("_one"))
    return chosen.select(
        *[F.col("_one")[name].alias(name) if name in rest else F.col(name) for name in results.columns]
    )


def update_metadata(
    metadata: DataFrame,
    results: DataFrame,
    lims: DataFrame | None,
    key: str,
    keep_left_when_null: bool = False,
) -> DataFrame:
    """Metadata with fresh result columns, and lab columns where given.

    ``results`` is keyed by ``Sample_Name``, ``lims`` by ``individual``; ``key`` names the sample
    column of the metadata, which stays unique: see :func:`one_per_sample`.
    """
    updates = one_per_sample(results)
    if lims is not None:
        # Only lab rows with a sample can match here, so the left half of attach_lims is enough.
        samples = with_individual(metadata.select(F.col(key).alias("_sample")), "_sample")
        lab = samples.join(lims, "individual", "left").drop("individual")
        updates = updates.join(lab, F.col("Sample_Name") == F.col("_sample"), "left").drop("_sample")
    return overwrite_join(metadata, updates, key, "Sample_Name", keep_left_when_null)


def sync_index(index: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Sample index with sex and population taken from the metadata (its first group name)."""
    source = metadata.select(
        F.col(key).alias("Sample_Name"),
        "Genetic_Sex",
        ids.first_group(F.col("Group_Name")).alias("Population"),
    )
    return overwrite_join(index, source, "Sample_Name")


def concat_indexes(double: DataFrame, single: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Double-stranded samples first, then single-stranded ones; ``pos`` is the file order.

    Both inputs carry ``pos`` counted from 0. The shift of the second is one aggregated number, or
    with ``keys`` (such as the package) one for each of many indexes.
    """
    if keys:
        shifts = double.groupBy(*keys).agg(F.count(F.lit(1)).alias("_shift"))
        shifted = single.join(shifts, list(keys), "left").withColumn(
            "pos", F.col("pos") + F.coalesce("_shift", F.lit(0))
        )
        return double.unionByName(shifted.select(*double.columns))
    shift = double.agg(F.count(F.lit(1))).scalar()
    moved = single.withColumn("pos", F.col("pos") + shift)
    return double.unionByName(moved.select(*double.columns))


def regroup(table: DataFrame, sample: str, group: str) -> DataFrame:
    """Release tables take the group label from the sample ID."""
    return table.withColumn(group, ids.group_from_id(F.col(sample)))
