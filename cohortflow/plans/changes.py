"""Plans that are kept up to date from what changed in a store of files since the last pass.

The listing of the last pass and the plan made from it are a table with numbered commits. A new pass compares listings, makes the plan
anew for the keys whose files changed, and keeps the rest. So planning reads no rows of files that nobody touched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.session import written
from cohortflow.sinks import commits
from cohortflow.sources.results import path_exists

# What tells that a file is not the one it was.
STATE = ("modificationTime", "length")


def file_changes(before: DataFrame, now: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, path, change`` between two listings: ``added``, ``removed`` or ``changed`` files.

    A file whose keys are others than before is removed under the old ones and added under the new ones.
    """
    named = [*keys, "path"]
    old = before.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_{k}") for k in keys], *named, F.struct(*STATE).alias("_old"))
    new = now.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_{k}") for k in keys], *named, F.struct(*STATE).alias("_new"))
    either = [F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in named]
    same = [F.col(f"o._{k}") == F.col(f"n._{k}") for k in keys] + [F.col("o.path") == F.col("n.path")]
    change = (
        F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed")
    )
    joined = old.alias("o").join(new.alias("n"), same, "full_outer")
    return joined.select(*either, change.alias("change")).where("change is not null")


def _of_keys(rows: DataFrame, keys: Sequence[str], some: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on keys that may be missing."""
    match = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return rows.alias("r").join(some.alias("s"), match, how)


def refresh(
    spark: SparkSession,
    store: str,
    listing: DataFrame,
    keys: Sequence[str],
    plan: Callable[[DataFrame], DataFrame],
    schema: str,
) -> DataFrame:
    """The plan for the files as listed, and the store brought up to it.

    ``listing`` has the ``keys``, ``path``, ``modificationTime`` and ``length``, and what ``plan`` needs. ``plan`` makes rows of
    ``schema``, which hold the keys, from the files of some keys; those of one key must not depend on others.
    If nothing changed, neither ``plan`` nor the files' rows are looked at again. Where two passes meet, the later one starts over
    from what the first has stored.
    """
    if not path_exists(spark, f"{store}/commits"):
        commits.create(spark, store)
    listed = written(listing, "listing")
    files = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in listing.schema)

    def changed(base: int) -> DataFrame:
        found = file_changes(commits.read(spark, store, "files", files, base), listed, keys)
        return written(found.select(*keys).distinct(), "changed")

    start = commits.latest(spark, store)
    touched = changed(start)
    if not touched.isEmpty():

        def rows(base: int) -> dict[str, DataFrame]:
            some = touched if base == start else changed(base)
            fresh = plan(_of_keys(listed, keys, some, "left_semi"))
            kept = _of_keys(commits.read(spark, store, "plan", schema, base), keys, some, "left_anti")
            return {"files": listed, "plan": kept.unionByName(fresh)}

        commits.add(spark, store, rows, base=start, whole=True)
    return commits.read(spark, store, "plan", schema)
