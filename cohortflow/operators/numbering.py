"""Row numbers and first-n selections that never gather a hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators.scans import with_offsets
from cohortflow.session import broadcast_if_small, written

# Largest group a single task numbers by itself, and rows of a slice where groups are larger.
GROUP_LIMIT = 2_000_000
SLICE_ROWS = 2_000_000
# Most rows that are numbered in one task where there are no keys.
SINGLE_TASK_ROWS = 20_000
# Rows that a task sorts or joins where their number sets the number of tasks.
TASK_ROWS = 1_000_000

# Bins by which groups are counted where a bound of their sizes is enough.
SIZE_BINS = 65_536

# Bits of monotonically_increasing_id() that hold the row position inside a partition.
_POSITION_BITS = 33


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be NULL; key columns come from the left."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys]
    return left.join(renamed, condition).drop(*[f"_right_{key}" for key in keys])


def group_sizes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the biggest group and of all groups.

    Counts are combined before the shuffle, and one row comes back.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    largest, total = counts.agg(F.max("rows"), F.sum("rows")).first()
    return largest or 0, total or 0


def group_bound(df: DataFrame, keys: Sequence[str]) -> int:
    """A number of rows that no group exceeds: those of the fullest bin, where each group lies in one bin.

    Bins are few and numbered, so this is cheaper than ``group_sizes`` where there are many small groups.
    """
    bins = F.pmod(F.xxhash64(*keys), F.lit(SIZE_BINS)).alias("_bin")
    return df.groupBy(bins).agg(F.count(F.lit(1)).alias("rows")).agg(F.max("rows")).first()[0] or 0


def spread(df: DataFrame, rows: int, keys: Sequence[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """The rows dealt by ``keys`` over so many tasks that each gets about ``task_rows`` of the ``rows``."""
    shuffle_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(shuffle_partitions, -(-rows // task_rows)), *keys)


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    settle: bool = False,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Number the rows of each group 1..n in ``order``; no keys means one group for all rows.

    Rows must differ in keys and order (remove copies first). Group sizes are counted up front:
    small groups use a plain window, a group beyond ``limit`` (``SINGLE_TASK_ROWS`` if there are no keys) is
    sorted across the cluster instead.
    The rows are read more than once, so ``settle`` writes down those that are costly to make.
    """
    rows = written(df) if settle else df
    largest, total = group_sizes(rows, keys)
    if largest <= (limit if keys else min(limit, SINGLE_TASK_ROWS)):
        window = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(window).cast("long"))
    shuffle_partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(shuffle_partitions, -(-total // SLICE_ROWS))
    return _number_sorted(rows, keys, order, name, slices)


def number_distinct(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Distinct rows, those of each group numbered 1..n in ``order``; for groups that one task can hold with their copies.

    ``keys`` and ``order`` are all columns, so copies sort next to each other: the sort that numbers the rows also finds them.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn(name, F.dense_rank().over(window).cast("long"))
    before = F.lag(name).over(window)
    return numbered.withColumn("_before", before).filter(F.col("_before").isNull() | (F.col("_before") < F.col(name))).drop("_before")


def _number_sorted(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, slices: int
) -> DataFrame:
    """Number rows of any group size: a range sort, slice positions, and one offset per slice.

    The sort puts the rows of a group next to each other, over as many slices as they need. The
    slice layout comes from sampling, so it is written down before it is used twice.
    """
    columns = [*keys, *order]
    ranged = df.repartitionByRange(slices, *columns).sortWithinPartitions(*columns)
    placed = F.monotonically_increasing_id()
    laid_out = written(
        ranged.withColumn("_placed", placed)
        .withColumn("_slice", F.shiftright("_placed", _POSITION_BITS))
        .withColumn("_position", F.col("_placed").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop("_placed")
    )
    # One row per slice: a table of ``slices`` rows at most.
    sizes = laid_out.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = with_offsets(sizes, [], "_slice", {"_offset": "_rows"}).drop("_rows")
    numbered = laid_out.join(broadcast_if_small(offsets), "_slice").withColumn(
        name, F.col("_position") + F.col("_offset") + 1
    )
    if not keys:
        return numbered.select(*df.columns, name)
    # First number of each group: per slice, then over the few slices a group spans. Joining on
    # the slice as well keeps the rows of a hot group apart.
    per_slice = numbered.groupBy("_slice", *keys).agg(F.min(name).alias("_first"))
    starts = per_slice.select(
        F.col("_slice").alias("_s"),
        *[F.col(key).alias(f"_k_{key}") for key in keys],
        F.min("_first").over(Window.partitionBy(*keys)).alias("_start"),
    )
    condition = F.col("_slice") == F.col("_s")
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return numbered.join(starts, condition).select(
        *df.columns, (F.col(name) - F.col("_start") + 1).alias(name)
    )


def first_by_digest(
    df: DataFrame, keys: Sequence[str], digest: Column, n: int, bucket_rows: int = 50_000
) -> DataFrame:
    """The ``n`` rows of each group with the smallest digests: an exact, repeatable sample.

    Digests are hex text spread evenly, unique within a group; NULL keys make a group. Each group
    is cut into buckets of at most about ``bucket_rows`` by as many leading digits as its size
    calls for. A histogram of the buckets shows the one in which row ``n`` lies; rows beyond it
    are dropped where they are read, and ranks are counted within buckets only.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    digits = F.ceil(F.log(F.col("_size") / bucket_rows) / F.log(F.lit(16.0)))
    sized = written(
        counts.select(*keys, F.greatest(digits, F.lit(0)).cast("int").alias("_digits"))
    )

    def stamped(rows: DataFrame, lookup: DataFrame) -> DataFrame:
        return (
            null_safe_join(rows, broadcast_if_small(lookup), keys)
            .withColumn("_digest", digest)
            .withColumn("_bucket", F.substr("_digest", F.lit(1), F.col("_digits")))
        )

    histogram = stamped(df, sized).groupBy(*keys, "_bucket").agg(
        F.max("_digits").alias("_digits"), F.count(F.lit(1)).alias("_rows")
    )
    running = Window.partitionBy(*keys).orderBy("_bucket")
    below = F.sum("_rows").over(running) - F.col("_rows")
    kept = written(histogram.withColumn("_below", below).filter(F.col("_below") < n))
    last = kept.groupBy(*keys).agg(
        F.max("_digits").alias("_digits"), F.max("_bucket").alias("_last")
    )
    rank = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy("_digest"))
    within = stamped(df, last).filter(F.col("_bucket") <= F.col("_last"))
    return (
        null_safe_join(within, kept.select(*keys, "_bucket", "_below"), [*keys, "_bucket"])
        .withColumn("_rank", rank)
        .filter(F.col("_rank") + F.col("_below") <= n)
        .select(*df.columns)
    )
