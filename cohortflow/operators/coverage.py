"""Depth and breadth of target intervals, without pairing reads and intervals.

Reads that overlap ``[s, e)`` are those that start before ``e`` less those that end at or before
``s``. Covered positions and covered bases are differences of running totals in the same way. So
an interval needs the running totals at its two ends, and nothing grows with the number of
overlaps. Totals run inside bins of the coordinate axis, with one row per bin to link them
(:func:`cohortflow.operators.scans.with_offsets`): no task sees more than one bin of distinct positions, however many reads pile up there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.operators.scans import with_offsets
from cohortflow.session import written

# Positions per bin: bounds the rows one window group can hold.
BIN_WIDTH = 65_536


def interval_coverage(
    reads: DataFrame,
    intervals: DataFrame,
    by: Sequence[str] = (),
    bin_width: int = BIN_WIDTH,
) -> DataFrame:
    """Add ``n_reads, covered, bases, length, breadth, mean_depth`` to each interval.

    Both tables have ``chrom``, ``start`` and ``end`` (0-based, half open) and the ``by`` columns,
    which keep samples apart. Intervals no read touches stay, with zeros.
    """
    axis = [*by, "chrom"]
    bins = [*axis, "_bin"]
    points = _points(reads, intervals, axis).withColumn("_bin", F.floor(F.col("_pos") / bin_width).cast("long"))

    # Inside a bin all is counted from its first position and from a depth of zero. Depth is never negative, so
    # positions without reads are those of the lowest local depth, if any.
    inside = Window.partitionBy(*bins).orderBy("_pos")
    up_to = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*bins)
    local = (
        points.withColumns(
            {
                "_started": F.sum("_starts").over(up_to),
                "_ended": F.sum("_ends").over(up_to),
                "_stretch": F.lead("_pos").over(inside) - F.col("_pos"),
                "_first": F.min("_pos").over(whole),
            }
        )
        .withColumn("_depth", F.col("_started") - F.col("_ended"))
        .withColumn("_lowest", F.min(F.when(F.col("_stretch").isNotNull(), F.col("_depth"))).over(whole))
        .withColumn("_at_lowest", F.when(F.col("_depth") == F.col("_lowest"), F.col("_stretch")).otherwise(0))
        .withColumns(
            {
                "_held": F.coalesce(F.sum(F.col("_depth") * F.col("_stretch")).over(before), F.lit(0)),
                "_bare": F.coalesce(F.sum("_at_lowest").over(before), F.lit(0)),
            }
        )
    )
    # Reads are looked at once. What is asked for, and the last position of each bin, which tells all about the bin,
    # is written down: far fewer rows than positions.
    kept = written(local.filter(F.col("_asked") | F.col("_stretch").isNull()), "coverage")
    ends = kept.filter(F.col("_stretch").isNull())
    depth = F.col("_before_s") - F.col("_before_e")
    next_first = F.lead("_first").over(Window.partitionBy(*axis).orderBy("_bin"))
    entered = with_offsets(ends, axis, "_bin", {"_before_s": "_started", "_before_e": "_ended"}).select(
        *bins,
        depth.alias("_depth_in"),
        F.col("_before_s"),
        F.col("_before_e"),
        F.when(depth + F.col("_lowest") == 0, F.lit(1)).otherwise(0).alias("_has_bare"),
        (F.col("_pos") - F.col("_first")).alias("_span"),
        (F.coalesce(next_first, F.col("_pos")) - F.col("_pos")).alias("_gap"),
        (depth + F.col("_depth")).alias("_depth_out"),
        "_held",
        "_bare",
    )
    covers = F.col("_span") - F.col("_has_bare") * F.col("_bare") + F.when(F.col("_depth_out") > 0, F.col("_gap")).otherwise(0)
    holds = F.col("_depth_in") * F.col("_span") + F.col("_held") + F.col("_depth_out") * F.col("_gap")
    carried = with_offsets(entered, axis, "_bin", {"_covered_in": covers, "_bases_in": holds}).drop("_held", "_bare")
    reached = F.col("_pos") - F.col("_first")
    totals = (
        kept.filter("_asked")
        .join(carried, bins)
        .select(
            *axis,
            "_pos",
            (F.col("_before_s") + F.col("_started") - F.col("_starts")).alias("_started_before"),
            (F.col("_before_e") + F.col("_ended")).alias("_ended_up_to"),
            (F.col("_covered_in") + reached - F.col("_has_bare") * F.col("_bare")).alias("_covered"),
            (F.col("_bases_in") + F.col("_depth_in") * reached + F.col("_held")).alias("_bases"),
        )
    )

    at_start = totals.select(
        *axis,
        F.col("_pos").alias("start"),
        F.col("_ended_up_to").alias("_ended"),
        F.col("_covered").alias("_covered_0"),
        F.col("_bases").alias("_bases_0"),
    )
    at_end = totals.select(
        *axis,
        F.col("_pos").alias("end"),
        F.col("_started_before").alias("_started"),
        F.col("_covered").alias("_covered_1"),
        F.col("_bases").alias("_bases_1"),
    )
    length = F.col("end") - F.col("start")
    covered = F.col("_covered_1") - F.col("_covered_0")
    bases = F.col("_bases_1") - F.col("_bases_0")
    return (
        intervals.join(at_start, [*axis, "start"])
        .join(at_end, [*axis, "end"])
        .select(
            *intervals.columns,
            (F.col("_started") - F.col("_ended")).alias("n_reads"),
            covered.alias("covered"),
            bases.alias("bases"),
            length.alias("length"),
            F.try_divide(covered, length).alias("breadth"),
            F.try_divide(bases, length).alias("mean_depth"),
        )
    )


def _points(reads: DataFrame, intervals: DataFrame, axis: Sequence[str]) -> DataFrame:
    """One row per position at which a read starts or ends or an interval has a border.

    Reads at the same position are counted before the shuffle, so piles of copies cost nothing.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")

    def ends(first: tuple, second: tuple):
        pair = [
            F.struct(
                F.col(name).cast("long").alias("_pos"),
                starts.alias("_starts"),
                stops.alias("_ends"),
                F.lit(asked).alias("_asked"),
            )
            for name, starts, stops, asked in (first, second)
        ]
        return F.inline(F.array(*pair))

    real = reads.filter(F.col("end") > F.col("start"))
    borders = real.select(*axis, ends(("start", one, none, False), ("end", none, one, False)))
    asked = intervals.select(*axis, ends(("start", none, none, True), ("end", none, none, True)))
    return (
        borders.unionByName(asked)
        .groupBy(*axis, "_pos")
        .agg(
            F.sum("_starts").alias("_starts"),
            F.sum("_ends").alias("_ends"),
            F.bool_or("_asked").alias("_asked"),
        )
    )
