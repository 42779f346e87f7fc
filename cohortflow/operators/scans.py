"""Running totals over rows that no single task could hold: sums per slice first, then offsets, then the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_offsets(per_slice: DataFrame, keys: Sequence[str], order: str, totals: Mapping[str, Column | str]) -> DataFrame:
    """Add to each slice the totals of the slices before it, as the names of ``totals``.

    ``per_slice`` has one row per slice, so the window sees as many rows of a group as it has slices.
    """
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.withColumns({name: F.coalesce(F.sum(what).over(earlier), F.lit(0)) for name, what in totals.items()})
