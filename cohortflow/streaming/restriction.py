"""Restricted individuals are left out of a stream as it flows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from cohortflow.operators.restriction import scrub


def scrub_stream(stream: DataFrame, sensitive: DataFrame, on: str, column: str = "id") -> DataFrame:
    """Rows of the stream that belong to no individual of ``sensitive`` as it is when the stream starts.

    A table keeps its file listing while a stream runs. Where marks may come later, use
    :func:`scrub_batches`.
    """
    return scrub(stream, sensitive, on, column)


def scrub_batches(
    read_sensitive: Callable[[], DataFrame], on: str, path: str, column: str = "id"
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: writes the rows of each batch that belong to no restricted individual.

    ``read_sensitive`` is called for each batch, so a mark counts from the next batch on. Each batch has a
    folder of its own below ``path``, so a batch that is run again replaces its rows.
    """

    def write(batch: DataFrame, number: int) -> None:
        scrub(batch, read_sensitive(), on, column).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write
