"""DataFrame helpers: scratch tables, rows found more than once, and linked groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortflow.llm.arrays import batch_of
from cohortflow.session import broadcast_if_small, written

__all__ = [
    "broadcast_if_small",
    "components",
    "few_rows_at_once",
    "join_groups",
    "map_arrow",
    "occurrences",
    "repeated",
    "row_hash",
    "with_rows",
    "written",
]

# The value looked for, who holds it and where. A place with KNOWN added is known to be repeated; -1 marks a repeated value.
OCCURRENCES = pa.schema([("key", pa.int64()), ("row", pa.int64()), ("pos", pa.int32())])
OCCURRENCES_DDL = "key bigint, row bigint, pos int"
KNOWN = 1 << 30


def map_arrow(df: DataFrame, function: Callable, schema: str, *args) -> DataFrame:
    """``function(batches, *args)`` on the Arrow batches of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches, *args)

    return df.mapInArrow(run, schema)


@contextmanager
def few_rows_at_once(spark: SparkSession, rows: int = 2):
    """For jobs whose rows hold blocks of some megabytes: only ``rows`` of them go to Python together."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def row_hash(*columns: str) -> Column:
    """Names a row by its content: equal rows share a name, so repeated rows need no number."""
    return F.xxhash64(*columns)


def with_rows(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Only ``row``, ``doc_id`` and ``text``, whatever other columns there are."""
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return picked.select(row_hash("doc_id", "text").alias("row"), "doc_id", "text")


def occurrences(key: np.ndarray, row: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows for :func:`repeated`.

    What occurs once here goes to the partition of its key. What occurs several times here is known to
    be repeated: one marker tells the key's partition, and the occurrences travel by their row.
    So a key sends at most one row per slice to its own partition, however frequent it is.
    """
    if len(key) == 0:
        return
    order = np.argsort(key)
    ordered = key[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.append(first, len(key)))
    many = np.empty(len(key), bool)
    many[order] = np.repeat(size > 1, size)
    # Rows stay in their order: neighbours of one row compress well.
    yield batch_of(OCCURRENCES, np.where(many, row, key), row, np.where(many, pos + KNOWN, pos).astype(np.int32))
    marks = ordered[first[size > 1]]
    if len(marks):
        yield batch_of(OCCURRENCES, marks, np.zeros(len(marks), np.int64), np.full(len(marks), -1, np.int32))


def _keep_repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by ``key``: those known to be repeated, and those whose key comes again or is marked."""
    rest = None
    out = pa.schema([("row", pa.int64()), ("pos", pa.int32())])

    def settled(key, row, pos):
        if len(key) == 0:
            return None
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        known = pos >= KNOWN
        weight = np.where(pos < 0, 2, np.where(known, 0, 1))
        total = np.add.reduceat(weight, first)
        keep = known | (np.repeat(total > 1, np.diff(np.append(first, len(key)))) & (pos >= 0))
        return batch_of(out, row[keep], pos[keep] & ~np.int32(KNOWN))

    for batch in batches:
        now = [batch.column(name).to_numpy(zero_copy_only=False) for name in OCCURRENCES.names]
        if rest is not None:
            now = [np.concatenate(two) for two in zip(rest, now)]
        if len(now[0]) == 0:
            continue
        open_from = int(np.searchsorted(now[0], now[0][-1]))
        rest = [one[open_from:] for one in now]
        done = settled(*(one[:open_from] for one in now))
        if done is not None:
            yield done
    if rest is not None:
        done = settled(*rest)
        if done is not None:
            yield done


def repeated(found: DataFrame) -> DataFrame:
    """``row, pos`` of every occurrence whose key occurs at least twice.

    ``found`` holds rows made by :func:`occurrences`. One shuffle; keys are read in sorted order, so memory does not depend on
    how many rows share one.
    """
    dealt = found.repartition("key").sortWithinPartitions("key")
    return map_arrow(dealt, _keep_repeated, "row bigint, pos int")


def join_groups(rows: DataFrame, groups: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """Join rows with ``groups``, which has one row per key and the number ``n`` of its rows.

    Keys with more rows than an even share of a partition, of which there are fewer than partitions, are broadcast, so their rows
    stay where they are; the others meet their key as usual. ``groups`` is read more than once.
    """
    share = max(1, total // int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = F.broadcast(groups.where(F.col("n") > share))
    rest = rows.join(hot.select(key), key, "left_anti").join(groups.where(F.col("n") <= share), key, how)
    return rows.join(hot, key).unionByName(rest).drop("n")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable over ``links``; nodes without a link are left out.

    Alternates large-star and small-star steps (Kiveris et al., "Connected components in MapReduce and
    beyond") until nothing changes. Each step reads the one before from a table in the shared folder, and a
    node keeps one link to its smallest neighbour, so a large group becomes a star after a few steps. The links of the
    middle of such a star are not gathered (:func:`join_groups`).
    """
    edges = written(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links"
    )
    state = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        low = written(low.select("u", F.least("u", "m").alias("m"), "n"), "lowest")
        total = low.agg(F.sum("n")).first()[0] or 0
        large = join_groups(both.where("v > u"), low, "u", total).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = written(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    star = edges.groupBy("u").agg(F.min("v").alias("v"))
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
