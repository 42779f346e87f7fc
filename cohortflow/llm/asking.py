"""Counts of keys over all blocks of a corpus, answered to each block in the order it asked.

A block is a row that holds some megabytes of a corpus and knows its own distinct keys. It sends each key once, however
often the block holds it, to the partition that counts the key; the partition adds up all blocks and answers each of
them. So a key that a third of the corpus holds is one entry per block.
Keys and answers move as packed sorted arrays, one row per block and partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.arrays import mix, pack, unpack
from cohortflow.session import scratch_path


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partitions are even ranges of hashes."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(mix(first.view(np.uint64)) + second.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def dealt(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each partition that gets something, and the places of what it gets, in their order."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)):
        yield int(p), order[cuts[p] : cuts[p + 1]]


def pack_numbers(array: np.ndarray) -> bytes:
    """Whole numbers from 0, as 32 bits each where all fit."""
    small = array.astype(np.uint32) if len(array) == 0 or array.max() < 1 << 32 else array.astype(np.uint64)
    return bytes([small.dtype.itemsize]) + pack(small)


def unpack_numbers(data: bytes) -> np.ndarray:
    return unpack(data[1:], np.uint32 if data[0] == 4 else np.uint64).astype(np.int64)


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time: each holds a block."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def added(places: list[np.ndarray], counts: list[np.ndarray], size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The totals of ``size`` keys over all messages of a partition, and for each message which keys it is the first to hold."""
    total = np.zeros(size, np.int64)
    seen = np.zeros(size, bool)
    owns = []
    for place, count in zip(places, counts):
        total[place] += count
        owns.append(~seen[place])
        seen[place] = True
    return total, owns


def stored_blocks(blocks: DataFrame, buckets: int) -> tuple[DataFrame, str]:
    """The blocks as a table in the shared folder, in buckets by ``block``, so that joining answers moves the answers only.

    Its name is returned too: drop it when all that was made from it is written.
    """
    spark = blocks.sparkSession
    name = f"blocks_{uuid.uuid4().hex}"
    path = scratch_path(spark, "blocks")
    blocks.write.bucketBy(buckets, "block").format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name), name


def with_answers(blocks: DataFrame, answers: DataFrame, name: str, *columns: str) -> DataFrame:
    """The blocks, each with the list of its answers. Blocks that asked nothing keep an empty list."""
    listed = answers.groupBy("block").agg(F.collect_list(F.struct("part", *columns)).alias(name))
    return blocks.join(listed.hint("shuffle_merge"), "block", "left")
