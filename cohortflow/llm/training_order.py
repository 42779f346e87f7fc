"""Token sequences in training order, as shard files of records of one fixed size.

Method: every sequence has a number; a keyed Feistel network, walked along its cycle until it falls below the
count, is a permutation of these numbers, so it gives each sequence its slot in the training order without a
sort key, a table or a shuffle buffer, and can be inverted. Range partitions hold neighbouring shards and write each as one raw
file. A trainer reads shards in order and resumes at any slot: its shard and its first byte there follow by division.

A record is of ``record_bytes`` bytes: the number of ids, then ``length`` ids of 16 bits, unused ones 0. Documents follow each
other in a task's stream and are cut every ``length`` ids, so that only the last record of a task is short.
A shard's file is written under another name and then renamed, so a task that is run again replaces it whole.
On their way to the shards sequences are compressed; in the shards they are not.

Defined results: a missing or empty text is its closing id; repeated rows are written each time; an empty table gives no
shard. Numbers depend on how the input is split into tasks; the written files are the order of record.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.arrays import mix, pack, slices, unpack
from cohortflow.llm.frames import broadcast_if_small, map_arrow, written
from cohortflow.llm.tokens import END, default_vocabulary, encoder
from cohortflow.sources.listing import file_system

LENGTH = 1024
SHARD_RECORDS = 8192
CHUNK_RECORDS = 256
ROUNDS = 6


def record_bytes(length: int) -> int:
    return 4 + 2 * length


def _feistel(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = x >> np.uint64(half), x & mask
    keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(key))
    for one in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (mix(left ^ one) & mask), left
        else:
            left, right = right, left ^ (mix(right ^ one) & mask)
    return (left << np.uint64(half)) | right


def permute(numbers: np.ndarray, count: int, key: int, back: bool = False) -> np.ndarray:
    """The slot of each number below ``count``, or with ``back`` the number of each slot."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    out = _feistel(numbers.astype(np.uint64), half, key, back)
    while (outside := out >= np.uint64(count)).any():
        out[outside] = _feistel(out[outside], half, key, back)
    return out.astype(np.int64)


def _cut(batches: Iterator[pa.RecordBatch], path: str, length: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    part, made = TaskContext.get().partitionId(), 0
    rest = np.zeros(0, np.uint16)

    def rows(ids: np.ndarray, n: int):
        nonlocal made
        cut = [ids[k : k + length] for k in range(0, n, length)]
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(cut), pa.int32()),
                pa.array(range(made, made + len(cut)), pa.int64()),
                pa.array([one.tobytes() for one in cut], pa.binary()),
            ],
            names=["part", "place", "ids"],
        )
        made += len(cut)
        return batch

    for batch in slices(batches, "text"):
        encoded = [np.array([*(encode(t) if t else ()), END], np.uint16) for t in batch.column("text").to_pylist()]
        stream = np.concatenate([rest, *encoded])
        whole = len(stream) // length * length
        rest = stream[whole:]
        if whole:
            yield rows(stream, whole)
    if len(rest):
        yield rows(rest, len(rest))


def _place(batches: Iterator[pa.RecordBatch], count: int, key: int, per_shard: int) -> Iterator[pa.RecordBatch]:
    """One row per shard and batch: the places in the shard, and the sequences' ids one after the other."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        slot = permute(batch.column("number").to_numpy(), count, key)
        order = np.argsort(slot)
        ids, sizes = batch.column("ids").to_pylist(), []
        cuts = np.flatnonzero(np.diff(slot[order] // per_shard)) + 1
        parts = np.split(order, cuts)
        data = []
        for part in parts:
            data.append(press.compress(b"".join(ids[k] for k in part)))
            sizes.append(pack(np.array([len(ids[k]) // 2 for k in part], np.uint32)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(slot[part[0]]) // per_shard for part in parts], pa.int64()),
                pa.array([pack((slot[part] % per_shard).astype(np.uint32)) for part in parts], pa.binary()),
                pa.array(sizes, pa.binary()),
                pa.array(data, pa.binary()),
            ],
            names=["shard", "places", "sizes", "data"],
        )


def shard_path(folder: str, shard: int) -> str:
    return f"{folder.rstrip('/')}/shard-{shard:010d}.bin"


def _write_shard(folder: str, shard: int, records: np.ndarray) -> str:
    path = shard_path(folder, shard)
    files, target, _ = file_system(path)
    files.create_dir(target.rsplit("/", 1)[0], recursive=True)
    draft = f"{target}.{TaskContext.get().taskAttemptId()}.draft"
    with files.open_output_stream(draft, compression=None) as file:
        file.write(records)
    files.move(draft, target)
    return path


def _shards(batches: Iterator[pa.RecordBatch], folder: str, count: int, length: int, per_shard: int) -> Iterator[pa.RecordBatch]:
    """Writes the shards of a partition, whose rows are sorted by shard; one shard is held at a time."""
    size = record_bytes(length)
    open_shard, records = None, np.zeros((0, size), np.uint8)

    def close() -> pa.RecordBatch:
        path = _write_shard(folder, open_shard, records)
        return pa.RecordBatch.from_arrays(
            [pa.array([open_shard], pa.int64()), pa.array([len(records)], pa.int64()), pa.array([path], pa.string())],
            names=["shard", "n", "path"],
        )

    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if row["shard"] != open_shard:
                if open_shard is not None:
                    yield close()
                open_shard = row["shard"]
                records = np.zeros((min(per_shard, count - open_shard * per_shard), size), np.uint8)
            places, sizes = unpack(row["places"], np.uint32), unpack(row["sizes"], np.uint32).astype("<u4")
            records[places, :4] = sizes.view(np.uint8).reshape(-1, 4)
            data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["data"]), np.uint8)
            ends = np.cumsum(2 * sizes.astype(np.int64))
            for place, end, n in zip(places.tolist(), ends.tolist(), sizes.tolist()):
                records[place, 4 : 4 + 2 * n] = data[end - 2 * n : end]
    if open_shard is not None:
        yield close()


def write_training_order(
    docs: DataFrame,
    folder: str,
    key: int,
    vocabulary: str | None = None,
    text_column: str = "text",
    length: int = LENGTH,
    per_shard: int = SHARD_RECORDS,
) -> tuple[int, DataFrame]:
    """Writes the shard files of ``folder``; returns the number of sequences and the table ``shard, n, path`` of the files.

    A task holds one shard of ``per_shard`` records. ``folder`` is a path that executors share, or a URI.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_column).alias("text"))
    cut = written(
        map_arrow(texts, _cut, "part int, place bigint, ids binary", vocabulary or default_vocabulary(), length),
        "sequences",
        compression="zstd",
    )
    by_task = cut.groupBy("part").agg(F.count("*").alias("n"))
    # One row per task of the first job.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = by_task.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    count = by_task.agg(F.sum("n")).first()[0] or 0
    numbered = cut.join(broadcast_if_small(offsets), "part").select(
        (F.col("before") + F.col("place")).alias("number"), "ids"
    )
    schema = "shard bigint, places binary, sizes binary, data binary"
    placed = map_arrow(numbered, _place, schema, count, key, per_shard)
    shards = max(1, -(-count // per_shard))
    partitions = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Shards are numbered without gaps, so their ranges need no sampling.
    ranged = placed.repartitionById(partitions, F.floor(F.col("shard") * partitions / shards).cast("int"))
    files = map_arrow(
        ranged.sortWithinPartitions("shard"), _shards, "shard bigint, n bigint, path string", folder, count, length, per_shard
    )
    return count, written(files, "shards")


def _describe(
    batches: Iterator[pa.RecordBatch], count: int, key: int, length: int, per_shard: int, first_slot: int, at_once: int
) -> Iterator[pa.RecordBatch]:
    """Reads shards from the first wanted record on, some records at a time."""
    size = record_bytes(length)
    for batch in batches:
        for row in batch.to_pylist():
            files, path, _ = file_system(row["path"])
            begin = max(first_slot - row["shard"] * per_shard, 0)
            with files.open_input_file(path) as file:
                for at in range(begin, row["n"], at_once):
                    some = min(at_once, row["n"] - at)
                    data = np.frombuffer(file.read_at(some * size, at * size), np.uint8).reshape(some, size)
                    slot = row["shard"] * per_shard + at + np.arange(some)
                    n = data[:, :4].copy().view("<u4")[:, 0].astype(np.int64)
                    ids = data[:, 4:].copy().view("<u2").astype("<u4")
                    listed = [ids[k, : n[k]].tobytes() for k in range(some)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(slot),
                            pa.array(permute(slot, count, key, back=True)),
                            pa.array(np.full(some, row["shard"], np.int64)),
                            pa.array((at + np.arange(some)) * size),
                            pa.array(n),
                            pa.array([zlib.crc32(one) for one in listed], pa.int64()),
                            pa.array(listed, pa.binary()),
                        ],
                        names=["slot", "sequence_id", "shard", "offset", "n_tokens", "ids_crc32", "ids"],
                    )


def read_training_order(
    shards: DataFrame,
    count: int,
    key: int,
    first_slot: int = 0,
    length: int = LENGTH,
    per_shard: int = SHARD_RECORDS,
    at_once: int = CHUNK_RECORDS,
) -> DataFrame:
    """``slot, sequence_id, shard, offset, n_tokens, ids_crc32, ids`` from ``first_slot`` on.

    ``shards`` is the table of files. ``offset`` is the record's first byte in its shard's file; ``ids`` are little-endian
    32-bit numbers.
    """
    wanted = shards.where(F.col("shard") >= first_slot // per_shard)
    schema = "slot bigint, sequence_id bigint, shard bigint, offset bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    # A row is a whole file to read, so rows are not to be put together because they are short.
    dealt = wanted.repartition(int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard")
    return map_arrow(dealt, _describe, schema, count, key, length, per_shard, first_slot, at_once)


def read_record(folder: str, slot: int, length: int = LENGTH, per_shard: int = SHARD_RECORDS) -> np.ndarray:
    """The ids at one slot, by one seek, as a trainer that resumes there would read them."""
    size = record_bytes(length)
    files, path, _ = file_system(shard_path(folder, slot // per_shard))
    with files.open_input_file(path) as file:
        data = file.read_at(size, slot % per_shard * size)
    n = int.from_bytes(data[:4], "little")
    return np.frombuffer(data, "<u2", n, 4)
