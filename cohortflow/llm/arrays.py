"""Array helpers used inside tasks: words, hashes, rolling windows and packed columns.

Words are maximal runs of characters other than space and ``\\t \\n \\v \\f \\r``. Every helper takes a
whole Arrow array; nothing here loops over words in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

# Text handled at once inside a task; batches are cut at row borders, so one long text may exceed it.
SLICE_BYTES = 8 << 20

_KEYS = ("0123456789123456", "fedcba9876543210")
_ROLL = (np.uint64(0x9E3779B97F4A7C15 | 5), np.uint64(0xC2B2AE3D27D4EB4F | 5))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches of about ``limit`` bytes of text; empty batches are left out.

    Memory that Arrow keeps for later goes back to the system after each batch: workers stay for the tasks to come.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64)) // limit
        cuts = np.flatnonzero(np.diff(group)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(start, end - start)
        del batch
        pa.default_memory_pool().release_unused()


class Words:
    """Words of an array of texts: ``ids[offsets[i]:offsets[i + 1]]`` are those of text ``i``.

    A missing text has no words. ``ids`` point into ``vocabulary``, which lists each word once.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts, "")
        if lower:
            texts = pc.ascii_lower(texts)
        if pa.types.is_string(texts.type):
            texts = texts.cast(pa.large_string())
        split = pc.ascii_split_whitespace(texts)
        ends = np.asarray(split.offsets).astype(np.int64)
        flat = split.flatten()
        real = pc.greater(pc.binary_length(flat), 0)
        seen = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))]).astype(np.int64)
        self.offsets = seen[ends - ends[0]]
        coded = flat.filter(real).dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = coded.dictionary

    def __len__(self) -> int:
        return len(self.ids)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def word_hashes(self, which: int = 0) -> np.ndarray:
        """One of two independent 64-bit hashes of each vocabulary word."""
        return hash_texts(self.vocabulary, which)

    def hashes(self, which: int = 0) -> np.ndarray:
        """The hash of each word in turn."""
        return self.word_hashes(which)[self.ids]


def hash_texts(texts: pa.Array, which: int = 0) -> np.ndarray:
    """One of two independent 64-bit hashes of each text."""
    if len(texts) == 0:
        return np.zeros(0, np.uint64)
    listed = texts.to_numpy(zero_copy_only=False)
    return pd.util.hash_array(listed, hash_key=_KEYS[which], categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def rolling(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """A hash of each run of ``length`` words: item ``p`` stands for words ``p`` to ``p + length - 1``."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for j in range(length) if length <= 8 else ():
        out = out * _ROLL[which] + hashes[j : j + count]
    if length > 8:
        powers = np.full(len(hashes), _ROLL[which], np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers, dtype=np.uint64)
        inverse = np.full(count, np.uint64(pow(int(_ROLL[which]), -1, 1 << 64)), np.uint64)
        inverse[0] = 1
        inverse = np.cumprod(inverse, dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)])
        out = (sums[length:] - sums[:-length]) * inverse
    return mix(out)


def inside(offsets: np.ndarray, length: int) -> np.ndarray:
    """Positions at which a run of ``length`` words lies within one text."""
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    total = int(counts.sum())
    first = np.repeat(offsets[:-1], counts)
    return first + np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The whole numbers of each range, one range after the other."""
    lengths = np.asarray(lengths, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, np.int64) - before, lengths) + np.arange(int(lengths.sum()))


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def pack(array: np.ndarray, left_out: int = 0) -> bytes:
    """An array as compressed bytes, all first bytes before all second ones, so that like stands by like.

    ``left_out`` lowest bytes of each number are not stored.
    """
    planes = np.ascontiguousarray(array).view(np.uint8).reshape(len(array), array.dtype.itemsize).T[left_out:]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype, left_out: int = 0) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size - left_out, -1)
    out = np.zeros((planes.shape[1], size), np.uint8)
    out[:, left_out:] = planes.T
    return out.reshape(-1).view(dtype)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        one if isinstance(one, pa.Array) else pa.array(one, type=kind)
        for one, kind in zip(columns, schema.types, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
