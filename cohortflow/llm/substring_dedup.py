"""Word passages that occur more than once, found by difference-cover anchors.

Method: a set ``D`` of residues modulo ``v`` is a difference cover if every residue is a difference of two of its
members. Short windows are hashed only at positions whose residue is in ``D``. Two equal long windows at
``p`` and ``q`` then share an anchor: some shift below ``v`` takes both positions into ``D``. Anchors seen once
rule out the windows around them; the windows that hold a repeated aligned anchor are extended to full length,
and those whose full sequence occurs again are removed.

Defined results: words are runs of non-blank characters, unchanged; a missing or empty text has none. Windows are
judged on the input. A repeated row is a copy, so its windows count as repeated. Rows with one ID are cut
row by row. Texts of any length are read whole, in one task each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.arrays import SLICE_BYTES, Words, batch_of, inside, ranges, rolling, signed, slices
from cohortflow.llm.frames import OCCURRENCES_DDL, map_arrow, occurrences, repeated, with_rows

WINDOW = 35

# Perfect difference sets: every residue is a difference of two members, none superfluous.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 6, 8, 18),
    31: (0, 1, 3, 8, 12, 18),
}


def cover_for(window: int) -> tuple[int, np.ndarray, int]:
    """Period, cover and anchor length for a window: the largest period that leaves anchors two fifths of it."""
    period = max(v for v in COVERS if v == 1 or 5 * (window - v + 1) >= 2 * window)
    return period, np.array(COVERS[period]), window - period + 1


def _places(offsets: np.ndarray, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return at - offsets[:-1][owner]


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    period, cover, length = cover_for(window)
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        row = batch.column("row").to_numpy(zero_copy_only=False)
        at = inside(words.offsets, length)
        if len(at) == 0:
            continue
        owner = words.owner()[at]
        place = _places(words.offsets, at, owner)
        # A text shorter than the window has no window to extend to.
        used = np.isin(place % period, cover) & (words.counts[owner] >= window)
        at, owner, place = at[used], owner[used], place[used]
        yield from occurrences(signed(rolling(words.hashes(), length)[at]), row[owner], place)


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Full windows that hold a repeated anchor at an aligned place."""
    period, _, _ = cover_for(window)
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        row = batch.column("row").to_numpy(zero_copy_only=False)
        lists = batch.column("places")
        borders = np.asarray(lists.offsets).astype(np.int64)
        place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        owner = np.repeat(np.arange(len(row)), np.diff(borders))
        starts = ranges(np.maximum(place - period + 1, 0), np.minimum(place, period - 1) + 1)
        holder = np.repeat(owner, np.minimum(place, period - 1) + 1)
        chosen = np.zeros(len(words) + 1, bool)
        fits = starts + window <= words.counts[holder]
        chosen[words.offsets[:-1][holder[fits]] + starts[fits]] = True
        at = np.flatnonzero(chosen)
        if len(at) == 0:
            continue
        owner = words.owner()[at]
        key = rolling(words.hashes(0), window, 0)[at] ^ (rolling(words.hashes(1), window, 1)[at] << np.uint64(1))
        yield from occurrences(signed(key), row[owner], _places(words.offsets, at, owner))


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        lists = batch.column("places")
        borders = np.asarray(lists.offsets).astype(np.int64)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(borders))
        place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        change = np.zeros(len(words) + 1, np.int64)
        begin = words.offsets[:-1][owner] + place
        np.add.at(change, begin, 1)
        np.add.at(change, begin + window, -1)
        gone = np.cumsum(change)[:-1] > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        kept = words.vocabulary.take(pa.array(words.ids[~gone]))
        texts = []
        left = words.offsets - removed[words.offsets]
        for k in range(batch.num_rows):
            texts.append(" ".join(kept.slice(left[k], left[k + 1] - left[k]).to_pylist()))
        n_removed = removed[words.offsets[1:]] - removed[words.offsets[:-1]]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(k) for k in range(batch.num_columns - 2)),
                pa.array(words.counts),
                pa.array(n_removed.astype(np.int64)),
                pa.array(texts, pa.string()),
                pa.array([hashlib.sha256(one.encode()).hexdigest() for one in texts], pa.string()),
            ],
            names=[*batch.schema.names[:-2], "n_words", "n_removed", "kept_text", "kept_sha256"],
        )


def repeated_windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row, places``: where the windows of a document start whose words occur again. ``rows`` as by ``with_rows``."""
    anchors = repeated(map_arrow(rows.select("row", "text"), _anchors, OCCURRENCES_DDL, window))
    by_row = anchors.groupBy("row").agg(F.collect_set("pos").alias("places"))
    # The same columns as in the last join, so that the texts are dealt out once.
    hit = rows.join(by_row, "row").select("row", "doc_id", "places", "text")
    found = repeated(map_arrow(hit, _windows, OCCURRENCES_DDL, window))
    return found.groupBy("row").agg(F.collect_set("pos").alias("places"))


def cut_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text, kept_sha256`` of each document; kept words are joined by a space."""
    rows = with_rows(docs, id_column, text_column)
    joined = rows.join(repeated_windows(rows, window), "row", "left").select("doc_id", "places", "text")
    return map_arrow(
        joined, _cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string", window
    )
