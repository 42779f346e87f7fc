"""Documents packed into sequences that all hold the sources in target proportions.

Method: deficit round-robin. Each source is a queue of its documents' ids, served in quanta; a quantum goes to the
source whose service lags its target most, and what a source is owed is carried from window to window. The
order of such a service has a closed form: quantum ``j`` of a source of weight ``w`` falls due at
``(2 j + 1) / w``, and its turn is the number of quanta due before. So every task finds the windows of its own
documents without a pass over the others, and deficits carry across partitions by construction. A source that
runs dry leaves its share to the rest.

Quanta divide the window, so all windows are full but for one short quantum per source at the end of its queue.
Defined results: a missing text is empty and still has its closing id; a missing source is a source of its own
(the empty name); repeated rows are packed as often as they occur. Without targets the weights are the sources'
own token counts, so that all queues last to the end.

The driver holds one row per source, never per document; sources are few names, checked against ``MOST_SOURCES``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.arrays import ranges
from cohortflow.llm.frames import broadcast_if_small, map_arrow
from cohortflow.llm.tokens import default_vocabulary, token_table

LENGTH = 1024
QUANTUM = 128
MOST_SOURCES = 100_000
_WEIGHT_BITS = 20


class Schedule:
    """Turns of the quanta of all sources."""

    def __init__(self, totals: Mapping[str, int], targets: Mapping[str, float] | None, length: int, quantum: int):
        if length % quantum:
            raise ValueError("the quantum must divide the window")
        self.length, self.quantum = length, quantum
        self.names = sorted(totals)
        self.place = {name: k for k, name in enumerate(self.names)}
        tokens = np.array([totals[name] for name in self.names], np.int64)
        self.quanta = -(-tokens // quantum)
        shares = np.array([float((targets or totals).get(name, 0)) for name in self.names])
        if (shares < 0).any():
            raise ValueError("weights must not be negative")
        # A source without a target comes after all others have run dry, so nothing is lost.
        self.late = shares == 0
        largest = shares.max() if len(shares) and shares.max() > 0 else 1.0
        self.weights = np.maximum(np.rint(shares / largest * (1 << _WEIGHT_BITS)), 1).astype(np.int64)
        self.short = quantum - (tokens - np.maximum(self.quanta - 1, 0) * quantum)
        # The turn of the last quantum of each source that is not full.
        ends = [self.turns(k, self.quanta[k : k + 1] - 1)[0] for k in range(len(tokens))]
        uneven = [k for k in range(len(tokens)) if self.short[k] > 0]
        uneven.sort(key=lambda k: ends[k])
        self.short_turns = np.array([ends[k] for k in uneven], np.int64)
        self.short_sums = np.concatenate([[0], np.cumsum([self.short[k] for k in uneven])]).astype(np.int64)

    def turns(self, source: int, quantum: np.ndarray) -> np.ndarray:
        """How many quanta are served before the given ones of a source."""
        due = 2 * quantum.astype(np.int64) + 1
        total = np.zeros(len(due), np.int64)
        for other, weight in enumerate(self.weights):
            if self.late[other] != self.late[source]:
                total += self.quanta[other] if self.late[source] else 0
                continue
            # Quanta j of the other with (2 j + 1) / its weight before (or, of earlier names, at) ours.
            last = (due * weight - (other >= source)) // self.weights[source]
            total += np.minimum((last + 1) // 2, self.quanta[other])
        return total

    def position(self, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequence of each turn and where it begins there, short quanta before it taken into account."""
        per = self.length // self.quantum
        sequence = turns // per
        before = self.short_sums[np.searchsorted(self.short_turns, turns)]
        at_start = self.short_sums[np.searchsorted(self.short_turns, sequence * per)]
        return sequence, (turns % per) * self.quantum - (before - at_start)


PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def _pieces(batches: Iterator[pa.RecordBatch], schedule, with_ids: bool) -> Iterator[pa.RecordBatch]:
    schedule = schedule.value
    quantum = schedule.quantum
    for batch in batches:
        if batch.num_rows == 0:
            continue
        n = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
        begin = (batch.column("start").to_numpy() + batch.column("before").to_numpy()).astype(np.int64)
        first, last = begin // quantum, (begin + n - 1) // quantum
        owner = np.repeat(np.arange(len(n)), last - first + 1)
        slot = ranges(first, last - first + 1)
        low = np.maximum(slot * quantum, begin[owner])
        high = np.minimum((slot + 1) * quantum, (begin + n)[owner])
        source = np.array([schedule.place[name] for name in batch.column("source").to_pylist()])[owner]
        turn = np.empty(len(slot), np.int64)
        for one in np.unique(source):
            mine = source == one
            distinct, where = np.unique(slot[mine], return_inverse=True)
            turn[mine] = schedule.turns(int(one), distinct)[where]
        sequence, offset = schedule.position(turn)
        data = [np.frombuffer(one, np.uint16).astype("<u4").tobytes() for one in batch.column("ids").to_pylist()]
        start, end = low - begin[owner], high - begin[owner]
        cut = [data[k][4 * a : 4 * b] for k, a, b in zip(owner, start, end)]
        columns = [
            batch.column("doc_id").take(pa.array(owner)),
            batch.column("source").take(pa.array(owner)),
            pa.array(start),
            pa.array(end - start),
            pa.array([zlib.crc32(one) for one in cut], pa.int64()),
            pa.array(n[owner]),
            pa.array(sequence),
            pa.array(offset + low - slot * quantum),
        ]
        names = "doc_id source start length ids_crc32 doc_tokens sequence_id offset".split()
        if with_ids:
            columns, names = [*columns, pa.array(cut, pa.binary())], [*names, "ids"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def pack(
    docs: DataFrame,
    targets: Mapping[str, float] | None = None,
    vocabulary: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    length: int = LENGTH,
    quantum: int = QUANTUM,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it starts in the document, how long it is, and its place in a sequence.

    ``targets`` are token proportions by source; a source without one is packed after the others. ``with_ids`` adds
    the ids of the piece as little-endian 32-bit numbers.
    """
    spark = docs.sparkSession
    tokens = token_table(docs, vocabulary or default_vocabulary(), id_column, text_column, source_column)
    by_task = tokens.groupBy("part", "source").agg(F.sum("n").alias("n"))
    # One row per task and source: few, also where a source holds most documents.
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("part", "source", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    sources = by_task.groupBy("source").agg(F.sum("n").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    schedule = spark.sparkContext.broadcast(Schedule({r["source"]: r["n"] for r in sources}, targets, length, quantum))
    placed = tokens.join(broadcast_if_small(before), ["part", "source"])
    return map_arrow(placed, _pieces, PIECES + (", ids binary" if with_ids else ""), schedule, with_ids)
