"""Scores of whole texts under a Katz backoff bigram model learned from the training documents.

Method: n-gram counts are discounted by Good and Turing's estimate; what a context's seen words give up goes to its
unseen words in proportion to the order below, with a weight that makes every context sum to exactly 1.
``P(w | h)`` is ``d(r) r / c(h)`` for a pair seen ``r`` times, else ``weight(h) P(w)``; ``P(w)`` adds one to the counts of all
known words and of one unknown word.

How it runs: the documents are cut into blocks, stored once with their words as places in a sorted list of word
hashes. A block asks the count tables, which are partitioned by hash, only for its own distinct words and pairs
and gets the answers in the order it asked. So what moves grows with distinct pairs per block, a frequent
pair is one entry per block, and no table is whole in any task. Contexts too frequent for one partition are
dealt by their next word, and their sums (fewer than four per partition) are added up across partitions.

Entries move as packed sorted arrays, one row per block and partition. Words and pairs are known by 64-bit hashes.

Defined results: words are runs of non-blank characters, A-Z lower-cased; every text closes with one end, which counts as
a word. A missing text is an empty one. Without an ID a document belongs to the training set. Repeated rows are separate
documents and count each time. Without any training document all words are unknown.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.arrays import Words, hash_texts, mix, pack, ranges, slices, unpack
from cohortflow.llm.frames import few_rows_at_once, map_arrow, written

BLOCK_BYTES = 8 << 20
# Counts up to this are discounted.
DISCOUNTED = 5
# Contexts with more than this part of a partition's even share are dealt by the next word.
HOT_SHARE = 4
# Lowest bytes of the hash of a pair's second word that are not sent: 56 bits tell the words after one context apart.
LEFT_OUT = 1


def narrow(array: np.ndarray) -> np.ndarray:
    """Unsigned 32-bit numbers where all fit; counts seldom do not."""
    return array.astype(np.uint32) if len(array) == 0 or array.max() < 1 << 32 else array.astype(np.uint64)


def pack_counts(array: np.ndarray) -> bytes:
    small = narrow(array)
    return bytes([small.dtype.itemsize]) + pack(small)


def unpack_counts(data: bytes) -> np.ndarray:
    return unpack(data[1:], np.uint32 if data[0] == 4 else np.uint64).astype(np.int64)


END = hash_texts(pa.array([" end"]))[0]
START = hash_texts(pa.array([" start"]))[0]


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its documents, and their words with the end and start marks as places in a sorted list."""
    task, k = TaskContext.get().partitionId(), 0
    for batch in slices(batches, "text", BLOCK_BYTES):
        words = Words(batch.column("text"), lower=True)
        listed = np.concatenate([words.word_hashes(), [END, START]]).astype(np.uint64)
        vocabulary, place = np.unique(listed, return_inverse=True)
        count = words.counts
        # Each document as: start, its words, end.
        borders = np.concatenate([[0], np.cumsum(count + 2)])
        ids = np.full(borders[-1], place[-2], np.int64)
        ids[borders[:-1]] = place[-1]
        ids[ranges(borders[:-1] + 1, count)] = place[words.ids]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) | k], pa.int64()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([batch.column("held_out").to_pylist()], pa.list_(pa.bool_())),
                pa.array([pack(count.astype(np.uint32))], pa.binary()),
                pa.array([pack(vocabulary)], pa.binary()),
                pa.array([pack(ids.astype(np.uint32))], pa.binary()),
            ],
            names=["block", "doc_ids", "held_out", "sizes", "vocabulary", "ids"],
        )
        k += 1


class Block:
    """The words of a block's documents in turn, each with the one before it, as places in ``vocabulary``."""

    def __init__(self, row: dict):
        self.held_out = np.array([bool(x) for x in row["held_out"]], bool)
        self.sizes = unpack(row["sizes"], np.uint32).astype(np.int64)
        self.vocabulary = unpack(row["vocabulary"], np.uint64)
        ids = unpack(row["ids"], np.uint32).astype(np.int32)
        word = np.ones(len(ids), bool)
        word[np.cumsum(self.sizes + 2) - self.sizes - 2] = False
        self.owner = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes + 1)
        self.tokens = ids[word]
        self.before = ids[np.flatnonzero(word) - 1]

    def train(self) -> np.ndarray:
        return ~self.held_out[self.owner]

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train()], minlength=len(self.vocabulary))


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """One row at a time: each holds a block."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Partitions are even ranges of hashes, so a sorted list falls into consecutive pieces."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _ask_words(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            block = Block(row)
            counts = block.word_counts()
            cuts = np.searchsorted(_part(block.vocabulary, parts), np.arange(parts + 1))
            asked = [(p, a, b) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _, _ in asked], pa.int32()),
                    pa.array([row["block"]] * len(asked), pa.int64()),
                    pa.array([pack(block.vocabulary[a:b]) for _, a, b in asked], pa.binary()),
                    pa.array([pack_counts(counts[a:b]) for _, a, b in asked], pa.binary()),
                ],
                names=["part", "block", "keys", "counts"],
            )


def _add_words(table: pa.Table) -> pa.Table:
    """Counts of a partition's words over all blocks, sent back in each block's order."""
    rows = table.to_pylist()
    keys = [unpack(r["keys"], np.uint64) for r in rows]
    whole, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate([unpack_counts(r["counts"]) for r in rows]), len(whole)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    answers = [pack_counts(total[place[e - len(k) : e]]) for k, e in zip(keys, ends)]
    first = [k == 0 for k in range(len(rows))]
    return pa.table(
        {
            "block": pa.array([r["block"] for r in rows], pa.int64()),
            "part": pa.array([r["part"] for r in rows], pa.int32()),
            "counts": pa.array(answers, pa.binary()),
            "n_tokens": pa.array([int(total.sum()) if one else 0 for one in first], pa.int64()),
            "n_words": pa.array([int((total > 0).sum()) if one else 0 for one in first], pa.int64()),
        }
    )


class Pairs:
    """Distinct pairs of a block in the order of context and word, and where each of its tokens falls among them."""

    def __init__(self, block: Block, answers: list[dict], n_tokens: int, parts: int):
        size = len(block.vocabulary)
        self.known = np.concatenate([unpack_counts(one["counts"]) for one in sorted(answers, key=lambda a: a["part"])])
        key, place = np.unique(block.before.astype(np.int64) * size + block.tokens, return_inverse=True)
        self.place = place.astype(np.int32)
        self.context, self.next = (key // size).astype(np.int32), (key % size).astype(np.int32)
        del key, place
        self.seen = np.bincount(self.place[block.train()], minlength=len(self.context)).astype(np.int32)
        # How often a context starts a pair: as a word, but for the start, which is no word.
        self.hot = self.known * parts * HOT_SHARE > n_tokens
        self.hot[np.searchsorted(block.vocabulary, START)] = True
        part = _part(block.vocabulary, parts)[self.context].astype(np.int32)
        hot = np.flatnonzero(self.hot[self.context])
        by_next = mix(block.vocabulary[self.next[hot]] ^ block.vocabulary[self.context[hot]])
        part[hot] = _part(by_next, parts)
        self.order = np.argsort(part, kind="stable").astype(np.int32)
        self.cuts = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=parts))])

    def of_part(self, part: int) -> np.ndarray:
        return self.order[self.cuts[part] : self.cuts[part + 1]]


def _ask_pairs(batches: Iterator[pa.RecordBatch], n_tokens: int, parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _rows(batch):
            block = Block(row)
            pairs = Pairs(block, row["answers"], n_tokens, parts)
            for p in range(parts):
                mine = pairs.of_part(p)
                if len(mine) == 0:
                    continue
                context, run = np.unique(pairs.context[mine], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p], pa.int32()),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([pack(block.vocabulary[context])], pa.binary()),
                        pa.array([pack(pairs.hot[context].astype(np.uint8))], pa.binary()),
                        pa.array([pack_counts(run)], pa.binary()),
                        pa.array([pack(block.vocabulary[pairs.next[mine]], LEFT_OUT)], pa.binary()),
                        pa.array([pack_counts(pairs.seen[mine])], pa.binary()),
                        pa.array([pack_counts(pairs.known[pairs.next[mine]])], pa.binary()),
                    ],
                    names=["part", "block", "contexts", "hot", "runs", "words", "counts", "known"],
                )


# Per context, whole numbers: pairs seen 1 to DISCOUNTED times, all pairs, and the sum of one more than the counts of its
# seen words, which is their share in the order below but for the common divisor.
_STATS = DISCOUNTED + 2


def _add_pairs(table: pa.Table) -> pa.Table:
    """Counts of a partition's pairs over all blocks, and sums of its contexts, in each block's order."""
    rows = table.to_pylist()
    lists = [unpack(r["contexts"], np.uint64) for r in rows]
    runs = [unpack_counts(r["runs"]) for r in rows]
    sizes = np.array([int(x.sum()) for x in runs])
    context, context_place = np.unique(np.concatenate(lists), return_inverse=True)
    hot = np.zeros(len(context), bool)
    hot[context_place] = np.concatenate([unpack(r["hot"], np.uint8) for r in rows]) > 0
    context_place = context_place.astype(np.int32)
    holder = np.repeat(context_place, np.concatenate(runs))
    words = np.concatenate([unpack(r["words"], np.uint64, LEFT_OUT) for r in rows])
    counts = np.concatenate([unpack_counts(r["counts"]) for r in rows])
    known = np.concatenate([unpack_counts(r["known"]) for r in rows])
    order = np.lexsort((words, holder))
    words, holder = words[order], holder[order]
    new = np.ones(len(order), bool)
    new[1:] = (words[1:] != words[:-1]) | (holder[1:] != holder[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(counts[order], first)
    of, lower = holder[first], known[order[first]] + 1
    del words, holder, counts, known
    back = np.empty(len(order), np.int32)
    back[order] = np.cumsum(new) - 1
    stats = np.zeros((len(context), _STATS), np.int64)
    for r in range(1, DISCOUNTED + 1):
        stats[:, r - 1] = np.bincount(of[total == r], minlength=len(context))
    stats[:, DISCOUNTED] = np.bincount(of, total, len(context))
    stats[:, DISCOUNTED + 1] = np.bincount(of, lower * (total > 0), len(context))
    ends, list_ends = np.cumsum(sizes), np.cumsum([len(x) for x in lists])
    times = [int((total == r).sum()) for r in range(1, DISCOUNTED + 2)]
    few = np.flatnonzero(hot)
    return pa.table(
        {
            "block": pa.array([r["block"] for r in rows], pa.int64()),
            "part": pa.array([r["part"] for r in rows], pa.int32()),
            "counts": pa.array([pack_counts(total[back[e - n : e]]) for n, e in zip(sizes, ends)], pa.binary()),
            "stats": pa.array(
                [
                    pack_counts(stats[context_place[e - len(x) : e]].T.reshape(-1))
                    for x, e in zip(lists, list_ends)
                ],
                pa.binary(),
            ),
            "times": pa.array([times if k == 0 else [] for k in range(len(rows))], pa.list_(pa.int64())),
            "hot": pa.array(
                [
                    [{"context": int(context[f].view(np.int64)), "stats": stats[f].tolist()} for f in few] if k == 0 else []
                    for k in range(len(rows))
                ],
                pa.list_(pa.struct([("context", pa.int64()), ("stats", pa.list_(pa.int64()))])),
            ),
        }
    )


def discounts(times: np.ndarray) -> np.ndarray:
    """Factors of counts 0 to ``DISCOUNTED`` (0 unused), from how many pairs occur 1, 2, ... times.

    Good-Turing as Katz uses it. Where counts of counts do not give a factor between 0 and 1, which happens in small or
    odd corpora, half a count is taken off instead.
    """
    out = np.ones(DISCOUNTED + 1)
    n = np.concatenate([[0], np.asarray(times, float)])
    common = (DISCOUNTED + 1) * n[DISCOUNTED + 1] / n[1] if n[1] else 1.0
    for r in range(1, DISCOUNTED + 1):
        factor = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
        out[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return out


def backoff(stats: np.ndarray, factors: np.ndarray, divide: int) -> tuple[np.ndarray, np.ndarray]:
    """The divisor and the backoff weight of each context; a context never seen has divisor 0 and weight 1.

    ``divide`` is the common divisor of the order below. A context whose seen words would keep everything gets one more
    in its divisor, so that unseen words keep a share.
    """
    r = np.arange(1, DISCOUNTED + 1)
    count, low = stats[:, DISCOUNTED], stats[:, :DISCOUNTED]
    # What the seen words give up, added up on its own: it may be tiny beside the count.
    given = low @ (r * (1 - factors[1:]))
    full = (count > 0) & (given <= 0)
    divisor = count + full
    left = (given + full) / np.maximum(divisor, 1)
    weight = np.where(count > 0, left * divide / np.maximum(divide - stats[:, DISCOUNTED + 1], 1), 1.0)
    return divisor, weight


def _score(batches: Iterator[pa.RecordBatch], n_tokens: int, n_words: int, parts: int, shared) -> Iterator[pa.RecordBatch]:
    factors, hot_keys, hot_stats = shared.value
    divide = n_tokens + n_words + 1
    for batch in batches:
        for row in _rows(batch):
            block = Block(row)
            pairs = Pairs(block, row["answers"], n_tokens, parts)
            answers = {one["part"]: one for one in row["pair_answers"]}
            simple = np.log10((pairs.known + 1) / divide)
            logs = np.empty(len(pairs.context))
            for p in range(parts):
                mine = pairs.of_part(p)
                if len(mine) == 0:
                    continue
                count = unpack_counts(answers[p]["counts"])
                context, place = np.unique(pairs.context[mine], return_inverse=True)
                stats = unpack_counts(answers[p]["stats"]).reshape(_STATS, -1).T.copy()
                few = np.flatnonzero(pairs.hot[context])
                if len(few):
                    stats[few] = hot_stats[np.searchsorted(hot_keys, block.vocabulary[context[few]])]
                divisor, weight = backoff(stats, factors, divide)
                factor = np.where(count <= DISCOUNTED, factors[np.minimum(count, DISCOUNTED)], 1.0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    direct = np.log10(factor * count / divisor[place])
                logs[mine] = np.where(count > 0, direct, np.log10(weight)[place] + simple[pairs.next[mine]])
            docs = len(block.sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(block.held_out),
                    pa.array(block.sizes + 1),
                    pa.array(np.bincount(block.owner, pairs.known[block.tokens] > 0, docs).astype(np.int64)),
                    pa.array(np.full(docs, n_tokens, np.int64)),
                    pa.array(np.bincount(block.owner, simple[block.tokens], docs)),
                    pa.array(np.bincount(block.owner, logs[pairs.place], docs)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )


def _asked(blocks: DataFrame, answers: DataFrame, name: str, *columns: str) -> DataFrame:
    listed = answers.groupBy("block").agg(F.collect_list(F.struct("part", *columns)).alias(name))
    return blocks.join(listed.hint("shuffle_merge"), "block")


def _scores(blocks: DataFrame, parts: int) -> DataFrame:
    spark = blocks.sparkSession
    words = map_arrow(blocks, _ask_words, "part int, block bigint, keys binary, counts binary", parts)
    answers = written(
        words.groupBy("part").applyInArrow(
            _add_words, "block bigint, part int, counts binary, n_tokens bigint, n_words bigint"
        ),
        "word-counts",
    )
    totals = answers.agg(F.sum("n_tokens"), F.sum("n_words")).first()
    n_tokens, n_words = int(totals[0] or 0), int(totals[1] or 0)

    with_words = _asked(blocks, answers, "answers", "counts")
    pairs = map_arrow(
        with_words,
        _ask_pairs,
        "part int, block bigint, contexts binary, hot binary, runs binary, words binary, counts binary, known binary",
        n_tokens,
        parts,
    )
    pair_answers = written(
        pairs.groupBy("part").applyInArrow(
            _add_pairs,
            "block bigint, part int, counts binary, stats binary, times array<bigint>, "
            "hot array<struct<context: bigint, stats: array<bigint>>>",
        ),
        "pair-counts",
    )
    times = pair_answers.select(F.posexplode("times").alias("r", "n")).groupBy("r").agg(F.sum("n").alias("n"))
    found = {row["r"]: row["n"] for row in times.collect()}
    factors = discounts(np.array([found.get(r, 0) for r in range(DISCOUNTED + 1)]))
    # Fewer than HOT_SHARE contexts per partition can be this frequent.
    hot = pair_answers.select(F.inline("hot")).groupBy("context").agg(
        *(F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(_STATS))
    )
    few = sorted((int(np.int64(r["context"]).view(np.uint64)), [r[f"s{k}"] for k in range(_STATS)]) for r in hot.collect())
    keys = np.array([one[0] for one in few], np.uint64)
    shared = spark.sparkContext.broadcast((factors, keys, np.array([one[1] for one in few], np.int64).reshape(-1, _STATS)))
    ready = _asked(with_words, pair_answers, "pair_answers", "counts", "stats")
    out = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return written(map_arrow(ready, _score, out, n_tokens, n_words, parts, shared), "scores")


def katz_scores(
    docs: DataFrame, held_out: Column | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each document, log10.

    The model learns from the documents that are not ``held_out`` (an expression over ``doc_id``).
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A task unpacks one count partition at a time, so these are half as large as the shuffle's.
    parts = 2 * buckets
    held_out = F.lit(False) if held_out is None else held_out
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    picked = picked.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    schema = "block bigint, doc_ids array<bigint>, held_out array<boolean>, sizes binary, vocabulary binary, ids binary"
    # Stored in buckets by block, so that joining answers to blocks moves the answers only.
    name = f"katz_blocks_{uuid.uuid4().hex}"
    map_arrow(picked, _store, schema).write.bucketBy(buckets, "block").format("parquet").saveAsTable(name)
    blocks = spark.table(name)
    try:
        with few_rows_at_once(spark):
            return _scores(blocks, parts)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
