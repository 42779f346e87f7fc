"""Alignment of the tokens that two tokenizers make of the same texts, with corpus-wide counts of linked pairs.

Method: an array holds for each id of the first tokenizer (A) the id of the second (B) with the same bytes. A group of one A and one
B token that this identity map explains is counted in a vector as long as A's vocabulary; so is any other link of such a pair.
Only pairs that the map does not explain, which come from irregular groups, are sent to the partitions that count pairs. Both
kinds of counts are numbers of documents. The counts of the identity pairs and the highest count of each A id are as long as
the vocabulary and go to every task; the counts of irregular pairs go back to the blocks that asked for them.

Neither tokenizer joins characters over a border between a visible ASCII character and a blank (for B this is checked on
the vocabulary, A's pattern never matches over it), so both end a token there. Texts are cut at these borders, each distinct
stretch of a slice is encoded and aligned once, and a document is its stretches in turn.

Defined results: A text that is missing or empty, or whose tokens of either kind do not give back one blank and the text, has no tokens:
zeros and an empty digest. Repeated rows are separate documents and count each time. Strings of special tokens are plain text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.arrays import mix, pack, ranges, slices, unpack
from cohortflow.llm.asking import (
    added,
    dealt,
    pack_numbers,
    part_of,
    rows_of,
    stored_blocks,
    unpack_numbers,
    with_answers,
)
from cohortflow.llm.frames import few_rows_at_once, map_arrow, written
from cohortflow.llm.tokens import byte_alphabet, default_vocabulary, stretches

BLOCK_BYTES = 6 << 20
BLANK = "▁"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Side:
    """The bytes of each id, one after the other, and the digits of each id."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, listed: list[bytes]) -> Side:
        lengths = np.array([len(one) for one in listed], np.int64)
        return cls(np.frombuffer(b"".join(listed), np.uint8), np.cumsum(lengths) - lengths, lengths)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.starts[ids], self.lengths[ids])]


@dataclass
class Pair:
    """Both tokenizers: functions from stretches to ids, the bytes of their ids, and the identity map (-1: no such B id)."""

    encode_a: object
    encode_b: object
    a: Side
    b: Side
    same: np.ndarray


def _piece_bytes(model) -> list[bytes]:
    out = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        out.append(bytes([int(piece[1:-1], 16)]) if model.is_byte(k) else piece.replace(BLANK, " ").encode())
    return out


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each id of A the id of B with the same bytes. Of several, the last one: single bytes come first and are a way out."""
    place = {one: k for k, one in enumerate(b)}
    return np.array([place.get(one, -1) for one in a], np.int64)


@lru_cache(maxsize=1)
def tokenizer_pair(path_a: str, path_b: str) -> Pair:
    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(path_a, encoding="utf-8") as file:
        stored = json.load(file)
    alphabet = byte_alphabet()
    specials = {one["content"]: one["id"] for one in stored.get("added_tokens", ())}
    vocabulary = {token: k for token, k in stored["model"]["vocab"].items() if token not in specials}
    listed_a = [b""] * (1 + max([*vocabulary.values(), *specials.values()]))
    for token, k in vocabulary.items():
        listed_a[k] = bytes(alphabet[c] for c in token)
    ranks = {listed_a[k]: k for k in vocabulary.values()}
    fast = tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    listed_b = _piece_bytes(model)
    for k in range(model.get_piece_size()):
        if not model.is_control(k) and any(c != BLANK for c in model.id_to_piece(k).rpartition(BLANK)[0]):
            raise ValueError("a piece holds a blank after another character: texts cannot be cut before blanks")
    blank = model.piece_to_id(BLANK)

    def encode_a(stretches: list[str]) -> list[list[int]]:
        return [fast.encode_ordinary(one) for one in stretches]

    def encode_b(stretches: list[str]) -> list[list[int]]:
        # The blank in front is added by the tokenizer itself, but not to an empty text.
        found = model.encode([one[1:] for one in stretches], num_threads=1)
        return [ids if one != " " else [blank] for one, ids in zip(stretches, found)]

    return Pair(encode_a, encode_b, Side.of(listed_a), Side.of(listed_b), identity_map(listed_a, listed_b))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(counts.sum())), counts


def _same_bytes(side: Side, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Which stretches the tokens give back byte by byte."""
    owner = np.repeat(np.arange(len(counts)), counts)
    length = np.bincount(owner, side.lengths[ids], len(counts)).astype(np.int64)
    good = length == np.diff(borders)
    made = side.bytes_of(ids[good[owner]])
    real = data[ranges(borders[:-1][good], length[good])]
    wrong = np.flatnonzero(made != real)
    if len(wrong):
        ends = np.cumsum(length[good])
        good[np.flatnonzero(good)[np.unique(np.searchsorted(ends, wrong, side="right"))]] = False
    return good


@dataclass
class Aligned:
    """Per stretch: whether it is given back, numbers of tokens, groups and links, and its links as pairs of ids."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    texts: np.ndarray


def _joined_ids(ids: np.ndarray, ends: np.ndarray, last: str) -> list[str]:
    """The digits of each token with what follows it: ``last`` after the last one of a group."""
    names = list(map(str, ids.tolist()))
    return [name + last if end else name + "," for name, end in zip(names, ends.tolist())]


def align(units: pa.Array, pair: Pair) -> Aligned:
    """Groups and links of each distinct stretch, all at once: offsets run on from stretch to stretch."""
    borders = np.frombuffer(units.buffers()[1], np.int64)[units.offset : units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2], np.uint8) if len(units) and borders[-1] else np.zeros(0, np.uint8)
    listed = units.to_pylist()
    (ids_a, n_a), (ids_b, n_b) = _flat(pair.encode_a(listed)), _flat(pair.encode_b(listed))
    good = _same_bytes(pair.a, ids_a, n_a, data, borders) & _same_bytes(pair.b, ids_b, n_b, data, borders)
    ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
    n_a, n_b = n_a * good, n_b * good
    owner_a = np.repeat(np.arange(len(n_a)), n_a)
    end_a, end_b = np.cumsum(pair.a.lengths[ids_a]), np.cumsum(pair.b.lengths[ids_b])
    start_a, start_b = end_a - pair.a.lengths[ids_a], end_b - pair.b.lengths[ids_b]
    closes_a, closes_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
    first = np.searchsorted(end_b, start_a, side="right")
    links = np.searchsorted(start_b, end_a, side="left") - first
    pairs = np.repeat(ids_a, links) * len(pair.b.lengths) + ids_b[ranges(first, links)]
    n_groups = np.bincount(owner_a, closes_a, len(n_a)).astype(np.int64)
    # Of each group the A tokens, then the B tokens.
    group_a = np.cumsum(closes_a) - closes_a
    group_b = np.cumsum(closes_b) - closes_b
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    written_ids = _joined_ids(ids_a, closes_a, "|") + _joined_ids(ids_b, closes_b, ";")
    tokens = list(map(written_ids.__getitem__, order.tolist()))
    cuts = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    texts = np.empty(len(n_a), object)
    texts[:] = ["".join(tokens[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
    return Aligned(good, n_a, n_b, n_groups, np.bincount(owner_a, links, len(n_a)).astype(np.int64), pairs, texts)


def _sums(values: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Sums per owner in whole numbers; owners come in order."""
    running = np.concatenate([[0], np.cumsum(values)])
    cuts = np.searchsorted(owner, np.arange(size + 1))
    return running[cuts[1:]] - running[cuts[:-1]]


_COLUMNS = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK = (
    "block bigint, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
    "n_links array<bigint>, digests array<string>, pairs binary, held binary, sizes binary, places binary, times binary"
)


def _align_blocks(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, limit: int) -> Iterator[pa.RecordBatch]:
    """One row per block: its documents, its distinct pairs with the number of its documents that hold each, and for each
    document which of these pairs it holds how often."""
    pair = tokenizer_pair(path_a, path_b)
    task, made = TaskContext.get().partitionId(), 0
    for batch in slices(batches, "text", limit):
        texts = pc.fill_null(batch.column("text"), "")
        docs = len(texts)
        filled = np.flatnonzero(pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        units, ids, per_text = stretches(texts.take(pa.array(filled)))
        one = align(units, pair)
        per_doc = np.zeros(docs, np.int64)
        per_doc[filled] = per_text
        owner = np.repeat(np.arange(docs), per_doc)
        good = _sums(~one.good[ids], owner, docs) == 0
        ids, owner = ids[good[owner]], owner[good[owner]]
        sums = [_sums(values[ids], owner, docs) for values in (one.n_a, one.n_b, one.n_groups, one.n_links)]
        cuts = np.searchsorted(owner, np.arange(docs + 1))
        digests = [
            hashlib.sha256("".join(one.texts[ids[x:y]])[:-1].encode()).hexdigest() if x < y else ""
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())
        ]
        # Each distinct stretch of a document once, with its number; then the pairs of these.
        key, number = np.unique(owner * max(len(units), 1) + ids, return_counts=True)
        holder, unit = key // max(len(units), 1), key % max(len(units), 1)
        pairs, place = np.unique(one.pairs, return_inverse=True)
        starts = np.cumsum(one.n_links) - one.n_links
        at = ranges(starts[unit], one.n_links[unit])
        key = np.repeat(holder, one.n_links[unit]) * max(len(pairs), 1) + place[at]
        times = np.repeat(number, one.n_links[unit])
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
        times = np.add.reduceat(times, first) if len(key) else times
        key = key[first]
        holder, place = key // max(len(pairs), 1), key % max(len(pairs), 1)
        # Stretches that are not given back leave no links; those of documents left out are held by none.
        held = np.bincount(place, minlength=len(pairs))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([(task << 32) | made], pa.int64()),
                pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                *(pa.array([values.tolist()], pa.list_(pa.int64())) for values in sums),
                pa.array([digests], pa.list_(pa.string())),
                pa.array([pack(pairs)], pa.binary()),
                pa.array([pack_numbers(held)], pa.binary()),
                pa.array([pack_numbers(np.bincount(holder, minlength=docs))], pa.binary()),
                pa.array([pack_numbers(place)], pa.binary()),
                pa.array([pack_numbers(times)], pa.binary()),
            ],
            names=["block", "doc_ids", *_COLUMNS, "digests", "pairs", "held", "sizes", "places", "times"],
        )
        made += 1


def _explained(pairs: np.ndarray, same: np.ndarray, width: int) -> np.ndarray:
    return same[pairs // width] == pairs % width


def _identity_counts(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """One vector as long as the vocabulary for all blocks of the task; what is not zero leaves it."""
    pair = tokenizer_pair(path_a, path_b)
    width = len(pair.b.lengths)
    vector = np.zeros(len(pair.same), np.int64)
    for batch in batches:
        for row in rows_of(batch):
            pairs, held = unpack(row["pairs"], np.int64), unpack_numbers(row["held"])
            regular = _explained(pairs, pair.same, width)
            vector[pairs[regular] // width] += held[regular]
    ids = np.flatnonzero(vector)
    yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(vector[ids])], names=["a", "n"])


def _ask_pairs(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, parts: int) -> Iterator[pa.RecordBatch]:
    pair = tokenizer_pair(path_a, path_b)
    for batch in batches:
        for row in rows_of(batch):
            pairs, held = unpack(row["pairs"], np.int64), unpack_numbers(row["held"])
            odd = ~_explained(pairs, pair.same, len(pair.b.lengths))
            pairs, held = pairs[odd], held[odd]
            asked = list(dealt(part_of(mix(pairs), parts), parts))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in asked], pa.int32()),
                    pa.array([row["block"]] * len(asked), pa.int64()),
                    pa.array([pack(pairs[mine]) for _, mine in asked], pa.binary()),
                    pa.array([pack_numbers(held[mine]) for _, mine in asked], pa.binary()),
                ],
                names=["part", "block", "pairs", "held"],
            )


def _count_pairs(width: int):
    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        pairs = [unpack(r["pairs"], np.int64) for r in rows]
        whole, place = np.unique(np.concatenate(pairs), return_inverse=True)
        places = np.split(place, np.cumsum([len(one) for one in pairs])[:-1])
        total, _ = added(places, [unpack_numbers(r["held"]) for r in rows], len(whole))
        ids, first = np.unique(whole // width, return_index=True)
        best = np.maximum.reduceat(total, first)
        listed = [{"a": int(a), "n": int(n)} for a, n in zip(ids, best)]
        return pa.table(
            {
                "block": pa.array([r["block"] for r in rows], pa.int64()),
                "part": pa.array([r["part"] for r in rows], pa.int32()),
                "totals": pa.array([pack_numbers(total[one]) for one in places], pa.binary()),
                "best": pa.array(
                    [listed if k == 0 else [] for k in range(len(rows))],
                    pa.list_(pa.struct([("a", pa.int32()), ("n", pa.int64())])),
                ),
            }
        )

    return count


_RESULT = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _report(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str, parts: int, shared) -> Iterator[pa.RecordBatch]:
    pair, (identity, best) = tokenizer_pair(path_a, path_b), shared.value
    width = len(pair.b.lengths)
    for batch in batches:
        for row in rows_of(batch):
            pairs = unpack(row["pairs"], np.int64)
            regular = _explained(pairs, pair.same, width)
            count = np.zeros(len(pairs), np.int64)
            count[regular] = identity[pairs[regular] // width]
            odd = np.flatnonzero(~regular)
            answers = {one["part"]: one["totals"] for one in row["answers"] or ()}
            for p, mine in dealt(part_of(mix(pairs[odd]), parts), parts):
                count[odd[mine]] = unpack_numbers(answers[p])
            top = count == best[pairs // width]
            place, times = unpack_numbers(row["places"]), unpack_numbers(row["times"])
            sizes = unpack_numbers(row["sizes"])
            owner = np.repeat(np.arange(len(sizes)), sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    *(pa.array(row[name], pa.int64()) for name in _COLUMNS),
                    pa.array(_sums(times * top[place], owner, len(sizes))),
                    pa.array(_sums(times * count[place], owner, len(sizes))),
                    pa.array(row["digests"], pa.string()),
                ],
                names=["doc_id", *_COLUMNS, "n_best", "count_sum", "groups_sha256"],
            )


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """At most one row per id."""
    table = rows.toArrow()
    out = np.zeros(size, np.int64)
    out[table.column("a").to_numpy()] = table.column("n").to_numpy()
    return out


def align_tokens(
    docs: DataFrame,
    path_a: str | None = None,
    path_b: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each document."""
    spark = docs.sparkSession
    paths = path_a or default_vocabulary(), path_b or default_pieces()
    pair = tokenizer_pair(*paths)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    blocks, table = stored_blocks(map_arrow(picked, _align_blocks, _BLOCK, *paths, block_bytes), buckets)
    try:
        with few_rows_at_once(spark):
            narrow = blocks.select("block", "pairs", "held")
            sums = map_arrow(narrow, _identity_counts, "a int, n bigint", *paths).groupBy("a").agg(F.sum("n").alias("n"))
            identity = _vector(sums, len(pair.same))
            asked = map_arrow(narrow, _ask_pairs, "part int, block bigint, pairs binary, held binary", *paths, buckets)
            schema = "block bigint, part int, totals binary, best array<struct<a: int, n: bigint>>"
            counted = written(asked.groupBy("part").applyInArrow(_count_pairs(len(pair.b.lengths)), schema), "pairs")
            best = counted.select(F.inline("best")).groupBy("a").agg(F.max("n").alias("n"))
            best = np.maximum(identity, _vector(best, len(pair.same)))
            shared = spark.sparkContext.broadcast((identity, best))
            ready = with_answers(blocks, counted, "answers", "totals")
            return written(
                map_arrow(ready, _report, f"doc_id bigint, {_RESULT}", *paths, buckets, shared), "aligned"
            )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
