"""Phrases mined from all texts by set-oriented, relational steps (SETM), with exact counts and scores.

Method: the relation of occurrences (piece, position, word), sorted, is made once and stored. Group-counting finds the
frequent words; occurrences of other words leave the relation (a semi-join with the frequent groups). The relation is then merge-joined
with itself by piece and adjacent position: occurrences of a group of ``k`` words at neighbouring positions make one of
``k + 1`` words. Counting and semi-joining come again before each longer length.

How it runs: the relation is cut into blocks of one language, in document order, so that neighbours are rows side by side
and the merge-join reads the arrays of a block once. A block asks for the counts of its own distinct groups
(:mod:`cohortflow.llm.asking`). Groups have exact names, never hashes: a word is known by its text and then by the
number that its count partition gave it, a longer group by the numbers of the two groups it was joined from. The first
block that asked for a frequent group reports it, with its text and the counts of all its parts. Which shorter phrases a longer one replaces
follows from the reports by one anti-join, and the best of each language from a ranking inside salted slices, so
a language with a third of all phrases is not sorted in one task.

Defined results: a missing language is ``und``. A missing or empty text has no pieces. Repeated rows are separate documents and
count each time. A language without any candidate has no rows. Ties follow score, count and the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow.llm.arrays import hash_texts, mix, pack, unpack
from cohortflow.llm.asking import (
    added,
    dealt,
    pack_numbers,
    pair_hashes,
    part_of,
    rows_of,
    stored_blocks,
    unpack_numbers,
    with_answers,
)
from cohortflow.llm.frames import broadcast_if_small, few_rows_at_once, map_arrow, written

BLOCK_BYTES = 6 << 20
# Texts that a task holds while it fills the blocks of several languages.
HELD_BYTES = 2 * BLOCK_BYTES
# Slices of a ranking that one task brings together.
FAN_IN = 4
UNKNOWN = "und"
BLANKS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"
_KINDS = np.zeros(256, np.uint8)
_KINDS[list(BLANKS)] = 1
_KINDS[list(BREAKS)] = 2
# A group's number: its length, its count partition, and its place among the frequent groups there.
_LEVEL, _PART = 56, 32


def pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words in byte order, each occurrence as a place among them, and the number of words of each piece."""
    texts = pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string())).cast(pa.large_binary())
    borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    data, borders = data[borders[0] : borders[-1]], borders - borders[0]
    kinds = _KINDS[data]
    inside = kinds == 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = borders[:-1][np.diff(borders) > 0]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    small = np.int32 if len(data) < 1 << 31 else np.int64
    # Texts and breaks before a word tell its piece.
    piece = np.cumsum(kinds == 2, dtype=small)[starts] + np.searchsorted(borders, starts, side="right")
    offsets = np.append(np.cumsum(inside, dtype=small)[starts] - 1, np.count_nonzero(inside)).astype(np.int64)
    flat = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
    )
    coded = flat.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    first = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]])) if len(piece) else np.zeros(0, int)
    return coded.dictionary.take(order), place[coded.indices.to_numpy()], np.diff(np.append(first, len(piece)))


def _join_words(words: pa.Array) -> bytes:
    """No word holds a line break."""
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words.to_pylist()))


def _split_words(data: bytes) -> pa.Array:
    whole = zstandard.ZstdDecompressor().decompress(data)
    return pa.array(whole.split(b"\n") if whole else [], pa.large_binary())


_BLOCK = "block bigint, lang string, n bigint, vocabulary binary, ids binary, sizes binary"


def _relation(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Blocks of one language each, of about ``limit`` bytes of text."""
    task, made = TaskContext.get().partitionId(), 0
    held: dict[str, list[pa.Array]] = {}
    size: dict[str, int] = {}

    def block(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal made
        del size[lang]
        vocabulary, ids, sizes = pieces(pa.chunked_array(held.pop(lang)).combine_chunks())
        if len(ids):
            row = [(task << 32) | made, lang, len(ids), _join_words(vocabulary), pack(ids.astype(np.uint32)), pack_numbers(sizes)]
            made += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([one]) for one in row[:3]] + [pa.array([one], pa.binary()) for one in row[3:]],
                names=["block", "lang", "n", "vocabulary", "ids", "sizes"],
            )

    for batch in batches:
        texts = batch.column("text").cast(pa.large_string())
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        for lang in pc.unique(batch.column("lang")).to_pylist():
            mine = np.flatnonzero(pc.equal(batch.column("lang"), lang).to_numpy(zero_copy_only=False))
            group = (size.get(lang, 0) + np.cumsum(lengths[mine])) // limit
            for some in np.split(mine, np.flatnonzero(np.diff(group)) + 1):
                held.setdefault(lang, []).append(texts.take(pa.array(some)))
                size[lang] = size.get(lang, 0) + int(lengths[some].sum())
                if size[lang] >= limit:
                    yield from block(lang)
        while sum(size.values()) > HELD_BYTES * limit // BLOCK_BYTES:
            yield from block(max(size, key=size.get))
    for lang in list(size):
        yield from block(lang)


_ANSWER = "block bigint, part int, totals binary, ranks binary, owns binary"


def _answers(rows: list[dict], parts_of: list[np.ndarray], total: np.ndarray, owns: list[np.ndarray], least: int) -> pa.Table:
    """For each message and each of its keys: the total or 0, the place among frequent keys, and who reports it."""
    total = np.where(total >= least, total, 0)
    rank = np.cumsum(total > 0) - 1
    packed = [
        (
            pack_numbers(total[place]),
            pack(rank[place[total[place] > 0]].astype(np.uint32)),
            pack(np.packbits(own)),
        )
        for place, own in zip(parts_of, owns)
    ]
    return pa.table(
        {
            "block": pa.array([r["block"] for r in rows], pa.int64()),
            "part": pa.array([r["part"] for r in rows], pa.int32()),
            **{
                name: pa.array([one[k] for one in packed], pa.binary())
                for k, name in enumerate(("totals", "ranks", "owns"))
            },
        }
    )


def _word_parts(vocabulary: pa.Array, lang: str, parts: int) -> np.ndarray:
    salt = hash_texts(pa.array([lang.encode()], pa.large_binary()))[0]
    return part_of(mix(hash_texts(vocabulary) ^ salt), parts)


def _ask_words(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in rows_of(batch):
            vocabulary = _split_words(row["vocabulary"])
            counts = np.bincount(unpack(row["ids"], np.uint32), minlength=len(vocabulary))
            for part, mine in dealt(_word_parts(vocabulary, row["lang"], parts), parts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([row["lang"]], pa.string()),
                        pa.array([_join_words(vocabulary.take(pa.array(mine)))], pa.binary()),
                        pa.array([pack_numbers(counts[mine])], pa.binary()),
                    ],
                    names=["part", "block", "lang", "words", "counts"],
                )


def _count_words(least: int):
    def count(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (r["lang"], r["block"]))
        places, size = [], 0
        by_lang: dict[str, list[pa.Array]] = {}
        for r in rows:
            by_lang.setdefault(r["lang"], []).append(_split_words(r["words"]))
        for listed in by_lang.values():
            coded = pa.concat_arrays(listed).dictionary_encode()
            place, at = coded.indices.to_numpy().astype(np.int64) + size, 0
            for one in listed:
                places.append(place[at : at + len(one)])
                at += len(one)
            size += len(coded.dictionary)
        total, owns = added(places, [unpack_numbers(r["counts"]) for r in rows], size)
        return _answers(rows, places, total, owns, least)

    return count


class Relation:
    """The occurrences of a block: for each length the frequent groups, and at each position the group that starts there.

    ``group[k - 1][p]`` is the place of the group of ``k`` words at position ``p`` among the groups that the block asked
    for, or -1 where that group is not frequent. ``total``, ``name`` and ``owned`` belong to the groups asked for, and
    ``first`` is a position of each.
    """

    def __init__(self, row: dict, parts: int):
        self.row, self.parts = row, parts
        self.ids = unpack(row["ids"], np.uint32).astype(np.int32)
        sizes = unpack_numbers(row["sizes"])
        self.piece_ends = np.zeros(len(self.ids), bool)
        self.piece_ends[np.cumsum(sizes) - 1] = True
        self.vocabulary = _split_words(row["vocabulary"])
        self.total, self.name, self.owned, self.group, self.first = [], [], [], [], []
        self._settle(self.ids, _word_parts(self.vocabulary, row["lang"], parts), None, row["answers1"])
        level = 2
        while f"answers{level}" in row:
            at, keys, place, first = self.joined()
            self._settle(place, part_of(self.key_hashes(keys), parts), at, row[f"answers{level}"], first)
            level += 1

    def _settle(self, place: np.ndarray, part: np.ndarray, at: np.ndarray | None, answers: list, first=None) -> None:
        """Takes in the answers for the groups of the next length, and drops occurrences of groups that are not frequent."""
        level = len(self.total) + 1
        found = {one["part"]: one for one in answers or ()}
        total, name = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        owned = np.zeros(len(part), bool)
        for p, mine in dealt(part, self.parts):
            one = found[p]
            total[mine] = unpack_numbers(one["totals"])
            owned[mine] = np.unpackbits(unpack(one["owns"], np.uint8), count=len(mine))
            frequent = mine[total[mine] > 0]
            name[frequent] = (level << _LEVEL) | (p << _PART) | unpack(one["ranks"], np.uint32).astype(np.int64)
        group = np.full(len(self.ids), -1, np.int32)
        keep = total[place] > 0
        group[keep if at is None else at[keep]] = place[keep]
        for held, one in zip((self.total, self.name, self.owned, self.group, self.first), (total, name, owned, group, first)):
            held.append(one)

    def joined(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The merge-join of the sorted relation with itself at neighbouring positions of a piece.

        Returns the positions, the distinct joined groups as pairs of places, the group at each position, and one
        position of each group.
        """
        group = self.group[-1]
        both = (group[:-1] >= 0) & (group[1:] >= 0)
        if len(self.group) == 1:
            # Longer groups that share words lie in one piece anyhow.
            both &= ~self.piece_ends[:-1]
        at = np.flatnonzero(both)
        size = len(self.total[-1])
        keys = group[at].astype(np.int64) * size + group[at + 1]
        keys, first, place = np.unique(keys, return_index=True, return_inverse=True)
        return at, np.stack([keys // max(size, 1), keys % max(size, 1)]), place.astype(np.int32), at[first]

    def key_hashes(self, keys: np.ndarray) -> np.ndarray:
        name = self.name[-1]
        return pair_hashes(name[keys[0]], name[keys[1]])


def _ask_groups(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in rows_of(batch):
            relation = Relation(row, parts)
            _, keys, place, _ = relation.joined()
            counts, name = np.bincount(place, minlength=keys.shape[1]), relation.name[-1]
            for part, mine in dealt(part_of(relation.key_hashes(keys), parts), parts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([pack(name[keys[0][mine]])], pa.binary()),
                        pa.array([pack(name[keys[1][mine]])], pa.binary()),
                        pa.array([pack_numbers(counts[mine])], pa.binary()),
                    ],
                    names=["part", "block", "left", "right", "counts"],
                )


def _count_groups(least: int):
    def count(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        left = [unpack(r["left"], np.int64) for r in rows]
        ends = np.cumsum([len(one) for one in left])
        left, right = np.concatenate(left), np.concatenate([unpack(r["right"], np.int64) for r in rows])
        order = np.lexsort((right, left))
        new = np.ones(len(order), bool)
        new[1:] = (left[order[1:]] != left[order[:-1]]) | (right[order[1:]] != right[order[:-1]])
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        places = np.split(place, ends[:-1])
        total, owns = added(places, [unpack_numbers(r["counts"]) for r in rows], int(new.sum()))
        return _answers(rows, places, total, owns, least)

    return count


_CANDIDATE = "lang string, size int, name bigint, phrase string, a bigint, l array<bigint>, r array<bigint>, covered array<bigint>"


def _report(batches: Iterator[pa.RecordBatch], parts: int, cover_percent: int) -> Iterator[pa.RecordBatch]:
    """The frequent groups of two words or more that a block is the first to hold."""
    for batch in batches:
        for row in rows_of(batch):
            relation = Relation(row, parts)
            words = relation.vocabulary.cast(pa.large_string())
            for size in range(2, len(relation.total) + 1):
                total, name = relation.total[size - 1], relation.name[size - 1]
                mine = np.flatnonzero(relation.owned[size - 1] & (total > 0))
                if len(mine) == 0:
                    continue
                at, a = relation.first[size - 1][mine], total[mine]

                def part_totals(length: int, offset: int) -> tuple[np.ndarray, np.ndarray]:
                    place = relation.group[length - 1][at + offset]
                    return relation.total[length - 1][place], relation.name[length - 1][place]

                left = np.stack([part_totals(k, 0)[0] for k in range(1, size)], axis=1)
                right = np.stack([part_totals(size - k, k)[0] for k in range(1, size)], axis=1)
                inner = [part_totals(k, o) for k in range(2, size) for o in range(size - k + 1)]
                covered = np.stack([n for _, n in inner], axis=1) if inner else np.zeros((len(a), 0), np.int64)
                # Exact while counts stay below 2 ** 56.
                hit = np.stack([100 * a >= cover_percent * t for t, _ in inner], axis=1) if inner else covered > 0
                listed = [words.take(pa.array(relation.ids[at + k])) for k in range(size)]
                phrase = pc.binary_join_element_wise(*listed, pa.scalar(" ", pa.large_string()))
                cuts = pa.array(np.arange(len(a) + 1, dtype=np.int32) * (size - 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["lang"]] * len(a), pa.string()),
                        pa.array(np.full(len(a), size, np.int32)),
                        pa.array(name[mine]),
                        phrase.cast(pa.string()),
                        pa.array(a),
                        pa.ListArray.from_arrays(cuts, pa.array(left.reshape(-1))),
                        pa.ListArray.from_arrays(cuts, pa.array(right.reshape(-1))),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(hit.sum(axis=1))]).astype(np.int32)), pa.array(covered[hit])
                        ),
                    ],
                    names=["lang", "size", "name", "phrase", "a", "l", "r", "covered"],
                )


def weakest_cut(scale: int = 1_000_000) -> Column:
    """``score, k, l, r`` of the cut with the lowest score, the first of several. Exact for counts below 10 ** 15."""
    a = "cast(a as decimal(15,0))"
    score = f"cast({scale} as decimal(7,0)) * {a} * {a} div (cast(x.l as decimal(15,0)) * cast(x.r as decimal(15,0)))"
    return F.expr(
        f"array_min(transform(arrays_zip(l, r), (x, i) -> struct({score} as score, i + 1 as k, x.l as l, x.r as r)))"
    )


def best_of_each(df: DataFrame, group: str, order: list[Column], keep: int, salt: Column) -> DataFrame:
    """The first ``keep`` rows of each group, as ``rank`` from 1.

    They are the first of the first ones of salted slices, ``FAN_IN`` of which are brought together at a time, so no task ranks
    more than ``FAN_IN * keep`` rows of a group after the first step.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = df.withColumn("salt", F.pmod(salt, F.lit(slices)))
    while True:
        rest = rest.withColumn("slice", F.col("salt") % slices)
        ranked = rest.withColumn("rank", F.row_number().over(Window.partitionBy(group, "slice").orderBy(*order)))
        ranked = ranked.where(F.col("rank") <= keep).drop("slice")
        if slices == 1:
            return ranked.drop("salt")
        rest, slices = ranked.drop("rank"), -(-slices // FAN_IN)


def mine_phrases(
    docs: DataFrame,
    least: int = 10,
    longest: int = 3,
    keep: int = 2000,
    cover_percent: int = 50,
    text_column: str = "text",
    lang_column: str = "lang",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of two to ``longest`` words of each language.

    A phrase needs ``least`` occurrences, and gives way to a longer candidate that holds it and has at least
    ``cover_percent`` of its occurrences.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = 2 * buckets
    picked = docs.select(
        F.col(text_column).alias("text"), F.coalesce(F.col(lang_column).cast("string"), F.lit(UNKNOWN)).alias("lang")
    )
    blocks, table = stored_blocks(map_arrow(picked, _relation, _BLOCK, block_bytes), buckets)
    try:
        with few_rows_at_once(spark):
            asked = map_arrow(blocks, _ask_words, "part int, block bigint, lang string, words binary, counts binary", parts)
            counted = written(asked.groupBy("part").applyInArrow(_count_words(least), _ANSWER), "words")
            ready = with_answers(blocks, counted, "answers1", "totals", "ranks", "owns")
            for size in range(2, longest + 1):
                schema = "part int, block bigint, left binary, right binary, counts binary"
                asked = map_arrow(ready, _ask_groups, schema, parts)
                counted = written(asked.groupBy("part").applyInArrow(_count_groups(least), _ANSWER), f"groups{size}")
                ready = with_answers(ready, counted, f"answers{size}", "totals", "ranks", "owns")
            found = written(map_arrow(ready, _report, _CANDIDATE, parts, cover_percent), "phrases")
        sizes = written(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    covered = found.select(F.explode("covered").alias("name")).distinct()
    left = found.drop("covered").join(covered.hint("shuffle_merge"), "name", "left_anti")
    scored = left.withColumn("cut", weakest_cut()).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "name")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    best = best_of_each(scored, "lang", order, keep, F.xxhash64("name"))
    named = best.join(broadcast_if_small(sizes), "lang")
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
