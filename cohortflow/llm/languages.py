"""Languages of whole texts, as the proportions of a mixture.

Method: each language has an n-gram model of its words: the bytes of a word's letters and its end, each after the three
before it, smoothed order by order with a Dirichlet prior. A text is a mixture of languages, word by word; expectation-maximisation
estimates its proportions from the likelihoods of its words. With all languages allowed it gives an order of them; then sets of the first
one, two, ... languages are fitted anew for as long as the likelihood, less half the logarithm of the number of words for each further
language, gets higher. The prediction is the language with the largest share in the chosen set; ``score`` is its share with all languages
allowed, so text in a language that was never learned scores low.

How it runs: each task counts the n-grams of the labelled texts by language and sends what it counted, once per n-gram.
N-grams are known by hashed slots, whose number follows from the number of languages, so that the tables that go to every
task have at most ``TABLE_BYTES``, however large the corpus; a language is one column of them. Distinct words of a slice of texts are judged
once, and a text's distinct words are its observations.

Defined results: Letters and marks make up the words, in lower case; other characters are left out. A missing text, or one without a
letter, is ``und`` with a score of 0, and so is every text where nothing was learned. Without an ID a document belongs to the training set.
A missing label teaches nothing. Equal shares go to the language that comes first. Repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.arrays import Words, batch_of, mix, ranges, slices
from cohortflow.llm.frames import map_arrow

UNKNOWN = "und"
ORDER = 4
START, END = 1, 0
SYMBOLS = 256
# Weight of the order below, in occurrences of the context.
PRIOR = 4.0
TABLE_BYTES = 256 << 20
MOST_BITS = 18
ROUNDS = 12
# Words of texts times languages that are estimated at once.
CELLS = 4 << 20
# Languages whose counts a task holds before it sends them.
HELD_LANGUAGES = 16
# Counts of n-grams of each order, then of the contexts of orders 2 and up; the context of order 1 is always the same.
TABLES = 2 * ORDER - 1


def slot_bits(languages: int) -> int:
    """So many slots of each table that all tables of all languages stay within ``TABLE_BYTES``."""
    bits = MOST_BITS
    while bits > 8 and (TABLES * max(languages, 1) * 4 << bits) > TABLE_BYTES:
        bits -= 1
    return bits


def letters(vocabulary: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of letters, and for each given word its place among them, or -1 without a letter."""
    kept = pc.replace_substring_regex(pc.utf8_lower(vocabulary.cast(pa.large_string())), r"[^\p{L}\p{M}]+", "")
    real = pc.match_substring_regex(kept, r"\p{L}").to_numpy(zero_copy_only=False)
    coded = kept.filter(pa.array(real)).dictionary_encode()
    place = np.full(len(vocabulary), -1, np.int64)
    place[real] = coded.indices.to_numpy()
    return coded.dictionary, place


def gram_slots(words: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The slot of each position of each word in each table, and the word of each position."""
    words = words.cast(pa.large_binary())
    borders = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8)[borders[0] : borders[-1]] if data is not None else np.zeros(0, np.uint8)
    lengths = np.diff(borders)
    pad = ORDER - 1
    whole = lengths + pad + 1
    begin = np.cumsum(whole) - whole
    symbols = np.full(int(whole.sum()), END, np.uint64)
    symbols[ranges(begin, np.full(len(words), pad))] = START
    symbols[ranges(begin + pad, lengths)] = data
    at = ranges(begin + pad, lengths + 1)
    out = np.empty((TABLES, len(at)), np.int64)
    gram = np.zeros(len(at), np.uint64)
    for k in range(ORDER):
        gram |= symbols[at - k] << np.uint64(8 * k)
        out[k] = mix(gram + (np.uint64(k + 1) << np.uint64(40))) >> np.uint64(64 - bits)
        if k:
            context = gram >> np.uint64(8)
            out[ORDER + k - 1] = mix(context + (np.uint64(ORDER + k) << np.uint64(40))) >> np.uint64(64 - bits)
    return out, np.repeat(np.arange(len(words)), lengths + 1)


_COUNTS = pa.schema([("lang", pa.string()), ("slot", pa.int32()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def sent() -> Iterator[pa.RecordBatch]:
        for lang, table in held.items():
            slot = np.flatnonzero(table)
            for at in range(0, len(slot), 200_000):
                some = slot[at : at + 200_000]
                yield batch_of(_COUNTS, [lang] * len(some), some.astype(np.int32), table[some])
        held.clear()

    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        listed, place = letters(words.vocabulary)
        slots, holder = gram_slots(listed, bits)
        slots += (np.arange(TABLES) << bits)[:, None]
        coded = batch.column("lang").dictionary_encode()
        spoken = place[words.ids]
        of = coded.indices.to_numpy(zero_copy_only=False)[words.owner()]
        for k, lang in enumerate(coded.dictionary.to_pylist()):
            mine = spoken[(of == k) & (spoken >= 0)]
            if len(mine) == 0:
                continue
            times = np.bincount(mine, minlength=len(listed))[holder]
            table = held.setdefault(lang, np.zeros(TABLES << bits, np.int64))
            for one in slots:
                table += np.bincount(one, times, TABLES << bits).astype(np.int64)
        if len(held) > HELD_LANGUAGES:
            yield from sent()
    yield from sent()


@dataclass
class Model:
    """``counts[slot, language]``, all tables one after the other, and the number of symbols of each language."""

    languages: list[str]
    bits: int
    counts: np.ndarray
    symbols: np.ndarray

    def word_logs(self, words: pa.Array) -> np.ndarray:
        """The log-likelihood of each word in each language."""
        slots, holder = gram_slots(words, self.bits)
        slots += (np.arange(TABLES) << self.bits)[:, None]
        out = np.zeros((len(words), len(self.languages)))
        # Some words at a time, so that memory does not grow with words times languages twice.
        step = max(CELLS // max(len(self.languages), 1), 1)
        for at in range(0, len(holder), step):
            some = slots[:, at : at + step]
            chance = np.full((some.shape[1], len(self.languages)), 1.0 / SYMBOLS)
            for k in range(ORDER):
                context = self.counts[some[ORDER + k - 1]] if k else self.symbols
                chance = (self.counts[some[k]] + PRIOR * chance) / (context + PRIOR)
            of = holder[at : at + step]
            first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            out[of[first]] += np.add.reduceat(np.log(chance), first, axis=0)
        return out


def learn(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> Model:
    """The model of all labelled texts."""
    labelled = docs.select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang"))
    labelled = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    # One row per label.
    languages = sorted(row["lang"] for row in labelled.select("lang").distinct().collect())
    bits = slot_bits(len(languages))
    counted = map_arrow(labelled, _count, "lang string, slot int, n bigint", bits)
    # At most as many rows as the tables have cells.
    table = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((TABLES << bits, len(languages)), np.float32)
    place = pc.index_in(table.column("lang"), pa.array(languages, pa.string())).to_numpy()
    counts[table.column("slot").to_numpy(), place] = table.column("n").to_numpy()
    symbols = counts[: 1 << bits].sum(axis=0, dtype=np.float64)
    return Model(languages, bits, counts, symbols)


def proportions(logs: np.ndarray, times: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in each text and the log-likelihood of these, by expectation-maximisation from equal shares.

    ``logs`` has a row per distinct word of a text and a column per language; ``first`` is the first row of each text.
    """
    size = np.diff(np.append(first, len(logs)))
    total = np.add.reduceat(times, first).astype(float)[:, None]
    top = logs.max(axis=1)
    ratio = np.exp(logs - top[:, None])
    share = np.full((len(first), logs.shape[1]), 1.0 / logs.shape[1])
    for _ in range(rounds if logs.shape[1] > 1 else 0):
        part = np.repeat(share, size, axis=0) * ratio
        part *= (times / part.sum(axis=1))[:, None]
        share = np.add.reduceat(part, first, axis=0) / total
    chance = (np.repeat(share, size, axis=0) * ratio).sum(axis=1)
    return share, np.add.reduceat(times * (np.log(chance) + top), first)


def chosen_sets(logs: np.ndarray, times: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Shares with all languages allowed, and shares in the set of languages with the best penalised likelihood."""
    free, _ = proportions(logs, times, first, rounds)
    order = np.argsort(-free, axis=1, kind="stable")
    size = np.diff(np.append(first, len(logs)))
    price = 0.5 * np.log(np.add.reduceat(times, first))
    best = np.full(len(first), -np.inf)
    shares = np.zeros_like(free)
    open_texts = np.arange(len(first))
    for k in range(1, logs.shape[1] + 1):
        rows = ranges(first[open_texts], size[open_texts])
        columns = order[open_texts, :k]
        some = np.take_along_axis(logs[rows], np.repeat(columns, size[open_texts], axis=0), axis=1)
        begin = np.cumsum(size[open_texts]) - size[open_texts]
        share, log = proportions(some, times[rows], begin, rounds)
        worth = log - (k - 1) * price[open_texts]
        better = worth > best[open_texts]
        open_texts = open_texts[better]
        if len(open_texts) == 0:
            break
        best[open_texts] = worth[better]
        shares[open_texts] = 0
        shares[open_texts[:, None], columns[better]] = share[better]
    return free, shares


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("languages", pa.map_(pa.string(), pa.float64())),
    ]
)


def _predict(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model: Model = model.value
    names = np.array([*model.languages, UNKNOWN], object)
    width = len(model.languages)
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        listed, place = letters(words.vocabulary)
        spoken = place[words.ids]
        owner = words.owner()[spoken >= 0]
        key, times = np.unique(owner * max(len(listed), 1) + spoken[spoken >= 0], return_counts=True)
        holder, word = key // max(len(listed), 1), key % max(len(listed), 1)
        docs = batch.num_rows
        top, score = np.full(docs, width), np.zeros(docs)
        mixed: list[list[tuple[str, float]]] = [[] for _ in range(docs)]
        if len(key) and width:
            logs = model.word_logs(listed)
            texts, first = np.unique(holder, return_index=True)
            group = first * width // CELLS
            for some in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(group)) + 1):
                lo, hi = first[some[0]], first[some[-1] + 1] if some[-1] + 1 < len(first) else len(key)
                free, shares = chosen_sets(logs[word[lo:hi]], times[lo:hi], first[some] - lo)
                best = shares.argmax(axis=1)
                top[texts[some]], score[texts[some]] = best, free[np.arange(len(some)), best]
                for text, row in zip(texts[some].tolist(), shares):
                    mixed[text] = [(names[k], float(row[k])) for k in np.flatnonzero(row)]
        yield batch_of(
            _RESULT, batch.column("doc_id"), batch.column("held_out"), names[top].tolist(), np.clip(score, 0.0, 1.0), mixed
        )


def identify(
    docs: DataFrame, held_out: Column | None = None, id_column="doc_id", text_column="text", lang_column="lang"
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages`` of each document; ``languages`` are the shares in the chosen set.

    The model learns from the labelled documents that are not ``held_out`` (an expression over ``doc_id``).
    """
    held_out = F.lit(False) if held_out is None else held_out
    picked = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.col(lang_column).cast("string").alias("lang"),
    ).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    model = learn(picked.where(~F.col("held_out")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double, languages map<string, double>"
    return map_arrow(picked.select("doc_id", "held_out", "text"), _predict, schema, shared)
