"""Packing and training order: every id in exactly one place, and back again."""

import os
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortflow.llm import packing, tokens, training_order
from cohortflow.llm.tokens import default_vocabulary, encoder
from cohortflow.session import scratch_path


@pytest.fixture(scope="module")
def public():
    return Tokenizer.from_file(default_vocabulary())


def test_ids_are_those_of_the_vocabulary(public, messy):
    encode = encoder(default_vocabulary())
    odd = ["<|endoftext|> in a text <|endoftext|>", "don't  \n\n stop\t\x00 ", "数字 ١٢٣ 🤷🏽‍♀️", "a" * 3000, "  lead"]
    for text in [t for _, t, *_ in messy if t] + odd:
        assert encode(text) == public.encode(text, add_special_tokens=False).ids


def test_token_counts_are_those_of_whole_texts(public, messy):
    rng = random.Random(4)
    odd = ["<|endoftext|> in <|endoftext|>", " lead", "a  b \n\n c", "it's  ok", "数字 ١٢٣", "", None, "é é", " "]
    odd += ["".join(rng.choices(" \t\nab.'é漢1", k=rng.randrange(1, 40))) for _ in range(800)]
    texts = odd + [t for _, t, *_ in messy]
    expected = [len(public.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert tokens.token_counts(pa.array(texts), default_vocabulary()).tolist() == expected


@pytest.mark.parametrize(
    "targets", [None, {"a": 0.25, "b": 0.25, "c": 0.25, "": 0.25}, {"a": 0.9, "b": 0.1, "c": 0.0}]
)
def test_packing(public, messy, messy_docs, targets):
    rows = packing.pack(messy_docs, targets=targets, length=256, quantum=32, with_ids=True).collect()
    pieces = defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and r.length > 0
        assert zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id].append(r)
    expected = defaultdict(Counter)
    for doc, text, *_ in messy:
        ids = [*public.encode(text or "", add_special_tokens=False).ids, 0]
        for k, one in enumerate(ids):
            expected[doc][(k, one, len(ids))] += 1
    for doc, found in pieces.items():
        got = Counter()
        for r in found:
            for k, one in enumerate(np.frombuffer(r.ids, "<u4")):
                got[(r.start + k, int(one), r.doc_tokens)] += 1
        assert got == expected[doc]
    assert set(pieces) == set(expected)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    assert set(places) == set(range(len(places)))
    filled = []
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        filled.append(end)
    assert max(filled) <= 256
    # At most one short quantum per source, and the last window.
    assert sum(f < 256 for f in filled) <= 5 and sum(filled) > 256 * (len(filled) - 2)


def test_windows_hold_the_target_proportions(spark):
    rng = random.Random(4)
    docs = [(k, "word " * rng.randrange(1, 400), "abc"[min(k % 5, 2)]) for k in range(300)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").repartition(6)
    targets = {"a": 0.5, "b": 0.25, "c": 0.25}
    rows = packing.pack(frame, targets=targets, length=256, quantum=32).collect()
    shares = defaultdict(Counter)
    for r in rows:
        shares[r.sequence_id][r.source] += r.length
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.length
    # Until the first source runs dry every window has the proportions.
    windows = int(min(sizes[s] / (256 * w) for s, w in targets.items())) - 1
    assert windows > 20
    for k in range(windows):
        assert all(abs(shares[k][s] - 256 * w) <= 32 for s, w in targets.items())
    total = Counter()
    for k in range(windows):
        total.update(shares[k])
        assert all(abs(total[s] - 256 * w * (k + 1)) <= 64 for s, w in targets.items())


def test_turns_are_those_of_a_service_by_due_time():
    rng = random.Random(6)
    totals = {s: rng.randrange(1, 3000) for s in "abcdefg"} | {"z": 0}
    for targets in (None, {s: rng.random() for s in "abcdef"}):
        plan = packing.Schedule(totals, targets, 128, 16)
        due = []
        for k, name in enumerate(plan.names):
            for j in range(int(plan.quanta[k])):
                due.append(((bool(plan.late[k]), Fraction(2 * j + 1, int(plan.weights[k])), name), k, j))
        for turn, (_, k, j) in enumerate(sorted(due)):
            assert plan.turns(k, np.array([j]))[0] == turn


def test_nothing_to_pack(no_docs):
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 10, 257, 4096, 10_007])
def test_slots_are_a_permutation(count):
    numbers = np.arange(count)
    slots = training_order.permute(numbers, count, 99)
    assert sorted(slots) == list(range(count))
    assert (training_order.permute(slots, count, 99, back=True) == numbers).all()
    if count > 100:
        assert (slots != training_order.permute(numbers, count, 100)).any()
        assert abs(np.corrcoef(numbers, slots)[0, 1]) < 0.2


def plain_slot(number, count, key):
    """The slot of one number, by plain integers: rounds on two halves, again until it is below the count."""

    def scramble(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 % 2**64
        x ^= x >> 27
        x = x * 0x94D049BB133111EB % 2**64
        return x ^ (x >> 31)

    half = 1
    while 4**half < count:
        half += 1
    while True:
        left, right = divmod(number, 2**half)
        for turn in range(1, 7):
            round_key = scramble((turn * 0x9E3779B97F4A7C15 % 2**64) ^ key)
            left, right = right, left ^ (scramble(right ^ round_key) % 2**half)
        number = left * 2**half + right
        if number < count:
            return number


@pytest.mark.parametrize("count", [1, 2, 5, 64, 65, 1000])
def test_slots_follow_from_the_key(count):
    expected = [plain_slot(n, count, 20240607) for n in range(count)]
    assert training_order.permute(np.arange(count), count, 20240607).tolist() == expected


def test_training_order(spark, public, messy, messy_docs):
    sizes = {"length": 32, "per_shard": 64}
    folder = scratch_path(spark, "order")
    count, shards = training_order.write_training_order(messy_docs, folder, 5, **sizes)
    rows = training_order.read_training_order(shards, count, 5, at_once=10, **sizes).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(count))
    assert [plain_slot(r.sequence_id, count, 5) for r in rows] == list(range(count))
    assert all(r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.n_tokens for r in rows)
    assert sum(r.n_tokens < 32 for r in rows) <= messy_docs.rdd.getNumPartitions()
    # Put back in their own order, the sequences of a task are its documents one after the other.
    stream = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(rows, key=lambda r: r.sequence_id)])
    found = Counter(tuple(map(int, one)) for one in np.split(stream, np.flatnonzero(stream == 0) + 1) if len(one))
    assert found == Counter(
        (*public.encode(t or "", add_special_tokens=False).ids, 0) for _, t, *_ in messy if "\x00" not in (t or "")
    )
    late = training_order.read_training_order(shards, count, 5, first_slot=count // 2, at_once=7, **sizes)
    assert sorted(r.slot for r in late.collect()) == list(range(count // 2, count))


def test_records_lie_at_their_offsets(spark, messy_docs):
    """Raw files of whole records: any slot is read by one seek, without Spark."""
    folder = scratch_path(spark, "order")
    count, shards = training_order.write_training_order(messy_docs, folder, 5, length=32, per_shard=64)
    local = folder.removeprefix("file:")
    listed = sorted(shards.collect())
    assert sorted(os.listdir(local)) == [os.path.basename(r.path) for r in listed]
    assert [(r.shard, r.n) for r in listed] == [(k, min(64, count - 64 * k)) for k in range(-(-count // 64))]
    assert all(os.path.getsize(r.path.removeprefix("file:")) == r.n * 68 for r in listed)
    paths = {r.shard: r.path.removeprefix("file:") for r in listed}
    for row in training_order.read_training_order(shards, count, 5, length=32, per_shard=64).collect():
        ids = np.frombuffer(row.ids, "<u4")
        with open(paths[row.shard], "rb") as file:
            file.seek(row.offset)
            record = file.read(68)
        assert int.from_bytes(record[:4], "little") == row.n_tokens
        assert np.frombuffer(record, "<u2", row.n_tokens, 4).tolist() == ids.tolist()
        assert not any(record[4 + 2 * row.n_tokens :])
        if row.slot % 37 == 0:
            assert training_order.read_record(folder, row.slot, 32, 64).tolist() == ids.tolist()


def test_training_order_of_nothing(spark, no_docs):
    folder = scratch_path(spark, "order")
    count, shards = training_order.write_training_order(no_docs, folder, 5)
    assert count == 0 and shards.count() == 0
    assert training_order.read_training_order(shards, 0, 5).count() == 0


def test_token_table_counts_from_the_start_of_its_task(messy_docs):
    rows = tokens.token_table(messy_docs, default_vocabulary(), source_column="source").collect()
    streams = defaultdict(list)
    for r in rows:
        streams[(r.part, r.source)].append((r.start, r.n))
    for found in streams.values():
        end = 0
        for start, n in sorted(found):
            assert start == end
            end += n
