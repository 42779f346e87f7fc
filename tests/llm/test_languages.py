"""Languages against a plain model of the same kind, and accuracy on texts that were held out."""

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import languages
from cohortflow.llm.queries import QUERIES


def words_of(text):
    out = []
    for word in (text or "").replace("\x0b", " ").replace("\x0c", " ").split(" "):
        for one in word.replace("\t", "\n").replace("\r", "\n").split("\n"):
            kept = "".join(c for c in one.lower() if unicodedata.category(c)[0] in "LM")
            if any(unicodedata.category(c)[0] == "L" for c in kept):
                out.append(kept)
    return out


class Plain:
    """Counts by n-gram itself, without slots."""

    def __init__(self, rows):
        self.n, self.d = defaultdict(Counter), defaultdict(Counter)
        for text, lang in rows:
            self.n[lang]
            for word in words_of(text):
                for gram in self.grams(word):
                    for k in range(1, 5):
                        self.n[lang][gram[-k:]] += 1
                        self.d[lang][gram[-k:-1]] += 1

    def grams(self, word):
        symbols = bytes([1, 1, 1]) + word.encode() + bytes([0])
        return [symbols[i : i + 4] for i in range(len(symbols) - 3)]

    def log(self, word, lang):
        total = 0.0
        for gram in self.grams(word):
            p = 1 / 256
            for k in range(1, 5):
                p = (self.n[lang][gram[-k:]] + 4 * p) / (self.d[lang][gram[-k:-1]] + 4)
            total += math.log(p)
        return total


def plain_mixture(logs, counts, columns, rounds):
    share = {c: 1 / len(columns) for c in columns}
    total = sum(counts.values())
    for _ in range(rounds if len(columns) > 1 else 0):
        new = dict.fromkeys(columns, 0.0)
        for word, n in counts.items():
            top = max(logs[word][c] for c in columns)
            part = {c: share[c] * math.exp(logs[word][c] - top) for c in columns}
            for c in columns:
                new[c] += n * part[c] / sum(part.values())
        share = {c: x / total for c, x in new.items()}
    log = 0.0
    for word, n in counts.items():
        top = max(logs[word][c] for c in columns)
        log += n * (top + math.log(sum(share[c] * math.exp(logs[word][c] - top) for c in columns)))
    return share, log


def plain_prediction(model, text):
    langs = sorted(model.n)
    counts = Counter(words_of(text))
    if not counts or not langs:
        return "und", 0.0, {}
    logs = {w: {c: model.log(w, c) for c in langs} for w in counts}
    free, _ = plain_mixture(logs, counts, langs, languages.ROUNDS)
    order = sorted(langs, key=lambda c: -free[c])
    best, shares = -math.inf, {}
    for k in range(1, len(langs) + 1):
        share, log = plain_mixture(logs, counts, order[:k], languages.ROUNDS)
        worth = log - (k - 1) * 0.5 * math.log(sum(counts.values()))
        if worth <= best:
            break
        best, shares = worth, share
    top = max(langs, key=lambda c: shares.get(c, 0.0))
    return top, free[top], shares


SPEECH = {
    "en": "the quick brown fox jumps over lazy dogs while seven wizards brew strong tea for this evening and nobody minds",
    "de": "der schnelle braune fuchs springt über faule hunde während sieben zauberer starken tee brauen für diesen abend",
    "fr": "le rapide renard brun saute par dessus les chiens paresseux pendant que sept sorciers préparent un thé très fort",
}


def speak(rng, lang, n):
    return " ".join(rng.choice(SPEECH[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(8)
    rows = [(k, speak(rng, lang, rng.randrange(5, 40)).title(), lang) for k, lang in enumerate(["en", "de", "fr"] * 25)]
    rows += [(100 + k, speak(rng, "en", 30) + " " + speak(rng, "fr", 20), None) for k in range(5)]
    rows += [(200, None, "en"), (201, "", "de"), (202, "12 34 -- !!", "fr"), (203, "Привет, мир", None), (204, "́́ 5", "en")]
    rows += [(None, speak(rng, "de", 9), "de"), rows[0], rows[0], (205, "x " * 900 + speak(rng, "de", 4), "en")]
    return rows


def test_against_a_plain_model(spark, corpus, monkeypatch):
    # So many slots that hardly any n-grams share one.
    monkeypatch.setattr(languages, "MOST_BITS", 20)
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string, lang string").repartition(4)
    held = F.col("doc_id") % 5 == 0
    found = languages.identify(docs, held).collect()
    model = Plain([(t, lang) for k, t, lang in corpus if lang is not None and t is not None and (k is None or k % 5)])
    expected = defaultdict(list)
    for k, text, _ in corpus:
        expected[k].append(plain_prediction(model, text))
    assert len(found) == len(corpus)
    for row in found:
        top, score, shares = expected[row.doc_id].pop()
        assert (row.lang_pred, row.held_out) == (top, row.doc_id is not None and row.doc_id % 5 == 0)
        assert row.score == pytest.approx(score, abs=1e-3) and set(row.languages) == set(shares)
        for lang, share in shares.items():
            assert row.languages[lang] == pytest.approx(share, abs=1e-3)


def test_mixed_texts_name_both_languages(spark, corpus):
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string, lang string")
    for row in languages.identify(docs).where("doc_id >= 100 and doc_id < 105").collect():
        assert row.lang_pred == "en" and set(row.languages) == {"en", "fr"}
        assert row.languages["en"] == pytest.approx(0.6, abs=0.06)


def test_probabilities_sum_to_one():
    rng = random.Random(2)
    table = languages.Model(["a"], 17, np.zeros((languages.TABLES << 17, 1), np.float32), np.zeros(1))
    for _ in range(200):
        word = pa.array(["".join(rng.choices("abc", k=rng.randrange(1, 6)))])
        slots, _ = languages.gram_slots(word, 17)
        for k, one in enumerate(slots):
            np.add.at(table.counts[:, 0], one + (k << 17), 1)
    table.symbols = table.counts[: 1 << 17].sum(axis=0)
    logs = [0.0]
    for first in "abc":
        listed = pa.array([first + "".join(x) for x in ("a", "b", "c")])
        logs.extend(table.word_logs(listed)[:, 0])
    # Words of two letters: their chance is at most one and they cannot hold all of it.
    assert 0 < sum(math.exp(x) for x in logs[1:]) < 1


def test_slots_fit_the_bound():
    for n in (0, 1, 4, 200, 5000):
        bits = languages.slot_bits(n)
        assert bits <= languages.MOST_BITS and (languages.TABLES * n * 4 << bits) <= languages.TABLE_BYTES


def test_messy_rows(messy_docs, messy):
    found = languages.identify(messy_docs).collect()
    assert len(found) == len(messy)
    assert {r.lang_pred for r in found if r.doc_id in (100, 101, 102, 103)} == {"und"}


def test_nothing_to_learn_from(spark, no_docs):
    assert languages.identify(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "words here", None), (2, None, "en")], "doc_id bigint, text string, lang string")
    assert {(r.doc_id, r.lang_pred, r.score) for r in languages.identify(docs).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op13_language_id"](spark, sf)
    labels = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", F.length("text").alias("size"))
    judged = found.join(labels, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert len(judged) > 150
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.98 * len(judged)
