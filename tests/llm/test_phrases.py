"""Phrases against counting by hand."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortflow.llm import phrases

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, least, longest, keep, cover=50):
    """(lang, rank, phrase, a, l, r, n, score), from every run of words of every piece."""
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = tuple(re.findall("[^ \t]+", piece))
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for p in range(len(words) - k + 1):
                    f[lang, words[p : p + k]] += 1
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    out = []
    for (lang, g), a in found.items():
        inside = [
            b
            for (other, longer), b in found.items()
            if other == lang and len(longer) > len(g) and any(longer[o : o + len(g)] == g for o in range(len(longer)))
        ]
        if any(100 * b >= cover * a for b in inside):
            continue
        cuts = []
        for k in range(1, len(g)):
            left, right = f[lang, g[:k]], f[lang, g[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, -score, -a, " ".join(g).encode(), left, right))
    listed = []
    for lang in {one[0] for one in out}:
        for rank, (_, score, a, g, left, right) in enumerate(sorted(x for x in out if x[0] == lang)[:keep], 1):
            listed.append((lang, rank, g.decode(), -a, left, right, n[lang], -score))
    return sorted(listed)


TEXTS = [
    "New York, new york city; in New York City",
    "the cat sat on the mat. The cat sat on the hat! the cat",
    "a a a a a a a\ta  a",
    "one\rtwo one two\x0bone two one two?one two",
    "x\x1cy x\x1cy q nbsp here q nbsp here É é É é É é",
    "...,,;;",
    "same same, same same",
    "the cat sat on the mat",
]


@pytest.mark.parametrize("least, longest, keep, block", [(2, 3, 2000, 1 << 20), (2, 5, 6, 60), (3, 2, 4, 200)])
def test_phrases(spark, least, longest, keep, block):
    rows = [(k, text, [None, "en", "de", "und"][k % 4]) for k, text in enumerate(TEXTS * 3)]
    rows += [(None, None, "en"), (77, "", None), (78, TEXTS[1], "en"), (78, TEXTS[1], "en"), (79, TEXTS[0], "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    found = phrases.mine_phrases(docs, least, longest, keep, block_bytes=block)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, least, longest, keep)


def test_phrases_of_messy_rows(messy, messy_docs):
    found = phrases.mine_phrases(messy_docs, least=4, block_bytes=20_000)
    assert sorted(tuple(r) for r in found.collect()) == brute(messy, 4, 3, 2000)


def test_no_rows(no_docs):
    found = phrases.mine_phrases(no_docs)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and found.count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 10**15 - 1
    rows = [(big, [big], [big]), (3 * 10**14 + 7, [5 * 10**14 + 1, 3 * 10**14 + 9], [9 * 10**14 + 5, 9 * 10**14 + 5]), (5, [5, 5], [5, 5])]
    frame = spark.createDataFrame(rows, "a bigint, l array<bigint>, r array<bigint>")
    for row in frame.select("*", phrases.weakest_cut().alias("cut")).collect():
        cuts = [(10**6 * row.a**2 // (x * y), k, x, y) for k, (x, y) in enumerate(zip(row.l, row.r), 1)]
        assert tuple(row.cut) == min(cuts)


def test_best_of_each_keeps_ties_in_order(spark):
    frame = spark.range(500).select(F.lit("g").alias("g"), (F.col("id") % 3).alias("s"), F.col("id"))
    order = [F.col("s").desc(), F.col("id")]
    best = phrases.best_of_each(frame, "g", order, 40, F.xxhash64("id")).orderBy("rank").collect()
    assert [(r["rank"], r["id"]) for r in best] == [(k, 2 + 3 * (k - 1)) for k in range(1, 41)]
