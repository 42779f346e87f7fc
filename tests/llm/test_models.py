"""Perplexity bands, Katz scores and mixing: exact normalisation, brute force, and held-out behaviour."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortflow.llm import lm, mixing, quality
from cohortflow.llm.queries import domain

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def features_brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {p + k for p in range(len(w) - 2) if windows[tuple(w[p : p + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def test_features_and_verdicts(messy, messy_docs):
    rows = quality.verdicts(messy_docs).collect()
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    found = Counter((r.doc_id, *(r[k] for k in names)) for r in rows)
    assert found == Counter((doc, *features_brute(text)) for doc, text, *_ in messy)
    for r in rows:
        inside = r.surprise is None or r.low is None or r.low <= r.surprise <= r.high
        assert r.kept == (not r.base_failed and inside)


def test_model_sums_to_one_after_every_context():
    grams, _ = quality._grams(pa.array(["the cat sat on the mat, the end", "a cat ##!! ÄÖ 12\n", "", None] * 3))
    model = quality.build_model(*np.unique(grams, return_counts=True))
    contexts = {int(g) >> quality.BITS for g in grams} | {12345, 0}
    for context in list(contexts)[:60]:
        every = (np.uint32(context) << np.uint32(quality.BITS)) + np.arange(1, 64, dtype=np.uint32)
        assert math.isclose(model.probability(every).sum(), 1, rel_tol=1e-9)


class PlainKneserNey:
    """Interpolated modified Kneser-Ney over classes of bytes, by n-gram in dictionaries."""

    def __init__(self, texts):
        self.counts = [None, Counter(), Counter(), Counter(), Counter()]
        for text in texts:
            classes = [0, 0, 0, *(int(quality.CLASSES[b]) for b in (text or "").encode())]
            self.counts[4].update(tuple(classes[k : k + 4]) for k in range(len(classes) - 3))
        for order in (3, 2, 1):
            # Lower orders count in how many longer n-grams they are the end.
            self.counts[order] = Counter(gram[1:] for gram in self.counts[order + 1])
        self.discounts = [None]
        for order in range(1, 5):
            n = [0, *(sum(c == k for c in self.counts[order].values()) for k in range(1, 5))]
            cut = [0.0, 0.5, 0.5, 0.5]
            if n[1] and n[2]:
                y = n[1] / (n[1] + 2 * n[2])
                for k in (1, 2, 3):
                    if n[k] and n[k + 1]:
                        cut[k] = min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05)
            self.discounts.append(cut)

    def probability(self, gram):
        if not gram:
            return 1 / 63
        counts, cut = self.counts[len(gram)], self.discounts[len(gram)]
        after = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        lower = self.probability(gram[1:])
        if not after:
            return lower
        given = sum(cut[min(c, 3)] for c in after) / sum(after)
        c = counts.get(gram, 0)
        return (c - cut[min(c, 3)] if c else 0.0) / sum(after) + given * lower


def packed(gram):
    out = 0
    for one in gram:
        out = out << quality.BITS | one
    return out


def test_model_is_modified_kneser_ney():
    rng = random.Random(7)
    texts = ["".join(rng.choices("aab cD1.é\n", k=rng.randrange(0, 60))) for _ in range(25)] + [None, ""]
    grams, _ = quality._grams(pa.array(texts))
    model, plain = quality.build_model(*np.unique(grams, return_counts=True)), PlainKneserNey(texts)
    asked = list(plain.counts[4]) + [tuple(rng.randrange(0, 64) for _ in range(3)) + (rng.randrange(1, 64),) for _ in range(150)]
    asked += [gram[:3] + (rng.randrange(1, 64),) for gram in list(plain.counts[4])[:100]]
    found = model.probability(np.array([packed(g) for g in asked], np.uint32))
    assert np.allclose(found, [plain.probability(g) for g in asked], rtol=1e-9)


def test_bands_are_median_and_deviation_by_number_of_words(spark):
    """Surprise, bands and verdicts of every document, from the plain model and sorted values."""
    rng = random.Random(12)
    parts = {"en": ["the", "and", "er", "in"], "de": ["der", "ung", "ein", "sch"]}
    rows = []
    for k in range(36):
        lang = ["en", "de"][k % 2]
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(30, 90)))
        rows.append((k, text.upper() if k in (8, 9) else text, lang))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    found = {r.doc_id: r for r in quality.verdicts(frame).collect()}
    grams, borders = quality._grams(pa.array([t for _, t, _ in rows]))
    model, _ = quality.build_model(*np.unique(grams, return_counts=True)), None
    surprise = {k: -np.log(model.probability(grams[borders[k] : borders[k + 1]])).mean() for k in range(len(rows))}
    for lang in ("en", "de"):
        base = [k for k, t, other in rows if other == lang and not features_brute(t)[-1]]
        assert len(base) > 5
        middle = np.median([surprise[k] for k in base])
        unit = 1.4826 * np.median([abs(surprise[k] - middle) * math.sqrt(len(rows[k][1].split())) for k in base])
        for k in (k for k, _, other in rows if other == lang):
            assert found[k].surprise == pytest.approx(surprise[k], abs=1e-5)
            half = max(unit / math.sqrt(len(rows[k][1].split())), quality.LEAST_DEVIATION) * quality.WIDTH
            half *= 1 + quality.SMALL / math.sqrt(len(base))
            low, high = middle - half, middle + half
            assert found[k].low == pytest.approx(low, abs=0.02 * half + 2e-3)
            assert found[k].high == pytest.approx(high, abs=0.02 * half + 2e-3)
            near = min(abs(surprise[k] - low), abs(surprise[k] - high)) < 0.02 * half + 2e-3
            assert near or found[k].kept == (k in base and low <= surprise[k] <= high)


def test_model_counts_whole_texts(spark):
    texts = ["ab" * 40_000 + "xyz", None, "", "q"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    model = quality.fit_model(docs)
    grams, _ = quality._grams(pa.array(texts))
    whole = quality.build_model(*np.unique(grams, return_counts=True))
    assert all((a == b).all() for a, b in zip(model.grams, whole.grams))
    assert all(np.allclose(a, b) for a, b in zip(model.probs, whole.probs))


def test_n_grams_of_a_slice_take_little_memory():
    """Megabytes of text that come in one batch are not blown up all at once."""
    rng = random.Random(31)
    texts = pa.array([" ".join(f"w{rng.randrange(5000)}" for _ in range(300)) for _ in range(4500)])
    size = sum(len(one.as_py().encode()) for one in texts)
    assert size > 6 << 20
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    tracemalloc.start()
    try:
        counted = list(quality._count([batch]))
        counting = tracemalloc.get_traced_memory()[1]
        model = quality.build_model(*(np.concatenate([b.column(k).to_numpy() for b in counted]) for k in range(2)))
        tracemalloc.reset_peak()
        described = list(quality._describe([batch], SimpleNamespace(value=model)))
        describing = tracemalloc.get_traced_memory()[1]
        tracemalloc.reset_peak()
        shares = mixing._features(texts, np.zeros(0, np.uint64))
        sharing = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.column("n").to_numpy().sum() for b in counted) == size
    assert sum(b.num_rows for b in described) == len(shares) == len(texts)
    assert counting < 64 << 20 and describing < 96 << 20 and sharing < 96 << 20


def test_odd_texts_fall_outside_their_language(spark):
    rng = random.Random(2)
    parts = ["the", "and", "er", "in", "tion", "ou", "st", "re"]
    plain = [" ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(200)) for _ in range(120)]
    odd = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(200)) for _ in range(4)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(plain + odd)], "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == set(range(120))


def test_junk_shapes_fall_outside_and_good_texts_of_any_length_stay(spark):
    rng = random.Random(5)
    parts = ["the", "and", "er", "in", "tion", "ou", "st", "re"]

    def word():
        return "".join(rng.choices(parts, k=rng.randrange(1, 4)))

    good = [" ".join(word() for _ in range(n)) for n in (50, 60, 80, 120, 200, 400, 1500, 6000) for _ in range(40)]
    # Each shape in a part of the text's words; the others are as in good texts.
    junk = [
        " ".join(word().upper() + "!!" if k < 120 else word() for k in range(1500)),
        " ".join(word() + rng.choice(["***", "$$$", "&&&"]) * (k % 15 == 0) for k in range(1500)),
        " ".join(word() + " |" * (k % 20 == 0) for k in range(1500)),
    ]
    texts = [(k, t, "en") for k, t in enumerate(good + junk)]
    kept = {r.doc_id for r in quality.keep_good(spark.createDataFrame(texts, "doc_id bigint, text string, lang string")).collect()}
    assert kept == set(range(len(good)))


def test_kept_documents_keep_all_columns(messy_docs, no_docs):
    assert quality.keep_good(messy_docs).columns == messy_docs.columns
    assert quality.keep_good(no_docs).count() == 0


class Katz:
    """Bigram Katz model by dictionaries."""

    def __init__(self, texts, factors):
        self.words, self.pairs = Counter(), Counter()
        for text in texts:
            w = [*WORD.findall(ascii_lower(text or "")), None]
            self.words.update(w)
            self.pairs.update(zip([("start",), *w], w))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.factors = factors
        self.after = defaultdict(Counter)
        for (h, w), c in self.pairs.items():
            self.after[h][w] = c

    def simple(self, w):
        return (self.words[w] + 1) / (self.n + self.v + 1)

    def chance(self, h, w):
        seen = self.after.get(h)
        if not seen:
            return self.simple(w)
        total = sum(seen.values())
        kept = sum(self.factors.get(c, 1.0) * c for c in seen.values())
        if total - kept < 1e-9 * total:
            total += 1
        if w in seen:
            return self.factors.get(seen[w], 1.0) * seen[w] / total
        left = (total - kept) / total
        return left / (1 - sum(map(self.simple, seen))) * self.simple(w)


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2


@pytest.mark.parametrize("parts", [3, 11])
def test_katz_scores(spark, messy, messy_docs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rows = lm.katz_scores(messy_docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    train = [t for d, t, *_ in messy if not held(d)]
    plain = Katz(train, {})
    times = Counter(plain.pairs.values())
    factors = lm.discounts(np.array([times[r] for r in range(1, lm.DISCOUNTED + 2)]))
    model = Katz(train, {r: factors[r] for r in range(1, lm.DISCOUNTED + 1)})
    expected = []
    for doc, text, *_ in messy:
        w = [*WORD.findall(ascii_lower(text or "")), None]
        base = sum(math.log10(model.simple(x)) for x in w)
        score = sum(math.log10(model.chance(h, x)) for h, x in zip([("start",), *w], w))
        expected.append((doc if doc is not None else -1, held(doc), len(w), sum(x in model.words for x in w), model.n, base, score))
    found = sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in rows)
    for a, b in zip(found, sorted(expected), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9)


def test_katz_contexts_sum_to_one():
    factors = lm.discounts(np.array([50, 20, 10, 6, 4, 3]))
    assert all(0 < f < 1 for f in factors[1:])
    model = Katz(["a b a c a b b", "a a a a a a a a a a", "c"], {r: factors[r] for r in range(1, 6)})
    for h in [("start",), "a", "b", "c", "never"]:
        total = sum(model.chance(h, w) for w in model.words) + model.chance(h, "unknown word")
        assert math.isclose(total, 1, rel_tol=1e-12)


def test_katz_backoff_of_stats():
    factors = lm.discounts(np.array([50, 20, 10, 6, 4, 3]))
    stats = np.array([[0, 0, 0, 0, 0, 0, 0], [2, 1, 0, 0, 0, 10, 30], [0, 0, 0, 0, 0, 9, 50]])
    divisor, weight = lm.backoff(stats, factors, 100)
    assert divisor.tolist() == [0, 10, 10] and weight[0] == 1
    assert math.isclose(weight[2], (1 / 10) / 0.5)


def test_katz_of_nothing(spark, no_docs):
    assert lm.katz_scores(no_docs).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    rows = {r.doc_id: r for r in lm.katz_scores(docs, F.lit(True)).collect()}
    assert rows[1].n_known == 0 and rows[1].train_tokens == 0 and rows[1].score == 0 and rows[2].n_tokens == 1


def test_packed_arrays():
    for array in (np.zeros(0, np.uint64), np.arange(1000, dtype=np.uint64) * 2**40, np.array([3], np.uint32)):
        assert (lm.unpack(lm.pack(array), array.dtype) == array).all()
        assert (lm.unpack(lm.pack(array, 1), array.dtype, 1) == array // 256 * 256).all()
    assert lm.unpack_counts(lm.pack_counts(np.array([1, 1 << 40]))).tolist() == [1, 1 << 40]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for k in range(600):
        kind = rng.choices(["good", "poor", "toxic"], [6, 2, 2])[0]
        w = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(20, 120))]
        if kind == "toxic":
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["vile", "rotten", "nasty."])
        text = " ".join(x.upper() + "!!" for x in w) if kind == "poor" else " ".join(w)
        docs.append((k, text, kind))
        if k % 2:
            labels.append((k, 0 if kind == "poor" else 1, 1 if kind == "toxic" else 0))
    docs += [(700, None, None), (701, "", None), (None, "w1 w2", None), docs[5], docs[5]]
    labels += [(None, 1, 0), (9999, 1, 0), (1, None, None)]
    return (
        spark.createDataFrame(docs, "doc_id bigint, text string, rate string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"),
    )


def test_mixture_meets_its_targets(labelled):
    docs, labels = labelled
    weights = {"good": 0.8, "poor": 0.2, "toxic": 0.0}
    rows = mixing.mix_to_targets(docs, labels, domain(), weights, "good").collect()
    assert len(rows) == docs.count()
    totals = {k: sum(r.rate * r.n_tokens * r[f"p_{k}"] for r in rows) for k in weights}
    for k, share in weights.items():
        assert abs(totals[k] / sum(totals.values()) - share) < 0.01
    held_out = [r for r in rows if r.doc_id is not None and r.doc_id % 2 == 0 and r.doc_id < 600]
    truth = {r.doc_id: r.rate for r in docs.collect()}
    assert sum(r.domain == truth[r.doc_id] for r in held_out) / len(held_out) > 0.9
    sure = [r for r in rows if r.p_good > 0.999]
    assert sure and all(abs(r.rate - 1) < 0.01 for r in sure)
    assert all(r.rate < 0.2 for r in rows if r.p_toxic > 0.99)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)


def test_copies_are_taken(labelled):
    docs, labels = labelled
    mixed = mixing.mix_to_targets(docs, labels, domain(), {"good": 0.4, "poor": 0.6, "toxic": 0.0}, "good")
    taken = mixing.take_copies(docs, mixed)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r.copies for r in mixed.collect())
    assert max(r.copies for r in mixed.collect()) > 1


def test_rates_stay_nonnegative_and_fit(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 200, 400)
    frame = spark.createDataFrame(
        [(int(a), *map(float, b)) for a, b in zip(n, p)], "n_tokens bigint, p0 double, p1 double, p2 double"
    )
    targets = np.array([0.7, 0.2, 0.1]) * float(n.sum())
    rate, _, totals = mixing.fit_rates(frame, targets)
    got = np.array([r[0] for r in frame.select(rate).collect()])
    assert (got >= 0).all()
    assert np.allclose((got * n) @ p, targets, rtol=1e-2) and np.allclose((got * n) @ p, totals)


@pytest.mark.parametrize("targets", [(0.6, 0.3, 0.1), (0.05, 0.05, 0.9)])
def test_rates_miss_no_more_than_least_squares_must(spark, targets):
    """Against nonnegative least squares one document at a time, also where no rates reach the targets."""
    rng = np.random.default_rng(9)
    p = rng.dirichlet([1.5, 1.5, 0.4], 80)
    p[:, 2] = np.minimum(p[:, 2], 0.5)
    p /= p.sum(axis=1, keepdims=True)
    n = rng.integers(1, 300, 80).astype(float)
    wanted = np.array(targets) * n.sum()
    frame = spark.createDataFrame(
        [(int(a), *map(float, b)) for a, b in zip(n, p)], "n_tokens bigint, p0 double, p1 double, p2 double"
    )
    _, _, totals = mixing.fit_rates(frame, wanted)
    white = np.linalg.inv(np.linalg.cholesky((p * n[:, None]).T @ p))
    a, b = (p * n[:, None]) @ white.T, white @ wanted
    rate, miss = np.ones(80), a.sum(axis=0) - b
    for _ in range(1000):
        for i in range(80):
            new = max(0.0, rate[i] - a[i] @ miss / (a[i] @ a[i]))
            miss += (new - rate[i]) * a[i]
            rate[i] = new
    # Where the targets are out of reach, steps end once they hardly change the totals.
    assert np.linalg.norm(white @ (totals - wanted)) <= np.linalg.norm(miss) * 1.06 + 2e-3 * np.linalg.norm(b)


def test_copies_follow_the_rates(labelled):
    docs, labels = labelled
    rows = mixing.mix_to_targets(docs, labels, domain(), {"good": 0.55, "poor": 0.35, "toxic": 0.1}, "good").collect()
    part = np.array([r.rate - math.floor(r.rate) for r in rows])
    off = sum(r.copies for r in rows) - sum(r.rate for r in rows)
    assert abs(off) <= 4 * math.sqrt((part * (1 - part)).sum()) + 1
    assert len({r.missed for r in rows}) == 1 and rows[0].missed < 0.01
    # Nobody has enough of what is not there.
    none = mixing.mix_to_targets(docs.where("rate = 'good'"), labels, domain(), {"good": 0.5, "poor": 0.5, "toxic": 0.0}, "good")
    assert none.first().missed > 0.1


def test_mixing_columns_may_clash(messy, messy_docs, labelled):
    _, labels = labelled
    named = messy_docs.withColumnRenamed("n_chars", "rate").withColumnRenamed("lang", "p_good").withColumn("n_tokens", F.lit("x"))
    mixed = mixing.mix_to_targets(named, labels, domain(), {"good": 0.9, "poor": 0.1, "toxic": 0.0}, "good")
    assert mixed.count() == len(messy)
    assert mixing.take_copies(named, mixed).columns == named.columns


def test_mixing_without_labels_or_documents(labelled, no_docs):
    docs, labels = labelled
    weights = {"good": 0.8, "poor": 0.2, "toxic": 0.0}
    rows = mixing.mix_to_targets(docs, labels.limit(0), domain(), weights, "good").collect()
    assert {(r.domain, r.copies) for r in rows} == {("good", 1)}
    assert mixing.mix_to_targets(no_docs, labels, domain(), weights, "good").count() == 0
