"""Rows that every operator must bear: missing values, empty and long texts, repeats, and columns named like ours."""

import random

import pytest

DOCS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, `row` string, whole string, "
    "`lines` string, keep string, part string, node string, block string, copies string, `key` string"
)


def words(rng, n, vocabulary=40):
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def messy():
    """(doc_id, text, lang, source) of about 120 documents."""
    rng = random.Random(11)
    rows = []
    bases = [words(rng, n) for n in (12, 40, 90, 200, 400)]
    for k in range(60):
        text = rng.choice(bases).split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            text[rng.randrange(len(text))] = f"x{rng.randrange(1000)}"
        cut = rng.randrange(len(text))
        rows.append((k, " ".join(text[:cut]) + rng.choice(["\n", " ", "\r\n", "\t "]) + " ".join(text[cut:]), "en", "a"))
    for k in range(60, 90):
        lines = [rng.choice(["A shared line here", " a SHARED line here\t", "short", "", "another common line", words(rng, 5)]) for _ in range(rng.randrange(1, 90))]
        rows.append((k, "\n".join(lines), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None])))
    rows += [(100, None, "en", "a"), (101, "", None, None), (102, " \t\n ", "de", "b"), (103, "\n\n", "en", "a")]
    rows += [(104, "one two", "en", "a"), (105, "One  TWO", "en", "b"), (106, "one two three four five", "en", "a")]
    rows += [(107, words(rng, 30_000, 3000), "en", "a"), (108, "x " * 5000, "en", "c")]
    rows += [(109, "z\x1cq nbsp\u00a0here ünïcödé 😀 line\u2028sep", "fr", "a")]
    rows += [rows[5], rows[5], rows[70], (None, rows[3][1], "en", "a"), (None, "A shared line here\nmore of it all", None, "b")]
    rows += [(3, "same number as another document, but other words", "en", "a")]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def messy_docs(spark, messy):
    full = [(i, t, lang, s, 1, "r", "w", "l", "k", "p", "n", "b", "c", "y") for i, t, lang, s in messy]
    return spark.createDataFrame(full, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
