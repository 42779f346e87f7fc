"""Alignment of two tokenizers against whole texts encoded by the libraries and compared token by token."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from cohortflow.llm import alignment
from cohortflow.llm.alignment import default_pieces
from cohortflow.llm.tokens import byte_alphabet, default_vocabulary, stretches

ODD = [
    "a ", " ", "  ", " lead", "a  b   c", "tab\there \t there", "line\n\n  next", "don't they'll  'tis", "x▁y", "café au lait",
    "<|endoftext|> plain <s> </s> <unk>", "日本語 テキスト with 漢字", "🤷🏽‍♀️ emoji ‍ joined", " nbsp　wide", "a" * 700, "=" * 40 + " " + "-=" * 30,
    "\x00nul \x1c sep", "é ́x", "ﬁn ① Ａ", "1234567890 3.14159", "x" + " " * 50 + "y", "\r\n \r\n", "ends with é",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(default_vocabulary())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=default_pieces())
    alphabet = byte_alphabet()
    bytes_a = {k: bytes(alphabet[c] for c in token) for token, k in a.get_vocab(with_added_tokens=False).items() if all(c in alphabet for c in token)}
    bytes_b = [
        bytes([int(b.id_to_piece(k)[1:-1], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
        for k in range(b.get_piece_size())
    ]
    return a, b, bytes_a, bytes_b


def tokens_of(libraries, text):
    a, b, bytes_a, bytes_b = libraries
    if not text:
        return [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a[k] for k in ids_a) != whole or b"".join(bytes_b[k] for k in ids_b) != whole:
        return [], []
    return ids_a, ids_b


def brute(libraries, texts):
    *_, bytes_a, bytes_b = libraries
    held, out = Counter(), []
    for text in texts:
        ids_a, ids_b = tokens_of(libraries, text)
        spans_a, spans_b = [], []
        for ids, sizes, spans in ((ids_a, bytes_a, spans_a), (ids_b, bytes_b, spans_b)):
            end = 0
            for k in ids:
                spans.append((end, end + len(sizes[k]), k))
                end = spans[-1][1]
        links = []
        j = 0
        for start, stop, k in spans_a:
            while j < len(spans_b) and spans_b[j][1] <= start:
                j += 1
            i = j
            while i < len(spans_b) and spans_b[i][0] < stop:
                links.append((k, spans_b[i][2]))
                i += 1
        held.update(set(links))
        ends = sorted({e for _, e, _ in spans_a} & {e for _, e, _ in spans_b})
        groups, start = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(k) for s, e, k in spans if start <= s and e <= end) for spans in (spans_a, spans_b)) if len(ends) < 2000 else None)
            start = end
        out.append((len(ids_a), len(ids_b), len(ends), links, groups))
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    rows = []
    for n_a, n_b, n_groups, links, groups in out:
        digest = "" if not n_a else None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest()
        rows.append((n_a, n_b, n_groups, len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), digest))
    return rows


def test_stretches_encode_as_the_whole_text(libraries, messy):
    a, b, *_ = libraries
    rng = random.Random(3)
    alphabet = list(" \t\n.,'abcAB12é漢▁=") + ["  ", " the", "n't"]
    texts = ODD + [t for _, t, *_ in messy if t] + ["".join(rng.choices(alphabet, k=rng.randrange(1, 60))) for _ in range(1500)]
    pair = alignment.tokenizer_pair(default_vocabulary(), default_pieces())
    units, ids, per_text = stretches(pa.array(texts))
    listed = units.to_pylist()
    found_a, found_b = pair.encode_a(listed), pair.encode_b(listed)
    cuts = np.concatenate([[0], np.cumsum(per_text)])
    for k, text in enumerate(texts):
        mine = ids[cuts[k] : cuts[k + 1]]
        assert "".join(listed[i] for i in mine) == " " + text
        assert [x for i in mine for x in found_a[i]] == a.encode(" " + text, add_special_tokens=False).ids
        assert [x for i in mine for x in found_b[i]] == b.encode(text)


def test_identity_map(libraries):
    *_, bytes_a, bytes_b = libraries
    same = alignment.tokenizer_pair(default_vocabulary(), default_pieces()).same
    for k, one in bytes_a.items():
        assert bytes_b[same[k]] == one if same[k] >= 0 else one not in bytes_b


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_alignment(spark, libraries, messy, block):
    texts = ODD + [None, "", ODD[5], ODD[5]] + [t for _, t, *_ in messy if t is None or len(t) < 3000]
    rows = [(k, t, "x", "y") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block string, pairs string").repartition(3)
    found = alignment.align_tokens(docs, block_bytes=block).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == list(range(len(texts)))
    for row, one, text in zip(found, brute(libraries, texts), texts):
        assert tuple(row)[1:] == one, text


def test_long_text_and_missing_id(spark, libraries, messy):
    texts = [t for _, t, *_ in messy if t and len(t) > 20_000]
    rows = [(None, t) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(tuple(r)[1:7] for r in alignment.align_tokens(docs).collect())
    assert found == sorted(one[:6] for one in brute(libraries, texts))


def test_no_rows(no_docs):
    found = alignment.align_tokens(no_docs)
    assert found.columns[0] == "doc_id" and found.count() == 0
