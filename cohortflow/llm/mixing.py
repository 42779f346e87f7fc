"""Document rates that bring a corpus to target weights of domains, with soft membership.

Method: a classifier fitted on the labelled rows gives each document a posterior over domains; projected-gradient
least squares over the whole corpus then finds a nonnegative rate for each document so that the expected tokens
of each domain, ``sum(rate * tokens * posterior)``, match the targets. The objective is the squared miss,
whitened by ``M = sum(tokens * p * p')``: in that metric the gradient of a document's rate is ``p' M^-1 (S - T)``
and a step of 1 is always safe. A document's rate depends only on its own posterior and the steps so far, so an
iteration is one sum over the documents, and nothing about documents is kept on the driver.

The classifier is fitted on at most ``fit_rows`` labelled documents, those with the smallest hash of their ID; it
uses the words that tell the domains apart and the shares of classes of bytes. Everything else covers all rows.

Defined results: a missing text has no tokens and adds nothing to any total; its rate is that of its posterior.
Labels without a domain, and labels of documents that are not there, are not used. A document with several labels
is used with the smallest domain name. Repeated rows are separate documents with the same rate. A domain without
labelled documents gets hardly any membership; without any labels all documents are of the anchor domain.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.arrays import Words, batch_of, hash_texts, signed, slices
from cohortflow.llm.frames import few_rows_at_once, map_arrow, with_rows, written
from cohortflow.llm.quality import CLASSES, GRAM_BYTES, TEXTS_AT_ONCE, _bytes_of
from cohortflow.llm.tokens import default_vocabulary, token_counts

FIT_ROWS = 10_000
WORDS_PER_DOMAIN = 200
LEAST_DOCUMENTS = 5
STEPS = 60
TOLERANCE = 1e-4
_TRIM = ".,;:!?\"'()[]"
# Features besides the presence of words.
_EXTRA = 68


def _vocabulary(texts: pa.Array) -> tuple[Words, np.ndarray]:
    """Lower-cased words and a hash of each vocabulary word without the marks around it."""
    words = Words(texts, lower=True)
    return words, hash_texts(pc.utf8_trim(words.vocabulary, _TRIM))


def _presence(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, word) pairs."""
    words, hashes = _vocabulary(texts)
    owner = words.owner()
    unique, dense = np.unique(hashes, return_inverse=True) if len(hashes) else (hashes, np.zeros(0, int))
    pair = np.unique(owner * max(len(unique), 1) + dense[words.ids]) if len(owner) else np.zeros(0, np.int64)
    return pair // max(len(unique), 1), unique[pair % max(len(unique), 1)]


def _domain_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("domain", pa.int32()), ("word", pa.int64()), ("n", pa.int64())])
    for batch in slices(batches, "text"):
        holder, word = _presence(batch.column("text"))
        domain = batch.column("domain").to_numpy().astype(np.int64)[holder]
        order = np.lexsort((word, domain))
        domain, word = domain[order], word[order]
        if len(word) == 0:
            continue
        first = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (domain[1:] != domain[:-1])]))
        n = np.diff(np.append(first, len(word)))
        yield batch_of(schema, domain[first].astype(np.int32), signed(word[first]), n)


def _byte_class_counts(texts: pa.Array) -> np.ndarray:
    """A row per document: how many of its bytes are of each class."""
    out = [np.zeros((0, 64), np.int64)]
    for batch in slices([pa.RecordBatch.from_arrays([texts], names=["text"])], "text", GRAM_BYTES):
        data, borders = _bytes_of(batch.column("text"))
        owner = np.repeat(np.arange(batch.num_rows), np.diff(borders))
        out.append(np.bincount(owner * 64 + CLASSES[data], minlength=batch.num_rows * 64).reshape(-1, 64))
    return np.concatenate(out)


def _features(texts: pa.Array, chosen: np.ndarray) -> np.ndarray:
    """A row per document: presence of the chosen words, roots of byte class shares, then the shares of
    distinct words and of words equal to the one before, the size, and a constant."""
    words, hashes = _vocabulary(texts)
    out = np.zeros((len(texts), len(chosen) + _EXTRA), np.float32)
    if len(chosen) and len(words):
        # Chosen words are looked up once per vocabulary word; few words of a text are among them.
        at = np.minimum(np.searchsorted(chosen, hashes), len(chosen) - 1)
        hit = np.flatnonzero((chosen[at] == hashes)[words.ids])
        out[words.owner()[hit], at[words.ids[hit]]] = 1
    shares = _byte_class_counts(texts)
    out[:, len(chosen) : len(chosen) + 64] = np.sqrt(shares / np.maximum(shares.sum(axis=1), 1)[:, None])
    size, owner = np.maximum(words.counts, 1), words.owner()
    distinct = np.unique(owner * max(len(words.vocabulary), 1) + words.ids) // max(len(words.vocabulary), 1)
    again = (words.ids[1:] == words.ids[:-1]) & (owner[1:] == owner[:-1])
    out[:, -4] = np.bincount(distinct, minlength=len(texts)) / size
    out[:, -3] = np.sqrt(np.bincount(owner[1:][again], minlength=len(texts)) / size)
    out[:, -2] = np.log1p(words.counts) / 8
    out[:, -1] = 1
    return out


def _fit_rows(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("domain", pa.int32()), ("features", pa.binary())])
    for batch in slices(batches, "text"):
        found = _features(batch.column("text"), chosen)
        packed = [one.astype(np.float16).tobytes() for one in found]
        yield batch_of(schema, batch.column("domain"), pa.array(packed, pa.binary()))


@dataclass
class Classifier:
    domains: list[str]
    chosen: np.ndarray
    weights: np.ndarray

    def posterior(self, features: np.ndarray) -> np.ndarray:
        score = features @ self.weights
        score -= score.max(axis=1, keepdims=True)
        score = np.exp(score)
        return score / score.sum(axis=1, keepdims=True)


def fit_softmax(x: np.ndarray, y: np.ndarray, kinds: int, steps: int = 600, decay: float = 2e-5) -> np.ndarray:
    """Weights of a softmax regression by accelerated gradient steps; each domain has the weight of its rows."""
    weights = np.zeros((x.shape[1], kinds), np.float32)
    ahead = weights.copy()
    wanted = np.eye(kinds, dtype=np.float32)[y]
    rate = 2.0 / (0.5 * float((x * x).sum(axis=1).mean()) + decay)
    for step in range(steps):
        score = x @ ahead
        score -= score.max(axis=1, keepdims=True)
        score = np.exp(score)
        score /= score.sum(axis=1, keepdims=True)
        new = ahead - rate * (x.T @ (score - wanted) / len(x) + decay * ahead)
        ahead = new + step / (step + 3) * (new - weights)
        weights = new
    return weights


def labelled_rows(
    docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], id_column="doc_id", text_column="text",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``domain`` (place in ``domains``) and ``text`` of the rows that the classifier is fitted on."""
    place = F.array_position(F.array(*map(F.lit, domains)), domain).cast("int") - 1
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), place.alias("domain"))
    known = known.where("domain >= 0 and doc_id is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    # At most fit_rows rows of two numbers.
    return texts.join(F.broadcast(some), "doc_id").select("domain", "text")


def fit_classifier(rows: DataFrame, domains: list[str], anchor: str) -> Classifier:
    """``rows`` as by :func:`labelled_rows`. With labels of one domain only, all documents count as of that domain, and
    without any labels as of ``anchor``."""
    rows = written(rows, "labelled")
    found = {one["domain"]: one["count"] for one in rows.groupBy("domain").count().collect()}
    kinds = len(domains)
    sizes = np.array([found.get(k, 0) for k in range(kinds)], float)
    if (sizes > 0).sum() < 2:
        sure = int(np.argmax(sizes)) if sizes.any() else domains.index(anchor)
        weights = np.zeros((_EXTRA, kinds), np.float32)
        weights[-1] = -1e4
        weights[-1, sure] = 0
        return Classifier(list(domains), np.zeros(0, np.uint64), weights)
    counts = map_arrow(rows, _domain_words, "domain int, word bigint, n bigint").groupBy("word").agg(
        *(F.sum(F.when(F.col("domain") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(kinds)),
        F.sum("n").alias("n"),
    )
    counts = counts.where(F.col("n") >= LEAST_DOCUMENTS)
    chosen: set[int] = set()
    for k in range(kinds):
        # How far a word's share in this domain lies from its share in the others, in standard errors.
        if not sizes[k]:
            continue
        others = float(max(sizes.sum() - sizes[k], 1))
        inside, outside = F.col(f"n{k}") / float(sizes[k]), (F.col("n") - F.col(f"n{k}")) / others
        share = F.col("n") / float(sizes.sum())
        error = F.sqrt(share * (1 - share) * float(1 / sizes[k] + 1 / others)) + 1e-9
        best = counts.select("word", F.abs((inside - outside) / error).alias("z")).orderBy(F.desc("z"), "word")
        chosen.update(r["word"] for r in best.limit(WORDS_PER_DOMAIN).collect())
    ordered = np.sort(np.array(sorted(chosen), np.int64).view(np.uint64))
    table = map_arrow(rows, _fit_rows, "domain int, features binary", ordered).toArrow()
    x = np.frombuffer(b"".join(table.column("features").to_pylist()), np.float16).reshape(len(table), -1)
    order = np.lexsort((*x[:, :64].T, table.column("domain").to_numpy()))
    y = table.column("domain").to_numpy()[order]
    return Classifier(list(domains), ordered, fit_softmax(x[order].astype(np.float32), y, kinds))


def _posteriors(batches: Iterator[pa.RecordBatch], model, vocabulary: str) -> Iterator[pa.RecordBatch]:
    model = model.value
    for batch in slices(batches, "text"):
        found = model.posterior(_features(batch.column("text"), model.chosen))
        tokens = token_counts(batch.column("text"), vocabulary)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                batch.column("doc_id"),
                pa.array(tokens.astype(np.int64)),
                *(pa.array(found[:, k].astype(np.float64)) for k in range(found.shape[1])),
            ],
            names=["row", "doc_id", "n_tokens", *(f"p{k}" for k in range(found.shape[1]))],
        )


def posteriors(
    docs: DataFrame, model: Classifier, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """``row, doc_id, n_tokens, p0, p1, ...``: token ids and the posterior of each domain in the model's order."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    columns = ", ".join(f"p{k} double" for k in range(len(model.domains)))
    schema = f"row bigint, doc_id bigint, n_tokens bigint, {columns}"
    return map_arrow(with_rows(docs, id_column, text_column), _posteriors, schema, broadcast, vocabulary or default_vocabulary())


def _rate(steps: list[np.ndarray], kinds: int) -> Column:
    """The rate after the given steps, from 1: each step takes ``p . g`` off and cuts at zero."""
    if not steps:
        return F.lit(1.0)
    listed = F.array(*(F.array(*(F.lit(float(x)) for x in one)) for one in steps))
    return F.aggregate(
        listed,
        F.lit(1.0),
        lambda rate, g: F.greatest(
            F.lit(0.0), rate - sum((F.col(f"p{k}") * F.get(g, F.lit(k)) for k in range(kinds)), F.lit(0.0))
        ),
    )


def fit_rates(
    members: DataFrame, targets: np.ndarray, sure: int = 0, steps: int = STEPS
) -> tuple[Column, float, np.ndarray]:
    """The rate as a column over ``p0, p1, ...``, the rate of a document that surely is of domain ``sure``, and the expected
    tokens of each domain at these rates.

    ``targets`` are tokens of each domain. Targets that no nonnegative rates reach are missed, and so are targets that
    ``steps`` steps do not reach.
    """
    kinds = len(targets)
    rows = members.agg(
        *(F.sum(F.col("n_tokens") * F.col(f"p{i}") * F.col(f"p{j}")) for i in range(kinds) for j in range(kinds))
    ).first()
    gram = np.array([x or 0.0 for x in rows]).reshape(kinds, kinds)
    scale = max(np.trace(gram), 1.0)
    inverse = np.linalg.inv(gram / scale + 1e-9 * np.eye(kinds)) / scale
    moves: list[np.ndarray] = []
    totals = None
    while True:
        rate = _rate(moves, kinds)
        got = members.select(
            *(F.sum(rate * F.col("n_tokens") * F.col(f"p{k}")).alias(f"s{k}") for k in range(kinds))
        ).first()
        before, totals = totals, np.array([x or 0.0 for x in got])
        near = TOLERANCE * max(targets.sum(), 1.0)
        # Targets that no nonnegative rates reach are approached until a step changes nothing.
        settled = before is not None and np.abs(totals - before).max() <= near / 10
        if len(moves) == steps or settled or np.abs(totals - targets).max() <= near:
            certain = 1.0
            for one in moves:
                certain = max(0.0, certain - float(one[sure]))
            return rate, certain, totals
        moves.append(inverse @ (totals - targets))


def mix_to_targets(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    weights: Mapping[str, float],
    anchor: str,
    labelled: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    fit_rows: int = FIT_ROWS,
    seed: int = 1,
    vocabulary: str | None = None,
) -> DataFrame:
    """``row, doc_id, n_tokens, domain, rate, copies``, a posterior for each domain, and ``missed``.

    ``domain`` is an expression over ``labels``, whose documents are looked up in ``labelled`` (``docs`` if not given).
    ``weights`` are the target shares of tokens; the size of the mixture is
    such that a document which surely is of domain ``anchor`` has a rate of 1. ``copies`` is the rate, rounded up or
    down by a hash of the document so that expected totals stay. ``missed`` says, in every row, how far the expected share of
    tokens of some domain is from its target at most. Tokens are ids of ``vocabulary``.
    """
    domains = sorted(weights)
    source = docs if labelled is None else labelled
    rows = labelled_rows(source, labels, domain, domains, id_column, text_column, fit_rows)
    model = fit_classifier(rows, domains, anchor)
    with few_rows_at_once(docs.sparkSession, 2 * TEXTS_AT_ONCE):
        members = written(posteriors(docs, model, id_column, text_column, vocabulary), "posteriors")
    at = domains.index(anchor)
    kept = members.agg(F.sum(F.col("n_tokens") * F.col(f"p{at}"))).first()[0] or 0.0
    targets = np.array([weights[one] / weights[anchor] * kept for one in domains])
    rate, sure, totals = fit_rates(members, targets, at)
    shares = totals / totals.sum() if totals.sum() > 0 else np.zeros(len(domains))
    missed = float(np.abs(shares - targets / targets.sum()).max()) if targets.sum() > 0 else 0.0
    # The same factor for all rates leaves the shares as they are.
    rate = rate / sure if sure > 0 else rate
    most = F.greatest(*(F.col(f"p{k}") for k in range(len(domains))))
    label = F.coalesce(*(F.when(F.col(f"p{k}") == most, F.lit(one)) for k, one in enumerate(domains)))
    chance = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(1 << 30)) / float(1 << 30)
    return members.withColumn("rate", F.round(rate, 9)).select(
        "row",
        "doc_id",
        "n_tokens",
        label.alias("domain"),
        "rate",
        F.floor(F.col("rate") + chance).cast("int").alias("copies"),
        *(F.col(f"p{k}").alias(f"p_{one}") for k, one in enumerate(domains)),
        F.lit(missed).alias("missed"),
    )


def take_copies(docs: DataFrame, mixed: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with their columns, each as often as ``copies`` says."""
    copies = mixed.select("row", "copies").distinct()
    row = F.xxhash64(F.col(f"whole.`{id_column}`").cast("long"), f"whole.`{text_column}`")
    whole = docs.select(F.struct("*").alias("whole")).withColumn("row", row).join(copies, "row")
    taken = whole.where("copies > 0").select("whole", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    return taken.select("whole.*")
