"""Documents as token ids, numbered along the stream of their task or source.

The ids are those of a public byte-level BPE vocabulary whose path is a parameter. Texts without special tokens
are encoded by a faster library with the same vocabulary and pattern; a test holds the two to equal ids.
Defined results: a missing or empty text has no ids but the closing one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.arrays import slices
from cohortflow.llm.frames import few_rows_at_once, map_arrow, written

END = 0


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to its ids, without special tokens added."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    specials = [one["content"] for one in stored.get("added_tokens", ())]
    alphabet = byte_alphabet()
    ranks = {
        bytes(alphabet[c] for c in token): number
        for token, number in stored["model"]["vocab"].items()
        if token not in specials
    }
    fast = tiktoken.Encoding("local", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if any(one in text for one in specials):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def stretches(texts: pa.Array, lead: str = " ") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct stretches of ``lead`` and text, each occurrence as a place among them, and their number per text.

    Texts are cut before blanks that follow a visible ASCII character: the pattern of the vocabulary never matches over such a
    border, so a text's ids are those of its stretches in turn.
    """
    front, nothing = pa.scalar(lead, pa.large_string()), pa.scalar("", pa.large_string())
    whole = pc.binary_join_element_wise(nothing, texts.cast(pa.large_string()), front)
    borders = np.frombuffer(whole.buffers()[1], np.int64)[: len(whole) + 1]
    data = whole.buffers()[2]
    data = np.frombuffer(data, np.uint8)[: borders[-1]] if data is not None else np.zeros(0, np.uint8)
    cut = data == 32
    cut[1:] &= (data[:-1] > 32) & (data[:-1] < 127)
    cut[borders[:-1][np.diff(borders) > 0]] = True
    starts = np.flatnonzero(cut)
    flat = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), np.diff(np.searchsorted(starts, borders))


@lru_cache(maxsize=2)
def id_lengths(path: str) -> np.ndarray:
    """The number of bytes of each id; 0 for special tokens."""
    with open(path, encoding="utf-8") as file:
        stored = json.load(file)
    specials = {one["content"] for one in stored.get("added_tokens", ())}
    listed = stored["model"]["vocab"]
    out = np.zeros(max(listed.values()) + 1, np.int64)
    for token, number in listed.items():
        # Each character stands for a byte.
        out[number] = 0 if token in specials else len(token)
    return out


def token_counts(texts: pa.Array, path: str) -> np.ndarray:
    """The number of ids of each text; each distinct stretch is encoded once. A missing text has none.

    Stretches that begin with a blank and end with a visible ASCII character are encoded one after the other as one text, which no id
    crosses at their borders, and their ids are told apart by their bytes.
    """
    units, place, per_text = stretches(pc.fill_null(texts, ""), "")
    encode = encoder(path)
    plain = pc.match_substring_regex(units, r"^ (?s:.*)[!-~]$").to_numpy(zero_copy_only=False).astype(bool)
    plain &= ~pc.match_substring(units, "<|").to_numpy(zero_copy_only=False).astype(bool)
    sizes = np.zeros(len(units), np.int64)
    sizes[~plain] = [len(encode(one)) for one in units.filter(pa.array(~plain)).to_pylist()]
    if plain.any():
        together = pa.concat_arrays([units.filter(pa.array(plain))])
        ends = np.frombuffer(together.buffers()[1], np.int64)[1 : len(together) + 1]
        found = np.cumsum(id_lengths(path)[encode(together.buffers()[2].to_pybytes()[: ends[-1]].decode())])
        sizes[plain] = np.diff(np.searchsorted(found, ends, side="right"), prepend=0)
    ends = np.cumsum(per_text)
    running = np.concatenate([[0], np.cumsum(sizes[place])])
    return running[ends] - running[ends - per_text]


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    part = TaskContext.get().partitionId()
    passed: dict = {}
    for batch in slices(batches, "text"):
        sources, ids, counts, starts = batch.column("source").to_pylist(), [], [], []
        for text, source in zip(batch.column("text").to_pylist(), sources):
            found = np.array([*(encode(text) if text else ()), END], np.uint16)
            ids.append(found.tobytes())
            counts.append(len(found))
            starts.append(passed.get(source, 0))
            passed[source] = starts[-1] + len(found)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("source"),
                pa.array(ids, pa.binary()),
                pa.array(counts, pa.int32()),
                pa.array([part] * len(ids), pa.int32()),
                pa.array(starts, pa.int64()),
            ],
            names=["doc_id", "source", "ids", "n", "part", "start"],
        )


def token_table(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", source_column: str | None = None
) -> DataFrame:
    """``doc_id, source, ids, n, part, start``, written once to the shared folder.

    ``ids`` are little-endian 16-bit numbers. ``start`` counts the ids of earlier documents of the same task ``part`` and
    source, so a place in a whole source follows from one sum per task and source.
    """
    source = F.col(source_column).cast("string") if source_column else F.lit("")
    picked = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(source, F.lit("")).alias("source"),
        F.col(text_column).alias("text"),
    )
    schema = "doc_id bigint, source string, ids binary, n int, part int, start bigint"
    with few_rows_at_once(docs.sparkSession, 1000):
        return written(map_arrow(picked, _encode, schema, path), "tokens")
