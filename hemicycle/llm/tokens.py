"""Byte-level BPE over Arrow text columns: counts and serialized ids.

Whole-token shortcut: a vocabulary string is *proven* when it is one pre-token and its own merges end
in that single token. Proven pre-tokens are looked up; only the rest is merged. Texts are cut at single
spaces, where the pre-tokenizer always cuts too, so that a cache can hold whole chunks; texts with other
runs of white space go through the pattern as a whole.

Defined results: a null text gives nulls, an empty text no tokens; repeated rows are counted each;
a null doc_id stays null; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED = 300_000
_FIELD, _BAD = 20, 1 << 61
_MASK = (1 << _FIELD) - 1


@lru_cache(4)
def _load(path: str, pattern: str) -> tuple[dict[bytes, int], tiktoken.Encoding, regex.Pattern]:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return ranks, tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), regex.compile(pattern)


@lru_cache(4)
def prove_whole_tokens(path: str = VOCABULARY, pattern: str = PATTERN) -> frozenset[int]:
    """Ids of the vocabulary strings that are one pre-token and encode alone as one token."""
    ranks, encoding, split = _load(path, pattern)
    proven = []
    for raw, i in ranks.items():
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            continue
        if split.fullmatch(text) and split.findall(text) == [text] and encoding._encode_single_piece(text) == [i]:
            proven.append(i)
    return frozenset(proven)


class _Cache(dict):
    """Chunk to value, computed when missing; two generations, so that what is used again stays."""

    def __init__(self, compute: Callable):
        self.compute, self.old = compute, {}

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value



def _regular(chunk: str) -> bool:
    """The chunk can be tokenized apart from its neighbours."""
    return bool(chunk) and not chunk[0].isspace() and not chunk[-1].isspace()


class Counter:
    """(tokens, pre-tokens, pre-tokens that are one proven token) of a text."""

    def __init__(self, path: str, pattern: str, proven: frozenset[int]):
        ranks, encoding, self.split = _load(path, pattern)
        self.merge = encoding._encode_single_piece
        self.whole = {raw.decode() for raw, i in ranks.items() if i in proven}
        self.pieces = _Cache(lambda p: len(self.merge(p)))
        self.chunks = _Cache(lambda c: self._packed(" " + c) if _regular(c) else _BAD)

    def _count(self, text: str) -> tuple[int, int, int]:
        pieces = self.split.findall(text)
        rest = [p for p in pieces if p not in self.whole]
        direct = len(pieces) - len(rest)
        return direct + sum(map(self.pieces.__getitem__, rest)), len(pieces), direct

    def _packed(self, text: str) -> int:
        tokens, pieces, direct = self._count(text)
        return tokens | pieces << _FIELD | direct << 2 * _FIELD

    def __call__(self, text: str) -> tuple[int, int, int]:
        if len(text.encode()) > _MASK:
            return self._count(text)  # would not fit the packed fields
        head, *rest = text.split(" ")
        if not _regular(head):
            return self._count(text)
        total = sum(map(self.chunks.__getitem__, rest))
        if total >= _BAD:
            return self._count(text)
        a, b, c = self._count(head)
        return a + (total & _MASK), b + (total >> _FIELD & _MASK), c + (total >> 2 * _FIELD & _MASK)


class Encoder:
    """Token ids of a text as little-endian bytes of ``width`` bytes an id."""

    def __init__(self, path: str, pattern: str):
        ranks, encoding, _ = _load(path, pattern)
        self.width = 2 if max(ranks.values()) < 1 << 16 else 4
        self.encode = encoding.encode_ordinary

    def __call__(self, text: str) -> bytes:
        return np.array(self.encode(text), f"<u{self.width}").tobytes()


@lru_cache(2)
def _counter(*args) -> Counter:
    return Counter(*args)


@lru_cache(2)
def _encoder(*args) -> Encoder:
    return Encoder(*args)


def _counting(*args) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(*args)
        for batch in batches:
            found = [(None, None, None) if t is None else count(t) for t in batch.column("text").to_pylist()]
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", "n_tokens", "n_pretokens", "n_whole"])

    return run


def token_counts(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Rows (doc_id, n_tokens, n_pretokens, n_whole), one for each row of ``docs``. No shuffle."""
    args = path, pattern, prove_whole_tokens(path, pattern)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_counting(*args), f"doc_id {kind}, n_tokens long, n_pretokens long, n_whole long")


def _encoding(path: str, pattern: str, keep: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(path, pattern)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if keep:
                ids = [None if t is None else encode(t) for t in texts]
                sizes = [None if x is None else len(x) // encode.width for x in ids]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])
            else:
                sizes = [None if t is None else len(encode.encode(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64())], ["doc_id", "n_tokens"])

    return run


def token_ids(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Rows (doc_id, n_tokens, ids): ids as little-endian bytes, two an id where the vocabulary allows."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_encoding(path, pattern, True), f"doc_id {kind}, n_tokens long, ids binary")


def token_lengths(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Rows (doc_id, n_tokens)."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_encoding(path, pattern, False), f"doc_id {kind}, n_tokens long")
