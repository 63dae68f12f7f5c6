"""Document fingerprints by locally consistent parsing.

On each level, runs of a symbol become one symbol, deterministic coin tossing against the symbol
before reduces names to a few labels, and local maxima of the labels start phrases of two to about
ten symbols; a phrase's name is the hash of its symbols. Whether a phrase starts at a place depends on
a few symbols around it only, so equal substrings have equal phrases, but for a margin at their ends.

Defined results: a null text gives null fingerprints; an empty text an empty list and a null root;
repeated rows are treated each; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm._words import _BYTE, Rolling, mix, signed, text_rows

LEVEL = 4
_BASE = 0xA24BAED4963EE407
_U = np.uint64


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which a symbol differs from the one before, plus that bit's value."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = ~x[first]
    d = x ^ before
    low = d & (~d + x.dtype.type(1))
    j = np.bitwise_count(low - x.dtype.type(1))
    j[d == 0] = 0
    return (j << 1 | (x & low != 0)).astype(np.uint8)


def parse(names: np.ndarray, rows: np.ndarray, level: int, labels: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One level: names of the phrases, and where each row's phrases start. Rows of one symbol stay."""
    n = len(names)
    if not n:
        return names, rows
    start = np.zeros(n, bool)
    start[rows[:-1][rows[:-1] < rows[1:]]] = True
    key = names if labels is None else labels
    run = start.copy()
    run[1:] |= key[1:] != key[:-1]
    at = np.flatnonzero(run)
    size = np.diff(np.append(at, n))
    single, key = names[at], key[at]
    many = size > 1
    single[many] = mix(single[many] + size[many].astype(np.uint64) * _U(_BASE))
    rows = np.searchsorted(at, rows)
    first = np.flatnonzero(start[at])
    label = _toss(key, first)
    for _ in range(2 if labels is not None else 3):
        label = _toss(label, first)
    m = len(label)
    phrase = np.zeros(m, bool)
    phrase[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    ends = np.append(first[1:], m) - 1
    phrase[ends] = False  # a row's last symbol never stands alone
    phrase[first] = True
    cut = np.flatnonzero(phrase)
    stop = np.append(cut[1:], m)
    out = single[cut]
    long = stop - cut > 1
    out[long] = Rolling(single, _BASE).of(cut[long], stop[long]) ^ _U(level * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return out, np.searchsorted(cut, rows)


def hierarchy(data: np.ndarray, offsets: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names on level ``keep`` with each row's bounds; each row's root name and height."""
    names, rows = _BYTE[data], offsets
    kept, roots, height = (names, rows), np.zeros(len(offsets) - 1, np.uint64), np.zeros(len(offsets) - 1, np.int32)
    level = 0
    while True:
        level += 1
        before = np.diff(rows)
        names, rows = parse(names, rows, level, data if level == 1 else None)
        height[before > 1] = level
        if level <= keep:
            kept = names, rows
        if level >= keep and (np.diff(rows) <= 1).all():
            break
    full = np.diff(rows) == 1
    roots[full] = names[rows[:-1][full]]
    return *kept, roots, height


def _fingerprints(level: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = batch.column("text").is_null().to_numpy(zero_copy_only=False)
            for a, b, data, offsets in text_rows(batch):
                names, rows, roots, height = hierarchy(data, offsets, level)
                gone = null[a:b]
                lists = pa.ListArray.from_arrays(pa.array(np.where(np.append(gone, False), 0, rows).astype(np.int32), pa.int32(), mask=np.append(gone, False)), pa.array(signed(names)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(offsets), mask=gone), pa.array(height, mask=gone), pa.array(signed(roots), mask=np.diff(offsets) == 0), lists],
                    ["doc_id", "n_bytes", "height", "root", "phrases"],
                )

    return run


def document_fingerprints(docs: DataFrame, level: int = LEVEL) -> DataFrame:
    """Rows (doc_id, n_bytes, height, root, phrases): ``phrases`` are the names on ``level`` in text
    order (about 100 bytes each on level 4), ``root`` names the whole text. No shuffle."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(level), f"doc_id {kind}, n_bytes long, height int, root long, phrases array<long>")


def shared_phrases(prints: DataFrame, least: int = 1) -> DataFrame:
    """Rows (phrase, doc_ids, n_docs) for the phrases that more than ``least`` documents have."""
    each = prints.select("doc_id", F.explode(F.array_distinct("phrases")).alias("phrase"))
    return each.groupBy("phrase").agg(F.sort_array(F.collect_set("doc_id")).alias("doc_ids"), F.countDistinct("doc_id").alias("n_docs")).filter(F.col("n_docs") > least)
