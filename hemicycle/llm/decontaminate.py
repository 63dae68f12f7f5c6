"""Benchmark decontamination by latent semantic retrieval.

Words are lower-cased and free of punctuation. One pass over the texts writes, of each document, an axis for
every word (16 bits of its hash, at every size of input; words that share an axis count together), and the
positions of the words that the benchmark has. Passages are blocks of words; the TF-IDF matrix of all blocks
over all words is factored by a distributed randomised singular value decomposition (Nystroem's method: one
product of A'A with a random matrix, whose partial products are summed by key; squared inverse frequencies), so
that what reaches the driver is axes times rank. Overlapping windows and benchmark items meet in the latent
space, by cosine. The cosine of a paraphrase can be low (a gate at 0.5 loses one in five where 40 % of the words
are replaced), so it doesn't decide alone: any match must hold a number of the item's rarer words (its length
times ``min_lcs``, less its more frequent words), which an inverted list of the items' words finds exactly. Pairs
that lack them are dismissed before their cosine is computed, as no cosine could make them a match, and
``min_cosine`` (-1: off) is a further gate for those who want fewer candidates. A candidate counts where the
longest common subsequence of its words with the item's covers ``min_lcs`` of the item, and the item's answer
(its last sentence) is there too, by ``min_answer``. A benchmark of more than ``SLICE_BYTES`` is matched in
slices, each broadcast by itself.

Defined results: null and empty texts match nothing, nor do items without words; texts of any length are read
whole; repeated rows are treated each; repeated items give their own rows; of an item's windows in a document
the one with the greatest (lcs, answer, cosine) is given, at ties the first; null ids stay null; other columns
are ignored, or kept as they are by ``drop_leaks``, whatever their names; an empty benchmark or corpus gives no
match.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm._words import Words, text_bytes, text_rows
from hemicycle.llm.quality import _SPACED
from hemicycle.session import materialize

BLOCK = 16
WINDOW = 2 * BLOCK
RANK = 48
MIN_COSINE = -1.0
MIN_LCS = 0.6
MIN_ANSWER = 0.5
AXES = 1 << 16
SLICE_BYTES = 4 << 20  # of benchmark text that is broadcast at a time
_CHUNK = 8192  # blocks, in products
_FILTER = 1 << 20
_HITS = 1 << 21  # occurrences of items' words that are looked at together


class Benchmark(NamedTuple):
    items: list
    terms: list[np.ndarray]  # of each item, its words
    answers: list[np.ndarray]
    vocabulary: np.ndarray  # sorted word hashes


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    words = Words(_SPACED[data], offsets)
    return words.hash, words.rows


def answer_of(text: str) -> str:
    """The last sentence, or the whole text where there is only one."""
    sentences = [s for s in re.split(r"[.!?]\s+|\n", text.strip()) if s.strip(" .!?")]
    return sentences[-1] if sentences else ""


def load_benchmark(benchmark: DataFrame) -> Benchmark:
    """The benchmark on the driver: it is the small side by its nature, and doesn't grow with the corpus."""
    rows = benchmark.select("item_id", "text").filter("text is not null").toArrow()
    items, texts = rows.column("item_id").to_pylist(), rows.column("text").to_pylist()
    order = sorted(range(len(items)), key=lambda i: (items[i] is None, items[i] or 0, texts[i]))
    items, texts = [items[i] for i in order], [texts[i] for i in order]
    words, rows_ = _hashes(texts)
    last, last_rows = _hashes([answer_of(t) for t in texts])
    vocabulary = np.unique(words)
    index = np.searchsorted(vocabulary, words).astype(np.int32)
    tail = np.searchsorted(vocabulary, last).astype(np.int32)
    keep = [k for k in range(len(items)) if rows_[k + 1] > rows_[k]]
    return Benchmark([items[k] for k in keep], [index[rows_[k] : rows_[k + 1]] for k in keep], [tail[last_rows[k] : last_rows[k + 1]] for k in keep], vocabulary)


def _keeping(vocabulary: np.ndarray) -> Callable:
    seen = np.zeros(_FILTER, bool)
    seen[(vocabulary & np.uint64(_FILTER - 1)).astype(np.int64)] = True
    packed = np.packbits(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(packed).astype(bool)
        for batch in batches:
            for a, b, data, offsets in text_rows(batch):
                words = Words(_SPACED[data], offsets)
                axis = (words.hash >> np.uint64(48)).astype(np.uint16)
                bounds = pa.py_buffer((words.rows * 2).astype(np.int32))
                axes = pa.Array.from_buffers(pa.binary(), b - a, [None, bounds, pa.py_buffer(axis)])
                at = np.flatnonzero(seen[(words.hash & np.uint64(_FILTER - 1)).astype(np.int64)])
                place = np.searchsorted(vocabulary, words.hash[at])
                place[place == len(vocabulary)] = 0
                ok = vocabulary[place] == words.hash[at]
                at, place = at[ok], place[ok]
                ends = np.searchsorted(at, words.rows).astype(np.int32)
                row = np.searchsorted(words.rows, at, "right") - 1
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (at - words.rows[row], place)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), axes, *lists], ["doc_id", "axes", "at", "term"])

    return run


def _blocks(axes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' axes by block (a row each, sorted, filled with AXES); each document's first block and block count."""
    offsets = np.frombuffer(axes.buffers()[1], np.int32)[axes.offset : axes.offset + len(axes) + 1].astype(np.int64) // 2
    words = np.frombuffer(axes.buffers()[2] or b"", np.uint16)[offsets[0] : offsets[-1]]
    size = np.diff(offsets)
    counts = -(-size // BLOCK)
    first = np.cumsum(counts) - counts
    out = np.full((int(counts.sum()), BLOCK), AXES, np.uint32)
    out.ravel()[np.arange(len(words)) + np.repeat(first * BLOCK - offsets[:-1] + offsets[0], size)] = words
    out.sort(axis=1)
    return out, first, counts


def _new(blocks: np.ndarray) -> np.ndarray:
    """Where another axis starts in its block."""
    new = np.ones(blocks.shape, bool)
    new[:, 1:] = blocks[:, 1:] != blocks[:, :-1]
    return new


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition: blocks that have each axis, and at AXES the number of blocks."""
    counts = np.zeros(AXES + 1, np.int64)
    for batch in batches:
        blocks, _, _ = _blocks(batch.column("axes"))
        counts += np.bincount(blocks[_new(blocks)], minlength=AXES + 1)
        counts[AXES] += len(blocks) - np.count_nonzero(blocks[:, -1] == AXES)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], ["term", "n"])


def _folded(blocks: np.ndarray, idf: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The blocks' TF-IDF rows times a table of the axes (and a last row of zeros)."""
    out = np.empty((len(blocks), table.shape[1]), np.float32)
    for a in range(0, len(blocks), 256):
        part = blocks[a : a + 256]
        out[a : a + 256] = np.matmul(idf[part][:, None, :], np.take(table, part, axis=0))[:, 0]
    return out


def _add_rows(total: np.ndarray, key: np.ndarray, row: np.ndarray, value: np.ndarray, y: np.ndarray, many: int = 16) -> None:
    """total[key] += value * y[row], for sorted keys: long runs by one product each, short ones place by place."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(first, append=len(key))
    for k in np.flatnonzero(size > many).tolist():
        a, b = first[k], first[k] + size[k]
        total[key[a]] += value[a:b] @ y[row[a:b]]
    for r in range(many):
        at = first[(size > r) & (size <= many)] + r
        if not len(at):
            break
        total[key[at]] += y[row[at]] * value[at, None]


_PART = "term int, part binary"


def _product(idf: np.ndarray, held) -> Callable:
    """Of a partition: A'AX, for A the unit TF-IDF rows of its blocks, X the broadcast matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = held.value
        total = np.zeros_like(x)
        for batch in batches:
            blocks, _, _ = _blocks(batch.column("axes"))
            for a in range(0, len(blocks), _CHUNK):
                part = blocks[a : a + _CHUNK]
                flat, value = part.ravel(), idf[part]
                at = np.flatnonzero(_new(part).ravel())
                times = np.diff(at, append=len(flat))
                square = np.repeat(times, times).astype(np.float32).reshape(part.shape) * value * value
                y = _folded(part, idf, x) / np.maximum(square.sum(1), 1e-9)[:, None]
                real = np.flatnonzero(flat < AXES)
                by = real[np.argsort(flat[real].astype(np.uint16), kind="stable")]
                if len(by):
                    _add_rows(total, flat[by], by // BLOCK, value.ravel()[by], y)
        for k in range(0, AXES, 256):
            part = total[k : k + 256]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["term", "part"])

    return run


def _adding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(batch.column("term").to_pylist(), batch.column("part").to_pylist(), strict=True):
            part = np.frombuffer(raw, np.float32).astype(np.float64)
            sums[k] = sums[k] + part if k in sums else part
    for k, v in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.astype(np.float32).tobytes()], pa.binary())], ["term", "part"])


def _multiply(kept: DataFrame, idf: np.ndarray, x: np.ndarray) -> np.ndarray:
    spark = kept.sparkSession
    held = spark.sparkContext.broadcast(_padded(x))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = kept.select("axes").mapInArrow(_product(idf, held), _PART).repartition(tasks, "term").mapInArrow(_adding, _PART).collect()
    held.unpersist()
    out = np.zeros(x.shape, np.float32)
    for r in rows:
        part = np.frombuffer(r["part"], np.float32).reshape(-1, x.shape[1])
        out[r["term"] : r["term"] + len(part)] = part
    return out


def _padded(x: np.ndarray) -> np.ndarray:
    """With a row of zeros, for the places of a block that have no word."""
    return np.concatenate([x, np.zeros((1, x.shape[1]))]).astype(np.float32)


def latent_axes(kept: DataFrame, idf: np.ndarray, rank: int) -> np.ndarray:
    """V / sigma for the leading singular vectors of the blocks' TF-IDF matrix A (a vector times it is folded
    into the latent space), from one product Y = A'AX with orthonormal X: A'A is about Y (X'Y)^-1 Y'."""
    x = np.linalg.qr(np.random.Generator(np.random.PCG64(11)).standard_normal((AXES, rank + 16), np.float32))[0]
    y = _multiply(kept, idf, x)
    core = x.T.astype(np.float64) @ y
    squares, turn = np.linalg.eigh((core + core.T) / 2)
    z = y @ (turn / np.sqrt(np.maximum(squares, 1e-6 * max(squares[-1], 1e-9)))).astype(np.float32)
    squares, vectors = np.linalg.eigh((z.T @ z).astype(np.float64))
    squares, vectors = squares[::-1][:rank], vectors[:, ::-1][:, :rank]
    # The columns of z @ vectors are singular vectors times the square roots of ``squares``, A's squared values.
    return z @ (vectors / np.maximum(squares, 1e-6 * max(squares[0], 1e-9))).astype(np.float32)


def subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel in the first sequence."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b.tolist():
        if x in where:
            u = v & where[x]
            v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def _item_vectors(bench: Benchmark, idf: np.ndarray, axes: np.ndarray) -> np.ndarray:
    axis = (bench.vocabulary >> np.uint64(48)).astype(np.int64)
    row = np.repeat(np.arange(len(bench.items)), [len(t) for t in bench.terms])
    out = np.zeros((len(bench.items), axes.shape[1]), np.float32)
    col = axis[np.concatenate(bench.terms)]
    np.add.at(out, row, axes[col] * idf[col][:, None])
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def rarer_words(bench: Benchmark, n: np.ndarray, min_lcs: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each term, the items that it counts for (``ends``, ``item``), and of each item the least number of
    such words in any match. Words go from the most frequent (by ``n``) while a quarter of the item's length
    stays to be found."""
    terms, owners, needed = [], [], []
    for k, words in enumerate(bench.terms):
        size = len(words)
        least = max(1, int(min_lcs * size) - 1)
        while least / size < min_lcs:
            least += 1
        own, times = np.unique(words, return_counts=True)
        order = np.lexsort((own, -n[own]))
        gone = np.cumsum(times[order])
        drop = int(np.searchsorted(gone, least - max(1, min(least, size // 4)), "right"))
        needed.append(least - (int(gone[drop - 1]) if drop else 0))
        terms.append(own[order[drop:]])
        owners.append(np.full(len(own) - drop, k, np.int32))
    term, item = np.concatenate(terms), np.concatenate(owners)
    by = np.argsort(term, kind="stable")
    return np.searchsorted(term[by], np.arange(len(bench.vocabulary) + 1)), item[by], np.array(needed)


def _by_words(place: np.ndarray, term: np.ndarray, ends: np.ndarray, first: np.ndarray, counts: np.ndarray, rarer: tuple, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (numbered as blocks are) and items, for all windows whose region has the needed words."""
    posting, owner, needed = rarer
    gap = 2 * int(size.max()) + 2 * WINDOW
    hits = posting[term + 1] - posting[term]
    before = np.concatenate([[0], np.cumsum(hits)])[ends]  # of each document
    windows, items = [], []
    a = 0
    while a < len(counts):
        b = max(a + 1, int(np.searchsorted(before, before[a] + _HITS, "right")) - 1)
        h, t = hits[ends[a] : ends[b]], term[ends[a] : ends[b]]
        base = (first[a:b] - first[a]) * BLOCK + np.arange(b - a) * gap  # no region reaches the next document
        word = place[ends[a] : ends[b]] + np.repeat(base, np.diff(ends[a : b + 1]))
        item = owner[np.arange(h.sum()) + np.repeat(posting[t] - np.cumsum(h) + h, h)]
        by = np.argsort(item.astype(np.uint16) if len(size) < 1 << 16 else item, kind="stable")
        item, word = item[by], np.repeat(word, h)[by]
        last = np.arange(len(item)) + needed[item] - 1
        k = np.flatnonzero(last < len(item))
        k = k[(item[last[k]] == item[k]) & (word[last[k]] - word[k] < 2 * size[item[k]] + WINDOW)]
        doc = np.searchsorted(base, word[k], "right") - 1
        start, end, length = word[k] - base[doc], word[last[k]] - base[doc], size[item[k]]
        low = np.maximum(-(-(end - WINDOW - length + 1) // BLOCK), 0)
        high = np.minimum((start + length) // BLOCK, counts[a + doc] - 1)
        n = np.maximum(high - low + 1, 0)
        window = np.repeat(first[a + doc] + low - np.cumsum(n) + n, n) + np.arange(n.sum())
        key = np.unique(window * len(size) + np.repeat(item[k], n))
        windows.append(key // len(size))
        items.append(key % len(size))
        a = b
    return np.concatenate(windows), np.concatenate(items)


def _matching(held, idf: np.ndarray, min_cosine: float, min_lcs: float, min_answer: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench, axes, items, rarer = held.value
        own = [np.unique(t) for t in bench.terms]
        size = np.array([len(t) for t in bench.terms])
        for batch in batches:
            blocks, first, counts = _blocks(batch.column("axes"))
            at = batch.column("at")
            place, term = at.flatten().to_numpy(), batch.column("term").flatten().to_numpy()
            ends = at.offsets.to_numpy() - at.offsets[0].as_py()
            ids = batch.column("doc_id")
            total = int(counts.sum())
            owner = np.repeat(np.arange(len(counts)), counts)
            if not total:
                continue
            lexical, lexical_item = _by_words(place, term, ends, first, counts, rarer, size)
            best: dict[tuple[int, int], tuple] = {}
            carry = None
            for base in range(0, total, 4096):  # blocks at a time; the block before joins the next window
                part, start = _folded(blocks[base : base + 4096], idf, axes), base
                if carry is not None:
                    part, start = np.concatenate([carry, part]), base - 1
                carry = part[-1:]
                who = owner[start : start + len(part)]
                window = part.copy()
                window[:-1] += part[1:] * (who[1:] == who[:-1])[:, None]
                window /= np.maximum(np.linalg.norm(window, axis=1, keepdims=True), 1e-9)
                lo, hi = np.searchsorted(lexical, [start, start + len(part)])
                able, able_item = lexical[lo:hi] - start, lexical_item[lo:hi]
                cosine = np.einsum("ij,ij->i", window[able], items[able_item])
                near = cosine >= min_cosine
                able, able_item, cosine = able[near], able_item[near], cosine[near]
                for w, item, near in zip(able.tolist(), able_item.tolist(), cosine.tolist(), strict=True):
                    doc = int(who[w])
                    words = bench.terms[item]
                    begin = (start + int(w) - int(first[doc])) * BLOCK
                    lo = ends[doc] + np.searchsorted(place[ends[doc] : ends[doc + 1]], begin - len(words))
                    hi = ends[doc] + np.searchsorted(place[ends[doc] : ends[doc + 1]], begin + WINDOW + len(words))
                    region = term[lo:hi]
                    if len(region) < min_lcs * len(words):
                        continue
                    region = region[own[item][np.minimum(np.searchsorted(own[item], region), len(own[item]) - 1)] == region]
                    if len(region) < min_lcs * len(words):
                        continue  # too few of the item's words for any common subsequence
                    share = subsequence(words, region) / len(words)
                    if share < min_lcs:
                        continue
                    answer = bench.answers[item]
                    right = subsequence(answer, region) / len(answer) if len(answer) else 1.0
                    if right < min_answer:
                        continue
                    found = share, right, near, -begin
                    key = doc, item
                    if key not in best or best[key] < found:
                        best[key] = found
            if best:
                keys = sorted(best)
                got = [best[k] for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([d for d, _ in keys])),
                        pa.array([bench.items[i] for _, i in keys], pa.int64()),
                        pa.array([-g[3] for g in got], pa.int32()),
                        pa.array([float(g[2]) for g in got]),
                        pa.array([g[0] for g in got]),
                        pa.array([g[1] for g in got]),
                    ],
                    ["doc_id", "item_id", "start_word", "cosine", "lcs", "answer"],
                )

    return run


_LEAK = "doc_id long, item_id long, start_word int, cosine double, lcs double, answer double"


def leaks(docs: DataFrame, benchmark: DataFrame, min_cosine: float = MIN_COSINE, min_lcs: float = MIN_LCS, min_answer: float = MIN_ANSWER, rank: int = RANK, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Rows (doc_id, item_id, start_word, cosine, lcs, answer): documents that hold an item, or a paraphrase
    of it, with its best window."""
    spark = docs.sparkSession
    found, space = spark.createDataFrame([], _LEAK), None
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    slices = math.ceil((benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / slice_bytes)
    for k in range(slices):
        bench = load_benchmark(benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k) if slices > 1 else benchmark)
        if not bench.items:
            continue
        kept = materialize(keys.mapInArrow(_keeping(bench.vocabulary), "doc_id long, axes binary, at array<int>, term array<int>"), "terms")
        if space is None:
            counts = kept.select("axes").mapInArrow(_frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
            df = np.zeros(AXES + 1, np.int64)
            df[counts.column("term").to_numpy()] = counts.column("n").to_numpy()
            idf = ((np.log((1 + df[AXES]) / (1 + df)) + 0.1) ** 2).astype(np.float32)
            idf[AXES] = 0
            space = df, idf, _padded(latent_axes(kept, idf, rank))
        df, idf, axes = space
        often = df[(bench.vocabulary >> np.uint64(48)).astype(np.int64)]
        held = spark.sparkContext.broadcast((bench, axes, _item_vectors(bench, idf, axes), rarer_words(bench, often, min_lcs)))
        part = kept.mapInArrow(_matching(held, idf, min_cosine, min_lcs, min_answer), _LEAK)
        found = part if slices == 1 else found.unionByName(part)
    return found


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents whose text holds no benchmark item, with their columns."""
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("k"))
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    found = leaks(texts, benchmark).select(F.col("doc_id").alias("k")).distinct()
    return rows.join(found, "k", "left_anti").select("row.*")
