"""Quality and toxicity by nearest-neighbour voting in a latent-semantic space.

Terms are lower-cased words without punctuation, plus signs of form: the punctuation a word ends in,
words in capitals, shares of repeated words. A term is its hash's bucket, of 2**18 at every size of input;
words that share a bucket share its weight. Document frequencies are counted over all documents, and every
bucket has a weight: log odds between the classes, discounted by the chi-squared statistic where chance
explains them, times the inverse document frequency. The labelled rows that fit the model (at most
``max_labelled``, by the hash of their ids) stay in the cluster, split by bucket: each step of the randomised
singular value decomposition broadcasts a matrix of labelled rows by rank and sums the partial products, so
that the driver holds only such matrices and, at the end, the axes (buckets times rank). Every document is
then projected, its exact cosines with all labelled vectors are computed in blocks, and its nearest labelled
neighbours vote, weighted by similarity.

Defined results: null and empty texts have no terms but the constant one and are voted on like any other;
texts of any length are read whole; repeated rows are treated each; a document with null id or without label
can't vote; labels of unknown documents and null labels are left out, and of a document's several labels the
worst counts; with no label at all everything is kept with null scores; an empty table gives no row; other
columns are ignored, or kept as they are by ``keep_good``, whatever their names. Of neighbours at equal
cosines any may vote; a share of exactly one half is kept as quality and dropped as toxicity. A document
never votes for itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm._words import _BYTE, _LOWER, _P, Rolling, Words, mix, slices, text_bytes, text_rows
from hemicycle.session import materialize

BUCKETS = 1 << 18
MAX_LABELLED = 20_000  # labelled rows that fit the model, taken by the hash of their ids
RANK = 32
NEIGHBOURS = 15
_BIAS = 4.0
_CHI2 = 15.0
_LEAST = 1e-3
_PARTS = 16  # of the buckets, in the fit
_STEPS = 4
_ROWS = 512
_SPACED = _LOWER.copy()
_ALNUM = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _ALNUM[_a:_b] = True
_SPACED[~_ALNUM] = 32
_FORM = np.uint64(0x5851F42D4C957F2D)


class Model(NamedTuple):
    weight: np.ndarray  # of each bucket
    axes: np.ndarray  # buckets by rank, in 16 bits
    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray  # two columns: bad, toxic


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, bucket) with their number of occurrences."""
    raw = Words(data, offsets)
    plain = Words(_SPACED[data], offsets)
    alnum = _ALNUM[data]
    place = np.where(alnum, np.arange(len(data)), -1)
    last = np.maximum.accumulate(place) if len(data) else place
    tail = np.maximum(last[raw.end - 1] + 1, raw.start) if len(raw.start) else raw.start
    ends = Rolling(_BYTE[data], _P).of(tail, raw.end) * _FORM
    row = raw.row_of_word()
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data < 91))])
    lower = np.concatenate([[0], np.cumsum((data >= 97) & (data < 123))])
    shout = (upper[raw.end] - upper[raw.start] >= 2) & (lower[raw.end] == lower[raw.start])
    marked = tail < raw.end
    n = len(offsets) - 1
    keys = [
        (plain.row_of_word().astype(np.uint64) << np.uint64(18)) | (plain.hash & np.uint64(BUCKETS - 1)),
        (row[marked].astype(np.uint64) << np.uint64(18)) | (mix(ends[marked]) & np.uint64(BUCKETS - 1)),
        (row[shout].astype(np.uint64) << np.uint64(18)) | np.uint64(1),
    ]
    key, tf = np.unique(np.concatenate(keys), return_counts=True)
    own = np.bincount(plain.row_of_word(), minlength=n)
    distinct = np.bincount((key >> np.uint64(18)).astype(np.int64), minlength=n)
    share = np.clip((distinct * 8) // np.maximum(own, 1), 0, 8).astype(np.uint64) + np.uint64(2)
    extra = (np.arange(n, dtype=np.uint64) << np.uint64(18)) | share
    key, tf = np.concatenate([key, extra[own > 0]]), np.concatenate([tf, np.ones((own > 0).sum(), np.int64)])
    return (key >> np.uint64(18)).astype(np.int64), (key & np.uint64(BUCKETS - 1)).astype(np.int64), tf


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition: documents with each bucket, overall and by label."""
    counts = np.zeros((5, BUCKETS + 1), np.int32)
    for batch in batches:
        labels = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("bad", "toxic")]
        for a, b, data, offsets in text_rows(batch):
            row, bucket, _ = features(data, offsets)
            bad, toxic = labels[0][a:b], labels[1][a:b]
            counts[0] += np.bincount(bucket, minlength=BUCKETS + 1).astype(np.int32)
            counts[0, BUCKETS] += b - a
            for k, y in enumerate((bad, toxic)):
                for v in (0, 1):
                    who = y == v
                    counts[1 + 2 * k + v] += np.bincount(bucket[who[row]], minlength=BUCKETS + 1).astype(np.int32)
                    counts[1 + 2 * k + v, BUCKETS] += int(who.sum())
    at = np.flatnonzero(counts[0])
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c[at].astype(np.int64)) for c in counts)], ["bucket", "n", "good", "bad", "mild", "toxic"])


def _weights(counts: DataFrame, total) -> np.ndarray:
    """Each bucket's weight: the log odds between the classes, times how far chi-squared (one degree of
    freedom) is from chance, times the inverse document frequency."""
    relevance = F.lit(0.0)
    for no, yes in (("good", "bad"), ("mild", "toxic")):
        size0, size1 = float(total[no] or 0), float(total[yes] or 0)
        if not size0 or not size1:
            continue
        size, without, having = size0 + size1, F.col(no).cast("double"), F.col(yes).cast("double")
        have = without + having
        excess = F.greatest(F.abs(having - have * size1 / size) - 0.5, F.lit(0.0))
        chi2 = excess * excess * size**3 / F.greatest(have * (size - have) * size0 * size1, F.lit(1e-9))
        odds = F.abs(F.ln((having + 0.5) / (size1 + 1) / ((without + 0.5) / (size0 + 1))))
        relevance = F.greatest(relevance, odds * F.pow(chi2 / (chi2 + _CHI2), F.lit(3)))
    weight = (relevance + _LEAST) * (F.ln((1 + float(total["n"])) / (1 + F.col("n"))) + 0.1)
    found = counts.filter(F.col("bucket") < BUCKETS).select("bucket", weight.cast("float").alias("weight")).toArrow()
    out = np.zeros(BUCKETS, np.float32)
    out[found.column("bucket").to_numpy()] = found.column("weight").to_numpy()
    return out


def _matrix(data: np.ndarray, offsets: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the rows' weighted terms, in the order of rows."""
    row, bucket, tf = features(data, offsets)
    value = ((1 + np.log(tf)) * weight[bucket]).astype(np.float32)
    by = np.argsort(row, kind="stable")
    by = by[value[by] > 0]
    return row[by], bucket[by], value[by]


def _project(row: np.ndarray, term: np.ndarray, value: np.ndarray, n: int, axes: np.ndarray) -> np.ndarray:
    """Unit vectors of the rows (sorted): latent coordinates and the constant term."""
    out = np.zeros((n, axes.shape[1] + 1), np.float32)
    for a in range(0, n, _ROWS):  # so that the products of few rows are held
        lo, hi = np.searchsorted(row, [a, a + _ROWS])
        if lo < hi:
            part = row[lo:hi]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            out[part[first], :-1] = np.add.reduceat(axes[term[lo:hi]].astype(np.float32) * value[lo:hi, None], first, axis=0)
    out[:, -1] = _BIAS
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _sampled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    sample = (
        labels.filter("doc_id is not null and quality is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id_"))
        .agg((1 - F.min("quality")).cast("double").alias("bad"), F.max("toxic").cast("double").alias("toxic"))
        .orderBy(F.xxhash64("id_"), "id_")
        .limit(most)
    )
    return docs.select(F.col("doc_id").cast("long").alias("id_"), "text").join(F.broadcast(sample), "id_", "left")


def _sample_terms(held) -> Callable:
    """A labelled row's terms by part of the buckets, with its norm: (part, id_, bad, toxic, norm, terms, vals)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = held.value
        for batch in batches:
            for a, b, data, offsets in text_rows(batch):
                row, term, value = _matrix(data, offsets, weight)
                norm = np.sqrt(np.bincount(row, value.astype(float) ** 2, minlength=b - a))
                part = term // (BUCKETS // _PARTS)
                order = np.lexsort((part, row))
                row, term, value = row[order], term[order], value[order]
                ends = np.searchsorted(row * _PARTS + part[order], np.arange((b - a) * _PARTS + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (term.astype(np.int32), value)]
                each = pa.array(np.repeat(np.arange(a, b), _PARTS))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(_PARTS, dtype=np.int32), b - a)), *(batch.column(c).take(each) for c in ("id_", "bad", "toxic")), pa.array(np.repeat(norm, _PARTS)), *lists],
                    ["part", "id_", "bad", "toxic", "norm", "terms", "vals"],
                )

    return run


_PACKED = "part int, n int, row binary, term binary, val binary"
_MATRIX = "at int, rows binary"


def _packed(table: pa.Table) -> pa.Table:
    """One part of the buckets as one row, which no reader splits: rows (by rank of their ids, which every part has
    all of), terms and values divided by their rows' norms."""
    table = table.sort_by("id_")
    terms, vals = table.column("terms").combine_chunks(), table.column("vals").combine_chunks()
    size = np.diff(terms.offsets.to_numpy())
    row = np.repeat(np.arange(table.num_rows, dtype=np.int32), size)
    val = (vals.flatten().to_numpy() / np.maximum(np.repeat(table.column("norm").to_numpy(), size), 1e-9)).astype(np.float32)
    held = [pa.array([x.tobytes()], pa.binary()) for x in (row, terms.flatten().to_numpy().astype(np.int32), val)]
    return pa.table([table.column("part").slice(0, 1), pa.array([table.num_rows], pa.int32()), *held], ["part", "n", "row", "term", "val"])


def _sums(key: np.ndarray, size: int, index: np.ndarray, value: np.ndarray, table: np.ndarray) -> np.ndarray:
    """out[key] += value * table[index], for keys below ``size``."""
    out = np.zeros((size, table.shape[1]), np.float32)
    by = np.argsort(key, kind="stable")
    for a in range(0, len(by), 1 << 16):
        at = by[a : a + (1 << 16)]
        k = key[at]
        first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        out[k[first]] += np.add.reduceat(table[index[at]] * value[at, None], first, axis=0)
    return out


def _product(held, back: bool) -> Callable:
    """Of each part of the buckets (its columns B of the sample): B'X, or with ``back`` the task's sum of B(B'X)."""

    def cut(out: np.ndarray, base: int) -> pa.RecordBatch:
        at = list(range(0, len(out), _ROWS))
        return pa.RecordBatch.from_arrays([pa.array([base + a for a in at], pa.int32()), pa.array([out[a : a + _ROWS].tobytes() for a in at], pa.binary())], ["at", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = held.value
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                row, term, value = (np.frombuffer(batch.column(c)[i].as_buffer(), k) for c, k in (("row", np.int32), ("term", np.int32), ("val", np.float32)))
                base = batch.column("part")[i].as_py() * (BUCKETS // _PARTS)
                out = _sums(term - base, BUCKETS // _PARTS, row, value, x)
                if back:
                    out = _sums(row, len(x), term - base, value, out)
                    total = out if total is None else total + out
                else:
                    yield cut(out.astype(np.float16), base)
        if total is not None:
            yield cut(total, 0)

    return run


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column("rows"))
    return pa.table({"at": table.column("at").slice(0, 1), "rows": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _multiply(packed: DataFrame, x: np.ndarray, back: bool) -> np.ndarray:
    held = packed.sparkSession.sparkContext.broadcast(x.astype(np.float32))
    parts = packed.mapInArrow(_product(held, back), _MATRIX)
    if back:
        parts = parts.groupBy("at").applyInArrow(_added, _MATRIX)
    kind = np.float32 if back else np.float16
    out = np.zeros((len(x) if back else BUCKETS, x.shape[1]), kind)
    for batch in parts.toArrow().to_batches():
        for at, rows in zip(batch.column("at").to_pylist(), batch.column("rows"), strict=True):
            found = np.frombuffer(rows.as_buffer(), kind).reshape(-1, x.shape[1])
            out[at : at + len(found)] = found
    held.unpersist()
    return out


def latent_space(sample: DataFrame, ids: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """The axes, and the unit sample's coordinates, by randomised subspace iteration with AA' (A: unit rows)
    and a Rayleigh-Ritz step. ``sample`` has (part, id_, norm, terms, vals); ``ids`` are its sorted ids.
    The sample is shuffled once; each step then reads it and shuffles one matrix of rows by rank a task."""
    n = len(ids)
    packed = materialize(sample.groupBy("part").applyInArrow(_packed, _PACKED), "packed")
    width = min(n, rank + 8)
    x = np.random.Generator(np.random.PCG64(7)).standard_normal((n, width))
    for _ in range(_STEPS):
        q = np.linalg.qr(x)[0].astype(np.float32)
        x = _multiply(packed, q, True).astype(np.float64)
    gram = q.T @ x
    squares, vectors = np.linalg.eigh((gram + gram.T) / 2)
    squares, vectors = squares[::-1][:rank], vectors[:, ::-1][:, :rank]
    turn = (vectors / np.sqrt(np.maximum(squares, 1e-9 * max(squares[0], 1e-9)))).astype(np.float32)
    return _multiply(packed, q @ turn, False), (x @ turn).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, rank: int = RANK) -> Model | None:
    """The model; None without labelled documents. What reaches the driver is bounded by ``max_labelled`` and
    the number of buckets: weights, ids and labels, matrices of rows by rank, and the axes."""
    rows = _sampled(docs, labels, max_labelled)
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad", "mild", "toxic")]
    counts = rows.mapInArrow(_counting, "bucket int, n long, good long, bad long, mild long, toxic long").groupBy("bucket").agg(*sums)
    counts = materialize(counts, "counts")
    total = counts.filter(F.col("bucket") == BUCKETS).first()
    if total is None or not total["good"] + total["bad"]:
        return None
    weight = _weights(counts, total)
    held = docs.sparkSession.sparkContext.broadcast(weight)
    each = F.min_by(F.struct("text", "bad", "toxic"), F.xxhash64("text")).alias("row")  # one text an id: the bound holds
    voters = rows.filter("bad is not null").groupBy("id_").agg(each).select("id_", "row.*")
    sample = voters.mapInArrow(_sample_terms(held), "part int, id_ long, bad double, toxic double, norm double, terms array<int>, vals array<float>")
    sample = materialize(sample, "sample")
    known = sample.filter("part = 0").select("id_", "bad", "toxic", "norm").orderBy("id_").toArrow()
    ids, norm = known.column("id_").to_numpy(), known.column("norm").to_numpy()
    y = np.stack([known.column(c).to_numpy() for c in ("bad", "toxic")], 1).astype(np.float32)
    axes, vectors = latent_space(sample, ids, rank)
    vectors = np.concatenate([vectors * norm[:, None], np.full((len(ids), 1), _BIAS)], 1)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return Model(weight, axes, vectors.astype(np.float32), ids, y)


def votes(x: np.ndarray, ids: np.ndarray, model: Model, neighbours: int, block: int = 512) -> np.ndarray:
    """Exact cosines with every labelled vector, in blocks; the share of each label among the nearest."""
    out = np.zeros((len(x), 2), np.float32)
    k = min(neighbours, len(model.ids))
    for a in range(0, len(x), block):
        cosine = x[a : a + block] @ model.vectors.T
        own = np.searchsorted(model.ids, ids[a : a + block])
        own[own == len(model.ids)] = 0
        same = np.flatnonzero(model.ids[own] == ids[a : a + block])
        while len(same):  # repeated labelled rows follow one another
            cosine[same, own[same]] = -1
            own[same] += 1
            same = same[own[same] < len(model.ids)]
            same = same[model.ids[own[same]] == ids[a : a + block][same]]
        near = np.argpartition(cosine, len(model.ids) - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** 8 + 1e-6
        out[a : a + block] = (weight[:, :, None] * model.labels[near]).sum(1) / weight.sum(1, keepdims=True)
    return out


def _scoring(held, neighbours: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            ids = batch.column("doc_id").cast(pa.int64()).fill_null(-(1 << 63)).to_numpy()
            scores = []
            data, offsets = text_bytes(batch.column("text"))
            for a, b in slices(offsets):
                row, term, value = _matrix(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], model.weight)
                scores.append(votes(_project(row, term, value, b - a, model.axes), ids[a:b], model, neighbours))
            found = np.concatenate(scores) if scores else np.zeros((0, 2))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(1 - found[:, 0].astype(float)), pa.array(found[:, 1].astype(float))], [*names, "quality_score", "toxic_score"])

    return run


def scored(docs: DataFrame, labels: DataFrame, neighbours: int = NEIGHBOURS, model: Model | None = None) -> DataFrame:
    """The documents with quality_score and toxic_score (votes for good, and for toxic)."""
    model = model or fit(docs, labels)
    if model is None:
        return docs.withColumns({"quality_score": F.lit(None).cast("double"), "toxic_score": F.lit(None).cast("double")})
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select("*", F.lit(0.0).alias("quality_score"), F.lit(0.0).alias("toxic_score")).schema
    for name in ("quality_score", "toxic_score"):
        schema[name].nullable = True
    return docs.mapInArrow(_scoring(held, neighbours), schema)


def kept(df: DataFrame) -> DataFrame:
    return df.filter("coalesce(quality_score, 1) >= 0.5 and coalesce(toxic_score, 0) < 0.5")


def quality_keeps(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (doc_id, quality_score, toxic_score) of the documents that the vote keeps."""
    return kept(scored(docs.select("doc_id", "text"), labels)).select("doc_id", "quality_score", "toxic_score")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the vote keeps, with their columns."""
    scores = ["quality_score", "toxic_score"]
    if not set(scores) & set(docs.columns):
        return kept(scored(docs, labels)).select(docs.columns)
    names = {c: f"_{i}_{c}" for i, c in enumerate(docs.columns) if c in scores}
    back = {v: k for k, v in names.items()}
    return kept(scored(docs.withColumnsRenamed(names), labels)).drop(*scores).withColumnsRenamed(back).select(docs.columns)
