"""Votes against a plain loop, and held-out accuracy."""

import random
import re
import string
from collections import Counter

import numpy as np
import pytest

from hemicycle.llm import quality
from hemicycle.llm._words import text_bytes

DOCS, LABELS = "doc_id long, text string, quality_score string", "doc_id long, quality int, toxic int"


def test_votes_against_brute_force():
    rng = np.random.default_rng(1)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    refs, x = unit(rng.normal(size=(60, 8))), unit(rng.normal(size=(700, 8)))
    ids = np.sort(rng.integers(0, 50, 60))
    own = rng.integers(0, 80, 700)
    y = rng.integers(0, 2, (60, 2)).astype(np.float32)
    model = quality.Model(None, None, refs, ids, y)
    got = quality.votes(x, own, model, 5)
    for i in range(700):
        cosine = [(float(x[i] @ refs[j]) if ids[j] != own[i] else -1.0, j) for j in range(60)]
        near = sorted(cosine)[-5:]
        w = [max(c, 0) ** 8 + 1e-6 for c, _ in near]
        want = sum(v * y[j] for v, (_, j) in zip(w, near)) / sum(w)
        assert np.allclose(got[i], want, atol=1e-3)


def bytes_of(texts):
    import pyarrow as pa

    return text_bytes(pa.array(texts, pa.string()))


def bucket(text, extra=()):
    """The buckets of a text of one word, without those of its form."""
    return set(quality.features(*bytes_of([text]))[1].tolist()) - set(range(11)) - set(extra)


def test_features_against_brute_force():
    rng = random.Random(3)
    pool = [*"plain words SHOUT loud? end!! a,b mixed-Case (x) 12 ... é".split(), "--", "A1B2"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 60))) for _ in range(50)] + ["", "??"]
    row, found, tf = quality.features(*bytes_of(texts))
    got = [Counter() for _ in texts]
    for r, b, n in zip(row.tolist(), found.tolist(), tf.tolist()):
        got[r][b] += n
    alnum = set(string.ascii_letters + string.digits)
    for r, text in enumerate(texts):
        want = Counter()
        plain = re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", text.lower()).split()
        for w in plain:
            (b,) = bucket(w)
            want[b] += 1
        for w in text.split():
            tail = re.search(r"[^0-9A-Za-z\x80-\U0010ffff]*$", w)[0]
            if tail:
                (b,) = bucket("a" + tail, bucket("a"))
                want[b] += 1
            letters = [c for c in w if c in alnum and c.isalpha()]
            if sum(c.isupper() for c in letters) >= 2 and not any(c.islower() for c in letters):
                want[1] += 1
        if plain:
            distinct = len(want)
            want[min(8, distinct * 8 // len(plain)) + 2] += 1
        assert got[r] == want, text


def dense(texts, weight):
    row, term, value = quality._matrix(*bytes_of(texts), weight)
    out = np.zeros((len(texts), quality.BUCKETS))
    out[row, term] = value
    return out


@pytest.mark.parametrize("rank", [3, 8])
def test_latent_space_and_projection_against_numpy(spark, rank):
    rng = random.Random(5)
    topics = [[f"t{k}w{j}" for j in range(30)] for k in range(4)]
    texts = [" ".join(rng.choice(topics[i % 4]) for _ in range(40)) + f" own{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), int(i % 4 == 1)) for i in range(60)], LABELS)
    model = quality.fit(docs, labels, rank=rank)
    a = dense(texts, model.weight)
    model = model._replace(axes=model.axes.astype(float))
    unit = a / np.linalg.norm(a, axis=1, keepdims=True)
    _, values, axes = np.linalg.svd(unit, full_matrices=False)
    assert np.allclose(model.axes.T @ model.axes, np.eye(rank), atol=1e-3)
    kept = np.linalg.norm(unit @ model.axes) ** 2
    assert kept > 0.995 * (values[:rank] ** 2).sum()
    if rank == 3:  # three topics stand out, so the axes are settled
        assert np.allclose(np.linalg.svd(axes[:3] @ model.axes)[1], 1, atol=1e-2)
    want = np.concatenate([a @ model.axes, np.full((60, 1), quality._BIAS)], 1)
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(model.vectors, want, atol=1e-3)
    row, term, value = quality._matrix(*bytes_of(texts), model.weight)
    assert np.allclose(quality._project(row, term, value, 60, model.axes), want, atol=1e-4)


def test_the_whole_vote_against_numpy(spark):
    rng = random.Random(6)
    good, bad = [f"g{k}" for k in range(40)], [f"b{k}" for k in range(40)]
    texts = [" ".join(rng.choice(bad if i % 3 == 0 else good) for _ in range(30)) for i in range(90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(60)], LABELS)
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.quality_score for r in quality.scored(docs, labels, 5, model).collect()}
    x = np.concatenate([dense(texts, model.weight) @ model.axes, np.full((90, 1), quality._BIAS)], 1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(90):
        near = sorted(((float(x[i] @ x[j]), j) for j in range(60) if j != i), reverse=True)[:5]
        weights = [max(c, 0) ** 8 + 1e-6 for c, _ in near]
        want = sum(w * (j % 3 > 0) for w, (_, j) in zip(weights, near)) / sum(weights)
        assert abs(got[i] - want) < 0.05
        assert (got[i] >= 0.5) == (i % 3 > 0)


def test_ties_and_bound(spark):
    """Equal texts with opposite labels: the vote is a half, which is kept; the sample's bound holds."""
    docs = spark.createDataFrame([(i, "same words here") for i in range(20)] + [(1, "same words here")] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(0, 1, 1)], LABELS)
    model = quality.fit(docs, labels, max_labelled=6)
    assert len(model.ids) == len(model.vectors) == len(model.labels) == len(set(model.ids.tolist())) == 6
    scores = [r.quality_score for r in quality.scored(docs.filter("doc_id > 18"), labels, 20, quality.fit(docs, labels)).collect()]
    assert all(abs(s - 10 / 19) < 1e-3 or abs(s - 9 / 19) < 1e-3 for s in scores)


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    test = labels.filter("doc_id % 4 = 1")
    model = quality.fit(docs, labels.filter("doc_id % 4 <> 1"))
    got = quality.scored(docs.select("doc_id", "text").join(test.select("doc_id"), "doc_id"), labels, model=model).join(test, "doc_id").toPandas()
    keep = (got.quality_score >= 0.5) & (got.toxic_score < 0.5)
    assert keep[(got.quality == 1) & (got.toxic == 0)].mean() > 0.99
    assert keep[got.toxic == 1].mean() < 0.08
    assert keep[got.quality == 0].mean() < 0.05


def test_odd_rows(spark):
    good, bad = "plain words in a plain row " * 5, "JUNK!! NOISE!! TRASH!! " * 9
    rows = [(i, good + str(i)) for i in range(40)] + [(100 + i, bad + str(i)) for i in range(40)] + [(None, None), (None, good), (300, ""), (301, None), (3, good + "3"), (302, good * 4000)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], DOCS)
    labels = [(i, 1, 0) for i in range(40)] + [(100 + i, 0, i % 2) for i in range(40)] + [(None, 1, 0), (5, None, None), (9999, 0, 1), (3, 1, 0)]
    labels = spark.createDataFrame(labels, LABELS)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    got = kept.collect()
    ids = [r.doc_id for r in got]
    assert not {i for i in ids if i is not None and 100 <= i < 140} and set(range(40)) <= set(ids)
    assert ids.count(3) == 2 and 302 in ids and all(r.quality_score == "clash" for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert quality.keep_good(empty, labels).collect() == []
    assert quality.keep_good(docs, spark.createDataFrame([], LABELS)).count() == len(rows)
