"""Leaks against an exhaustive scan with the longest common subsequence."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hemicycle.llm import decontaminate as dc

DOCS, BENCH = "doc_id long, text string, lang string, source string, n_chars long, term int", "item_id long, text string"


def words(text):
    return re.sub(r"[^0-9a-z\x80-\U0010ffff]+", " ", (text or "").lower()).split()


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def brute(docs, items):
    out = set()
    for d, t in docs:
        w = words(t)
        for i, text in items:
            v = words(text)
            if not v or not set(v) & set(w):
                continue
            answer = words(dc.answer_of(text))
            for begin in range(0, len(w), dc.BLOCK):
                region = w[max(0, begin - len(v)) : begin + dc.WINDOW + len(v)]
                if lcs(v, region) >= dc.MIN_LCS * len(v) and lcs(answer, region) >= dc.MIN_ANSWER * len(answer):
                    out.add((d, i))
                    break
    return out


def test_bit_parallel_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(0, 70))] for _ in range(2))
        assert dc.subsequence(np.array(a, int), np.array(b, int)) == lcs(a, b)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(3, 8))) for _ in range(3000)] + ["the", "of", "and"] * 300
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, ". ".join(say(rng.randrange(6, 20)) for _ in range(3)) + ".") for i in range(12)] + [(90, ""), (91, None), (92, "...")]
    docs, planted = [], set()
    for i in range(150):
        t = say(rng.randrange(0, 400))
        if i % 5 == 0:
            item, text = items[rng.randrange(12)]
            w = text.split()
            for _ in range(rng.choice([0, 0, len(w) // 10])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            t += "\n" + " ".join(w).upper() + "! " + say(30)
            planted.add((i, item))
        docs.append((i, t))
    docs += [docs[5], (None, docs[10][1]), (None, None), (900, None), (901, ""), (902, say(20000))]
    return docs, items, planted


def frames(spark, docs, items):
    return spark.createDataFrame([(d, t, None, None, None, 1) for d, t in docs], DOCS), spark.createDataFrame(items, BENCH)


def test_against_exhaustive_scan(spark):
    docs, items, planted = corpus(2)
    got = {(r.doc_id, r.item_id) for r in dc.leaks(*frames(spark, docs, items)).collect()}
    want = brute(docs, items)
    assert planted <= want
    assert got <= want
    assert len(got & want) >= 0.95 * len(want)


def test_dropped_documents(spark):
    docs, items, planted = corpus(3)
    df, bench = frames(spark, docs, items)
    got = dc.drop_leaks(df, bench)
    assert got.columns == df.columns
    flagged = {d for d, _ in brute(docs, items)}
    left = [r.doc_id for r in got.collect()]
    assert set(range(150)) - flagged <= set(left) and not {d for d, _ in planted} & set(left)
    assert left.count(None) == 1 and {900, 901, 902} <= set(left)


def test_empty_tables(spark):
    docs, items, _ = corpus(4)
    df, bench = frames(spark, docs, items)
    assert dc.leaks(df.limit(0), bench).collect() == []
    assert dc.leaks(df, bench.limit(0)).collect() == []
    assert dc.drop_leaks(df, bench.limit(0)).count() == len(docs)


def scan(docs, items):
    """As ``brute``, with the bit-parallel subsequence."""
    number = {}
    coded = lambda ws: np.array([number.setdefault(w, len(number)) for w in ws], int)
    known = [(i, coded(words(t)), coded(words(dc.answer_of(t)))) for i, t in items]
    out = set()
    for d, t in docs:
        w = coded(words(t))
        for i, v, answer in known:
            for begin in range(0, len(w), dc.BLOCK):
                region = w[max(0, begin - len(v)) : begin + dc.WINDOW + len(v)]
                if dc.subsequence(v, region) >= dc.MIN_LCS * len(v) and dc.subsequence(answer, region) >= dc.MIN_ANSWER * len(answer):
                    out.add((d, i))
                    break
    return out


def edited(seed, lengths, share, each):
    """Items of some lengths, each in a document of its own with that share of its words replaced."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(3, 8))) for _ in range(3000)] + ["the", "of", "and"] * 300
    say = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items, docs = [], [(i, " ".join(say(200))) for i in range(100)]
    for n in lengths:
        for _ in range(each):
            body = say(n)
            items.append((len(items), " ".join(body[: n - n // 3]) + ". " + " ".join(body[n - n // 3 :]) + "."))
            for k in rng.sample(range(n), int(share * n)):
                body[k] = rng.choice(vocabulary)
            docs.append((1000 + len(docs), " ".join(say(rng.randrange(100)) + body + say(rng.randrange(100)))))
    return docs, items


@pytest.mark.parametrize("share", [0.25, 0.32, 0.4])
def test_edited_items_against_exhaustive_scan(spark, share):
    docs, items = edited(5, (15, 18, 24, 25, 32, 40, 41, 50, 59), share, 12)
    got = {(r.doc_id, r.item_id) for r in dc.leaks(*frames(spark, docs, items)).collect()}
    want = scan(docs, items)
    assert len(want) >= 18
    assert got == want


@pytest.mark.parametrize("share", [0, 0.2])
def test_long_items(spark, share):
    docs, items = edited(6, (100, 300, 500), share, 6)
    got = {(r.doc_id, r.item_id) for r in dc.leaks(*frames(spark, docs, items)).collect()}
    want = scan(docs, items)
    assert len(want) >= 18
    assert got == want


def test_items_of_frequent_words(spark):
    docs, items = edited(7, (20, 40), 0, 5)
    rng = random.Random(8)
    frequent = [f"often{k}" for k in range(20)]
    docs = [(d, " ".join(w for x in t.split() for w in (x, rng.choice(frequent)))) if d < 1000 else (d, t) for d, t in docs]
    own = rng.sample(frequent, 12)
    items.append((500, " ".join(own)))
    docs.append((5000, " ".join(f"other{k}" for k in range(60)) + " " + " ".join(own)))
    got = {(r.doc_id, r.item_id) for r in dc.leaks(*frames(spark, docs, items)).collect()}
    assert (5000, 500) in got
    assert got == scan(docs, items)


def test_paraphrases_with_words_that_the_benchmark_lacks(spark):
    """Some words of each item are replaced by synonyms, which stand in the same company in the corpus but never in
    the benchmark: the documents are found, and the space brings them nearer than other words would."""
    rng = random.Random(12)
    topics = [[f"t{k}w{j}" for j in range(30)] for k in range(20)]
    say = lambda k, n: [rng.choice(["", "syn"]) + w for w in rng.choices(topics[k], k=n)]
    docs = [(i, " ".join(say(i % 20, 160))) for i in range(400)]
    items, same, other = [], [], []
    for k in range(20):
        body = rng.sample(topics[k], 30)
        items.append((k, " ".join(body) + "."))
        for base, new in ((1000, lambda w: "syn" + w), (2000, lambda w: f"odd{rng.randrange(10**6)}")):
            held = [new(w) if i % 4 == 1 else w for i, w in enumerate(body)]
            docs.append((base + k, " ".join(held)))
    found = dc.leaks(*frames(spark, docs, items)).collect()
    got = {(r.doc_id, r.item_id): r.cosine for r in found}
    assert {(1000 + k, k) for k in range(20)} | {(2000 + k, k) for k in range(20)} <= set(got)
    assert sum(got[1000 + k, k] - got[2000 + k, k] for k in range(20)) > 0
    assert sum(got[1000 + k, k] for k in range(20)) > 20 * 0.6


def test_axes_against_numpy():
    """Nystroem's method on a matrix of low rank, with the operator's own product."""
    rng = np.random.default_rng(3)
    words = rng.integers(0, 200, (40, dc.BLOCK)).astype(np.uint32)
    blocks = np.sort(words[rng.integers(0, 40, 900)], axis=1)
    idf = np.zeros(dc.AXES + 1, np.float32)
    idf[:200] = rng.random(200) + 0.5
    dense = np.zeros((900, 200))
    for i, block in enumerate(blocks):
        for w in block:
            dense[i, w] += idf[w]
    assert np.allclose(dc._folded(blocks, idf, np.eye(dc.AXES + 1, 200, dtype=np.float32)), dense, atol=1e-4)
    unit = dense / np.linalg.norm(dense, axis=1, keepdims=True)
    held = type("Held", (), {"value": dc._padded(np.eye(dc.AXES, 200, dtype=np.float32))})
    ends = (np.arange(901) * 2 * dc.BLOCK).astype(np.int32)
    axes = pa.Array.from_buffers(pa.binary(), 900, [None, pa.py_buffer(ends), pa.py_buffer(blocks.astype(np.uint16))])
    out = np.zeros((dc.AXES, 200))
    for part in dc._product(idf, held)(iter([pa.RecordBatch.from_arrays([axes], ["axes"])])):
        for k, raw in zip(part.column("term").to_pylist(), part.column("part").to_pylist()):
            rows = np.frombuffer(raw, np.float32).reshape(-1, 200)
            out[k : k + len(rows)] = rows
    assert np.allclose(out[:200], unit.T @ unit, atol=1e-3)


def test_slices_ties_and_clashing_columns(spark):
    docs, items, _ = corpus(6)
    docs += [(950, docs[5][1] + " " + docs[5][1])]  # two windows tie
    df, bench = frames(spark, docs, items)
    once = sorted(map(str, (r[:3] for r in dc.leaks(df, bench).collect())))
    assert sorted(map(str, (r[:3] for r in dc.leaks(df, bench, slice_bytes=400).collect()))) == once
    clashes = ["k", "_k", "row", "item_id", "axes", "at", "n", "d.x"]
    wide = df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(clashes)))
    got = dc.drop_leaks(wide, bench)
    assert got.columns == wide.columns
    rows = got.collect()
    assert all(list(r)[6:] == list(range(len(clashes))) for r in rows)
    assert sorted(map(str, (r[:2] for r in rows))) == sorted(map(str, (r[:2] for r in dc.drop_leaks(df, bench).collect())))
