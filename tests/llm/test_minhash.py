"""Near-duplicate groups against exact Jaccard over all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from hemicycle.llm import minhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, None, "clash") for i, t in rows], SCHEMA)


def shingles(text, n=3):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, min(len(w), 1)))}


def brute(rows, threshold=0.5):
    docs = {(i, t): shingles(t) for i, t in rows if shingles(t)}
    keys, root = list(docs), {k: k for k in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x, a in enumerate(keys):
        for b in keys[:x]:
            both = len(docs[a] & docs[b])
            if both >= threshold * (len(docs[a]) + len(docs[b]) - both):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k in keys:
        groups[find(k)].append(k[0])
    return {tuple(sorted(g, key=lambda i: (i is None, i))) for g in groups.values() if len(g) > 1}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    boiler = [word() for _ in range(60)]
    rows = []
    for i in range(90):
        w = [word() for _ in range(rng.randrange(1, 300))] + (boiler if rng.random() < 0.5 else [])
        rows.append((i, " ".join(w)))
        for _ in range(rng.choice([0, 0, 0, 1, 2, 8])):
            v = [x if rng.random() > 0.04 else word() for x in w]
            rows.append((len(rows) + 1000, " ".join(v)))
    rows += [(5000 + i, rows[3][1]) for i in range(120)] + [rows[5], rows[5], (None, rows[6][1]), (7000, ""), (7001, None), (None, None), (7002, "one"), (7003, "ONE"), (7004, "lorem " * 9000)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_match_brute_force(spark, seed):
    rows = corpus(seed)
    got = {tuple(r.doc_ids) for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    want = brute(rows)
    assert not {g for g in got if not any(set(g) <= set(w) for w in want)}
    pairs = lambda groups: {(a, b) for g in groups for a in g for b in g if str(a) < str(b)}
    assert len(pairs(got) & pairs(want)) >= 0.98 * len(pairs(want))


def test_groups_of_the_test_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in df.collect()])
    assert {tuple(r.doc_ids) for r in minhash.near_duplicates(df).collect()} == want


def test_one_of_each_group_stays(spark):
    rows = corpus(4)
    df = frame(spark, rows)
    groups = [r.doc_ids for r in minhash.near_duplicates(df).collect()]
    gone = {i for g in groups for i in g[1:]}
    got = minhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    left = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    want = sorted({(i, t) for i, t in rows if i not in gone or (i is None and not t)}, key=str)
    assert left == want


def test_estimate_is_exact_for_whole_sketches():
    a, b = np.arange(0, 40, dtype=np.uint64), np.arange(20, 60, dtype=np.uint64)
    assert minhash.estimate(a, b, 64) == pytest.approx(20 / 60)


def test_components(spark):
    edges = [(i, i + 1, 1.0) for i in range(0, 40)] + [(100, 101, 1.0), (102, 101, 1.0), (7, 7, 1.0)]
    got = {r.node: r.comp for r in minhash.components(spark.createDataFrame(edges, "a long, b long, score double")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[101] == got[102] == 100


def test_empty_table(spark):
    df = frame(spark, [])
    assert minhash.near_duplicates(df).collect() == [] and minhash.drop_near_duplicates(df).collect() == []


CLASHES = ["id", "t", "row", "root", "first", "stays", "twice", "gone_", "id_", "t_", "n", "value", "rank", "d.x"]


def test_clashing_columns_and_null_ids(spark):
    rows = [(7, "a b c d e"), ((1 << 63) - 1, "p q r s t"), (None, "p q r s t"), (None, "u v w x y"), (None, "u v w x y"), (8, "a b c d e")]
    schema = "doc_id long, text string" + "".join(f", `{c}` long" for c in CLASHES)
    df = spark.createDataFrame([(i, t, *range(len(CLASHES))) for i, t in rows], schema)
    got = minhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    got = got.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(7, "a b c d e"), ((1 << 63) - 1, "p q r s t"), (None, "u v w x y")], key=str)
    assert all(list(r)[2:] == list(range(len(CLASHES))) for r in got)
    groups = {tuple(r.doc_ids) for r in minhash.near_duplicates(df).collect()}
    assert groups == {(7, 8), ((1 << 63) - 1, None)}


def test_near_copies_of_one_text_cost_no_pair_for_each_two(spark, monkeypatch):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, other = [word() for _ in range(200)], [word() for _ in range(200)]
    vary = lambda w, p: " ".join(x if rng.random() > p else word() for x in w)
    rows = [(i, " ".join(base)) for i in range(3)] + [(10 + i, vary(base, 0.03)) for i in range(150)]
    mixed = [base[:80] + other[80:], base[:95] + other[95:], other]  # close to the base, at or below the threshold
    rows += [(1000 + i, vary(mixed[i % 3], 0.02)) for i in range(30)]
    kept, write = {}, minhash.materialize

    def counted(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(minhash, "materialize", counted)
    groups = minhash.similar_groups(frame(spark, rows), block=16).distinct().collect()
    found = defaultdict(list)
    for r in groups:
        found[r.root].append(r.id)
    assert {tuple(sorted(g)) for g in found.values() if len(g) > 1} == brute(rows)
    classes = {r.node: r.comp for r in kept["classes"].collect()}
    pairs = kept["likely"].collect()
    assert all(classes[r.a] != classes[r.b] for r in pairs)
    assert len(pairs) < 150 * 149 / 2 / 2


def test_pairs_of_a_component_pass_by():
    import tracemalloc

    import pyarrow as pa

    def batch(a, b, texts):
        n = len(a)
        columns = {"top": [1] * n, "a": a, "ca": a, "b": b, "cb": b}
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in columns.values()), pa.array(texts, pa.string())], [*columns, "text"])

    def batches():
        yield batch([1, 2, 3], [None] * 3, ["a b c d e f", "a b c d e f g", "p q r s t u"])
        for _ in range(30):
            yield batch([1] * 10000, [3] * 10000, [None] * 10000)
        yield batch([1], [2], [None])

    tracemalloc.start()
    out = [r for b in minhash._verifying(3, 0.5)(batches()) for r in b.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {r["comp"]: r["root"] for r in out} == {1: 1, 2: 1, 3: 3}
    assert peak < 20e6


def test_short_texts_are_decided_by_their_sketches(spark, monkeypatch):
    """Short texts of which any two share a line, half of them too little for the threshold."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    line = [word() for _ in range(20)]
    rows = [(i, " ".join(line + [word() for _ in range(rng.choice([3, 5, 18, 25]))])) for i in range(120)]
    kept, write = {}, minhash.materialize

    def counted(df, name):
        kept[name] = write(df, name)
        return kept[name]

    monkeypatch.setattr(minhash, "materialize", counted)
    monkeypatch.setattr(minhash, "_stars", lambda *a: spark.createDataFrame([], "a long, b long"))
    groups = defaultdict(list)
    for r in minhash.similar_groups(frame(spark, rows), block=16).distinct().collect():
        groups[r.root].append(r.id)
    assert {tuple(sorted(g)) for g in groups.values() if len(g) > 1} == brute(rows)
    assert kept["likely"].count() == 0  # nothing is left to be verified
    assert kept["pairs"].count() < 20 * 120  # by block, at most as many edges as members
