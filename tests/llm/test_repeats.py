"""Suffix arrays and suffix trees against brute force over every passage."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hemicycle.llm import suffix_array, suffix_tree

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute_sa(x):
    return sorted(range(len(x)), key=lambda i: list(x[i:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(xs):
    x = np.array(xs, np.int64)
    sa = suffix_array.suffix_array(x)
    assert sa.tolist() == brute_sa(xs)
    got = suffix_array.permuted_common_prefixes(x, sa, 10)
    for k in range(1, len(xs)):
        i, j, n = sa[k], sa[k - 1], 0
        while n < 10 and max(i, j) + n < len(xs) and xs[i + n] == xs[j + n]:
            n += 1
        assert got[i] == n


def brute_spans(rows, length, later=False):
    """A passage counts where an equal one stands in another document, or ``length`` words away in its own."""
    docs = {(i is None, i or 0, hash(t)): (i, (t or "").split()) for i, t in rows}
    order = {key: k for k, key in enumerate(sorted(docs))}
    seen = defaultdict(list)
    for key, (_, w) in docs.items():
        for p in range(len(w) - length + 1):
            seen[tuple(w[p : p + length])].append((order[key], p))
    ends = {k: (min(v), max(v)) for k, v in seen.items()}
    far = lambda x, y: x[0] != y[0] or abs(x[1] - y[1]) >= length
    out = set()
    for key, (i, w) in docs.items():
        cover = [False] * len(w)
        for p in range(len(w) - length + 1):
            first, last = ends[tuple(w[p : p + length])]
            own = order[key], p
            if far(own, first) or not later and far(own, last):
                cover[p : p + length] = [True] * length
        p = 0
        while p < len(w):
            if cover[p]:
                q = p
                while q < len(w) and cover[q]:
                    q += 1
                out.add((i, p, q, q - p))
                p = q
            else:
                p += 1
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randrange(9))
    shared = [[word() for _ in range(rng.randrange(30, 160))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(0, len(s) - 20)
            w += s[a : a + rng.randrange(10, 120)] + [word() for _ in range(rng.randrange(0, 10))]
        if rng.random() < 0.1:
            w = ["same"] * rng.randrange(100)
        if rng.random() < 0.15:
            part = [word() for _ in range(rng.choice([7, 20, 33, 60]))]
            w += part * rng.randrange(2, 6) + [word() for _ in range(9)] + part
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(n + i, rows[i][1]) for i in range(5)] + [rows[7], rows[7], (None, rows[8][1]), (500, None), (None, None), (501, ""), (502, "é " * 40)]
    once = " ".join(word() for _ in range(200))
    rows += [(503, once + " x " + once), ((1 << 63) - 1, rows[3][1]), (None, rows[3][1]), (None, once + " y"), (504, " ".join(word() for _ in range(30000)) + " " + once)]
    return rows


@pytest.mark.parametrize("op", [suffix_array.suffix_array_repeats, suffix_tree.suffix_tree_repeats])
@pytest.mark.parametrize("seed, group", [(1, 20000), (2, 20000), (2, 3)])
def test_spans_match_brute_force(spark, op, seed, group):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = [tuple(r) for r in op(df, 30, group).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_spans(rows, 30)


@pytest.mark.parametrize("op", [suffix_array.suffix_array_repeats, suffix_tree.suffix_tree_repeats])
def test_spans_of_the_test_table(spark, op):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert {tuple(r) for r in op(df).collect()} == brute_spans(rows, 50)


@pytest.mark.parametrize("op", [suffix_array.suffix_array_repeats, suffix_tree.suffix_tree_repeats, suffix_tree.remove_repeats])
def test_empty_table(spark, op):
    assert op(spark.createDataFrame([], SCHEMA)).collect() == []


def test_removal_keeps_the_first_copy_and_other_columns(spark):
    rows = [r for r in corpus(3) if r[0] is not None]
    df = spark.createDataFrame([(i, t, "x", None, None, i) for i, t in rows], SCHEMA + ", h long")
    got = suffix_tree.remove_repeats(df, 30)
    assert got.columns == df.columns
    texts = defaultdict(list)
    for r in got.collect():
        texts[r.doc_id].append(r.text)
        assert r.h == r.doc_id and r.lang == "x"
    later = defaultdict(list)
    for i, a, b, _ in brute_spans(rows, 30, later=True):
        later[i].append((a, b))
    for i, t in dict(rows).items():
        w = (t or "").split()
        want = [x for p, x in enumerate(w) if not any(a <= p < b for a, b in later[i])]
        if i in later and not want:
            assert i not in texts
        else:
            assert all((x or "").split() == want for x in texts[i]), i


def hot(n=400):
    """One passage in very many surroundings, some of which agree beyond it, on either side."""
    rng = random.Random(9)
    passage = [f"w{k}" for k in range(45)]
    rows = []
    for i in range(n):
        left = [f"l{rng.randrange(3)}" for _ in range(rng.randrange(4))]
        right = [f"r{rng.randrange(3)}" for _ in range(rng.randrange(12))]
        rows.append((i, " ".join([f"a{i}"] + left + passage[: rng.choice([45, 45, 40])] + right + [f"z{i}"])))
    return rows


@pytest.mark.parametrize("op", [suffix_array.suffix_array_repeats, suffix_tree.suffix_tree_repeats])
@pytest.mark.parametrize("group", [4, 40, 20000])
def test_hot_prefix_is_lengthened(spark, op, group):
    rows = hot()
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert {tuple(r) for r in op(df, 50, group).collect()} == brute_spans(rows, 50)


def test_copies_of_a_later_surrounding_show_the_first(spark):
    rng = random.Random(4)
    words = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    passage, tail = words(60), words(80)
    rows = [(1, " ".join(words(90) + passage + words(90) + passage + tail)), (2, " ".join(passage + tail))]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    assert {tuple(r) for r in suffix_tree.suffix_tree_repeats(df).collect()} == brute_spans(rows, 50)


CLASHES = ["id", "t", "row", "spans", "h", "c", "pos", "a", "b", "lo", "hi", "later", "last", "first", "want", "words", "n", "d.x"]


def test_removal_with_clashing_columns(spark):
    rows = [r for r in corpus(5)]
    schema = SCHEMA + "".join(f", `{c}` long" for c in CLASHES)
    df = spark.createDataFrame([(i, t, "x", None, len(t or ""), *range(len(CLASHES))) for i, t in rows], schema)
    got = suffix_tree.remove_repeats(df, 30)
    assert got.columns == df.columns
    for r in got.collect():
        assert list(r)[5:] == list(range(len(CLASHES))) and (r.text is None or r.n_chars == len(r.text))
    plain = suffix_tree.remove_repeats(df.drop(*CLASHES), 30)
    assert sorted(map(str, plain.collect())) == sorted(str(r) for r in got.select(*plain.columns).collect())


def test_one_copy_of_a_passage_within_a_document_stays(spark):
    once = " ".join(f"w{k}" for k in range(70))
    df = spark.createDataFrame([(1, f"start {once} middle {once} end {once}", None, None, 0), (2, "same " * 500, None, None, 0)], SCHEMA)
    got = {r.doc_id: r.text.split() for r in suffix_tree.remove_repeats(df).collect()}
    assert got[1] == f"start {once} middle end".split()
    assert got[2] == ["same"] * 50


def test_hot_suffixes_are_told_apart_without_their_words(spark, monkeypatch):
    from hemicycle.llm import repeats

    kept, write = {}, repeats.materialize

    def recorded(df, name):
        kept[name] = df.columns
        return write(df, name)

    monkeypatch.setattr(repeats, "materialize", recorded)
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in corpus(3, 20)], SCHEMA)
    repeats.repeated_words(df, suffix_tree.resolve, 50, group=1).count()
    assert "p" in kept["suffixes"] and "words" not in kept["suffixes"]


def test_texts_are_fetched_once_for_hot_and_other_prefixes(spark):
    from hemicycle.llm import repeats

    df = spark.createDataFrame([(i, t, None, None, None) for i, t in corpus(3, 20)], SCHEMA)
    found = repeats.repeated_words(df, suffix_tree.resolve, 30, group=1)
    assert "text#" not in found._jdf.queryExecution().optimizedPlan().toString()
