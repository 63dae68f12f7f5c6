"""Locally consistent parsing against a plain symbol-by-symbol version."""

import random

import numpy as np

from hemicycle.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, root string"


def prints(texts, level=3):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    names, rows, roots, height = fp.hierarchy(data, offsets, level)
    return [names[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])], roots.tolist(), height.tolist()


def slow_phrases(text):
    """Level 1 by hand: bounds of the phrases of one text, in bytes."""
    raw = text.encode()
    runs, at = [], 0
    while at < len(raw):
        end = at
        while end < len(raw) and raw[end] == raw[at]:
            end += 1
        runs.append((raw[at], at))
        at = end

    def toss(xs):
        out = []
        for i, x in enumerate(xs):
            d = x ^ (xs[i - 1] if i else x ^ 255)
            j = (d & -d).bit_length() - 1 if d else 0
            out.append(2 * j + (x >> j & 1 if d else 0))
        return out

    label = [r[0] for r in runs]
    for _ in range(3):
        label = toss(label)
    cuts = [0] + [i for i in range(1, len(runs) - 1) if label[i] > label[i - 1] and label[i] > label[i + 1]]
    return [runs[i][1] for i in cuts]


def test_first_level_against_plain_version():
    rng = random.Random(1)
    for _ in range(50):
        text = "".join(rng.choice("aabcdefé  ") for _ in range(rng.randrange(1, 200)))
        want = slow_phrases(text)
        got = prints([text, "other text", text], 1)[0]
        assert got[0] == got[2] and len(got[0]) == len(want), text


_ALL = (1 << 64) - 1


def mixed(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & _ALL
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & _ALL
    return x ^ x >> 31


def slow_level(names, level, labels=None):
    """One level by hand: names of the phrases."""
    key, runs = labels or names, []
    for name, k in zip(names, key):
        if runs and runs[-1][1] == k:
            runs[-1][2] += 1
        else:
            runs.append([name, k, 1])
    single = [name if n == 1 else mixed((name + n * fp._BASE) & _ALL) for name, _, n in runs]
    label, top = [k for _, k, _ in runs], 255 if labels else _ALL
    for _ in range(3 if labels else 4):
        out = []
        for i, x in enumerate(label):
            d = x ^ (label[i - 1] if i else x ^ top)
            j = (d & -d).bit_length() - 1 if d else 0
            out.append(2 * j + (x >> j & 1 if d else 0))
        label, top = out, 255
    m = len(label)
    cuts = [0] + [i for i in range(1, m - 1) if label[i] > label[i - 1] and label[i] > label[i + 1]]
    out = []
    for a, b in zip(cuts, [*cuts[1:], m]):
        if b - a == 1:
            out.append(single[a])
        else:
            total = sum(x * pow(fp._BASE, k, 1 << 64) for k, x in enumerate(single[a:b])) & _ALL
            out.append(mixed(total) ^ (level * 0x9E3779B97F4A7C15 & _ALL))
    return out


def test_every_level_against_plain_version():
    rng = random.Random(8)
    texts = ["".join(rng.choice("aabcdefé  ") for _ in range(rng.randrange(1, 1500))) for _ in range(8)] + ["aaaa", "ab" * 300, "x"]
    for level in (1, 2, 3, 4):
        got = prints(texts, level)[0]
        for text, found in zip(texts, got):
            names, labels = [int(fp._BYTE[b]) for b in text.encode()], list(text.encode())
            for k in range(1, level + 1):
                names, labels = slow_level(names, k, labels), None
            assert found == names, (level, text)


def test_equal_substrings_share_interior_phrases_at_any_offset():
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("abcdefghij klmno\n") for _ in range(n))
    shared = noise(4000)
    whole = set(prints([shared], 3)[0][0])
    for offset in (1, 7, 100, 1001):
        inside = set(prints([noise(offset) + shared + noise(50)], 3)[0][0])
        assert len(whole & inside) > 0.93 * len(whole)
    assert not whole & set(prints([noise(4000)], 3)[0][0])


def test_does_not_depend_on_the_batch():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab cd") for _ in range(rng.randrange(0, 300))) for _ in range(40)] + ["", "a", "aaaa" * 500]
    together = prints(texts)
    for i, t in enumerate(texts):
        if t:
            alone = prints([t])
            assert together[0][i] == alone[0][0] and together[1][i] == alone[1][0] and together[2][i] == alone[2][0]
    same = dict(zip(texts, together[1]))
    assert len(set(same.values())) == len(same)


def test_table(spark):
    rows = [(1, "some text here that is long enough to have phrases " * 9, "x"), (2, None, None), (None, "", None), (1, "some text here that is long enough to have phrases " * 9, "x")]
    got = fp.document_fingerprints(spark.createDataFrame(rows, SCHEMA)).collect()
    assert got[0] == got[3] and got[0].root is not None and got[0].phrases
    assert got[1].phrases is None and got[1].root is None and got[1].n_bytes is None
    assert got[2].phrases == [] and got[2].root is None and got[2].n_bytes == 0
    assert fp.document_fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    shared = fp.shared_phrases(fp.document_fingerprints(spark.createDataFrame([(1, rows[0][1], ""), (5, "zzz " + rows[0][1], "")], SCHEMA))).collect()
    assert shared and all(r.doc_ids == [1, 5] for r in shared)
