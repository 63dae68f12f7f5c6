"""Suffix-array dedup by induced sorting.

The contexts of repeated anchors (see ``repeats``) form the shards. In each shard, suffixes are
classified as S or L, leftmost-smaller substrings are sorted and named (recursively, where names
tie), the whole array is induced from them in linear time, and common prefixes are computed in
text order (the permuted array, by Karkkainen, Manzini and Puglisi). Neighbours in the array
that share ``min_words`` words are equal passages. Contexts that are equal as a whole stand for one
another by their hashes (64 bits, below an anchor's 64) and enter the array once.

Defined results: null and empty texts, and texts of fewer than ``min_words`` words, repeat nothing;
texts of any length are read whole; rows equal in doc_id and text are one document; a null doc_id is a
document whose id stays null; a passage counts where another document holds it, or the same one at least
``min_words`` words away; every copy is reported, so ties need no rule; other columns are ignored,
whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from hemicycle.llm import repeats


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of non-negative integers by induced sorting; a least sentinel is added and removed."""
    s = np.empty(len(text) + 1, np.int64)
    s[:-1] = text + 1
    s[-1] = 0
    return _induced(s)[1:]


def _induced(s: np.ndarray) -> np.ndarray:
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    step = np.sign(s[1:] - s[:-1])
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    stype = np.ones(n, bool)  # the sentinel makes the last step fall, so ``at`` always finds one
    stype[:-1] = step[at] > 0
    lms = np.flatnonzero(stype[1:] & ~stype[:-1]) + 1
    counts = np.bincount(s)
    tails = np.cumsum(counts)
    heads = tails - counts
    symbols, types = s.tolist(), stype.tolist()

    def induce(order: np.ndarray) -> list[int]:
        sa = np.full(n, -1, np.int64)
        key = s[order]  # ascending; each bucket's last places, in this order
        last = np.searchsorted(key, key, "right")
        sa[tails[key] - (last - np.arange(len(order)))] = order
        sa = sa.tolist()
        head = heads.tolist()
        for i in sa:
            if i > 0 and not types[i - 1]:
                i -= 1
                c = symbols[i]
                sa[head[c]] = i
                head[c] += 1
        tail = tails.tolist()
        for k in range(n - 1, -1, -1):
            i = sa[k]
            if i > 0 and types[i - 1]:
                i -= 1
                c = symbols[i]
                tail[c] -= 1
                sa[tail[c]] = i
        return sa

    first = np.array(induce(lms[np.argsort(s[lms], kind="stable")]), np.int64)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    ordered = first[is_lms[first]]
    end = np.full(n, n, np.int64)
    end[lms[:-1]] = lms[1:] + 1
    length = end[ordered] - ordered
    same = length[1:] == length[:-1]
    pair = np.flatnonzero(same)
    if len(pair):
        size = length[pair]
        base = np.repeat(np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        inner = np.arange(size.sum()) - base
        equal = s[np.repeat(ordered[pair], size) + inner] == s[np.repeat(ordered[pair + 1], size) + inner]
        same[pair] = np.logical_and.reduceat(equal, np.concatenate([[0], np.cumsum(size)[:-1]]))
    names = np.zeros(n, np.int64)
    names[ordered] = np.concatenate([[0], np.cumsum(~same)])
    reduced = names[lms]
    if reduced.max() + 1 < len(lms):
        ordered = lms[_induced(reduced)]
    return np.array(induce(ordered), np.int64)


def permuted_common_prefixes(text: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position, the common prefix (up to ``most``) with the suffix before it in the array."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    s, out, size = text.tolist(), [0] * n, 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            size = 0
            continue
        top = min(most, n - i, n - j)
        while size < top and s[i + size] == s[j + size]:
            size += 1
        out[i] = size
        if size:
            size -= 1
    return np.array(out, np.int64)


def resolve(words: np.ndarray, off: np.ndarray, a: np.ndarray, own: np.ndarray, end: np.ndarray, length: int):
    """Equal passages of ``length`` words between the contexts of a shard (``repeats._resolved``)."""
    size = np.diff(off)
    symbols = np.unique(words[off[0] : off[-1]], return_inverse=True)[1] + 1
    text = np.zeros(len(symbols) + len(size), np.int64)  # 0 parts the contexts
    place = np.arange(len(symbols)) + np.repeat(np.arange(len(size)), size)
    text[place] = symbols
    sa = suffix_array(text)
    common = permuted_common_prefixes(text, sa, length)[sa]
    begin = off[:-1] - off[0] + np.arange(len(size))
    ctx = np.searchsorted(begin, sa, "right") - 1
    start = sa - begin[ctx]
    run = np.cumsum(common < length)
    ok = start + length <= size[ctx]
    ctx, start, run = ctx[ok], start[ok], run[ok]
    if not len(run):
        zero = np.zeros(len(size), np.int64)
        return zero, zero, zero, zero
    cut = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    group = np.cumsum(np.concatenate([[0], run[1:] != run[:-1]]))
    here = own[ctx] + start
    least, most = np.minimum.reduceat(here, cut)[group], np.maximum.reduceat(end[ctx] + start, cut)[group]
    return repeats.marks(a, start, ctx, here, least, most, length)


def suffix_array_repeats(docs: DataFrame, min_words: int = 50, group: int = repeats.GROUP) -> DataFrame:
    """Rows (doc_id, start_word, end_word, n_words): the spans of words that lie in passages of
    ``min_words`` or more words which stand elsewhere too."""
    return repeats.report(repeats.repeated_words(docs, resolve, min_words, group=group))
