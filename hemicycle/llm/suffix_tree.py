"""Substring dedup by prefix-partitioned suffix trees.

Suffixes that start at an anchor (see ``repeats``) are split by their first words, and each task builds the
subtrees of its prefixes, about ``chunk`` contexts at a time. The prefix has the anchor's 24 words; where more
contexts than ``group`` share it, it is lengthened to all 50 words asked for, for the suffixes of that group only,
and those that agree on them are aggregated by their hashes. In another group the suffixes are sorted, their common prefixes
give the subtree's internal nodes, and the nodes at depth ``min_words - o`` whose leaves also agree on the ``o``
words to the left are the repeats of at least ``min_words`` words; joined spans of neighbouring anchors are the
maximal repeats.

Defined results: null, empty and short texts repeat nothing; texts of any length are read whole; rows equal in
doc_id and text are one document; a null doc_id stays null; a passage counts where another document holds it, or
the same one at least ``min_words`` words away; columns stay as they are, whatever their names; an empty table
gives an empty table. Of each repeated passage the copy in the document with the smallest doc_id stays (nulls
come last, ties go by the text's hash), and in one document the first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from hemicycle.llm import repeats
from hemicycle.llm._words import mix


def internal_nodes(common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Internal nodes of the tree over sorted suffixes: depth, parent's depth, first leaf, last leaf + 1.
    ``common[i]`` is the common prefix of leaves i and i + 1. Nodes above ``least`` are left out."""
    depth, up, first, last = [], [], [], []
    stack: list[tuple[int, int]] = []
    for i, d in enumerate([*common.tolist(), -1]):
        start = i
        while stack and stack[-1][0] > d:
            deep, start = stack.pop()
            above = max(d, stack[-1][0]) if stack else d
            depth.append(deep)
            up.append(above)
            first.append(start)
            last.append(i + 1)
        if d >= least and (not stack or stack[-1][0] < d):
            stack.append((d, start))
    return tuple(np.array(x, np.int64) for x in (depth, up, first, last))


def resolve(words: np.ndarray, off: np.ndarray, a: np.ndarray, own: np.ndarray, end: np.ndarray, length: int):
    """Equal passages of ``length`` words between the contexts of a group (``repeats._resolved``)."""
    n, size = len(a), np.diff(off)
    left, right = int(a.max(initial=0)), size - a
    wide = np.zeros((n, length), ">u4")  # right of the anchor, in an order that bytes sort
    col = np.arange(length)
    here = col[None, :] < right[:, None]
    wide[here] = (words[(off[:-1] + a)[:, None] + col[None, :]][here] if words.size >= off[-1] + length else words[np.minimum((off[:-1] + a)[:, None] + col[None, :], len(words) - 1)][here]) | 1
    order = np.argsort(np.ascontiguousarray(wide).view(f"S{4 * length}").ravel(), kind="stable")
    wide, a, right, own, end = wide[order], a[order], right[order], own[order], end[order]
    differ = wide[1:] != wide[:-1]
    common = np.where(differ.any(1), differ.argmax(1), length)
    depth, up, first, last = internal_nodes(common, length - left)
    back = np.zeros((n, left + 1), np.uint64)  # hash of the o words to the left
    at = (off[:-1][order] + a).astype(np.int64)
    for o in range(1, left + 1):
        word = np.where(a >= o, words[np.maximum(at - o, 0)], 0).astype(np.uint64)
        back[:, o] = mix(back[:, o - 1] * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(1))
    starts, owners, lows, highs = [], [], [], []
    for o in range(left + 1):
        deep = length - o
        pick = (depth >= deep) & (up < deep)  # the tree, cut at this depth
        if not pick.any():
            continue
        count = (last - first)[pick]
        leaf = np.repeat(first[pick] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        node = np.repeat(np.arange(len(count)), count)
        ok = (a[leaf] >= o) & (right[leaf] >= deep)
        leaf, node = leaf[ok], node[ok]
        if not len(leaf):
            continue
        by = np.lexsort((back[leaf, o], node))
        leaf, node = leaf[by], node[by]
        new = np.concatenate([[True], (node[1:] != node[:-1]) | (back[leaf[1:], o] != back[leaf[:-1], o])])
        cut, group = np.flatnonzero(new), np.cumsum(new) - 1
        start = a[leaf] - o
        lows.append(np.minimum.reduceat(own[leaf] + start, cut)[group])
        highs.append(np.maximum.reduceat(end[leaf] + start, cut)[group])
        starts.append(start)
        owners.append(leaf)
    if not starts:
        zero = np.zeros(n, np.int64)
        return zero, zero, zero, zero
    start, owner, low, high = (np.concatenate(x) for x in (starts, owners, lows, highs))
    found = repeats.marks(a, start, owner, own[owner] + start, low, high, length)
    back_to = np.empty(n, np.int64)
    back_to[order] = np.arange(n)
    return tuple(x[back_to] for x in found)


def suffix_tree_repeats(docs: DataFrame, min_words: int = 50, group: int = repeats.GROUP) -> DataFrame:
    """Rows (doc_id, start_word, end_word, n_words): maximal spans of repeated words."""
    return repeats.report(repeats.repeated_words(docs, resolve, min_words, chunk=20000, group=group))


def remove_repeats(docs: DataFrame, min_words: int = 50, group: int = repeats.GROUP) -> DataFrame:
    """The documents without the passages of which an earlier copy stands. Columns stay as they are; n_chars
    follows the text; documents that end up empty are dropped."""
    return repeats.without_later(docs, repeats.repeated_words(docs, resolve, min_words, chunk=20000, group=group))
