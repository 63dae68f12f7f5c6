"""Variable-capacity best-fit packing of documents into training sequences.

Documents fall into groups of bounded size by the hash of their id. In each group, pieces go in order
of decreasing length into the open bin that they fill best. If none holds a piece, each permitted length
is tried on the pieces still to be packed: the longest that fit are counted into it one after another, and
the length is opened whose cost, after shrinking to those contents, is least for each token held. At the end
each bin shrinks to the least permitted length that holds its contents. A piece is a document's tokens plus
one separator; longer documents are cut into pieces of the greatest length, and nothing is left out. Groups
are cut by the number of documents, so packs change with it; their fill doesn't (a group's few last bins).

Defined results: null and empty texts have no tokens and take no place; texts of any length are packed whole;
repeated rows are packed each; ties go by doc_id, then by the piece's start, and of lengths at one cost the
least is opened; a null doc_id stays null; other columns are ignored, whatever their names; an empty table
gives no bin.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.tokens import PATTERN, VOCABULARY, token_lengths
from hemicycle.session import materialize

CAPACITIES = (512, 1024, 2048, 4096, 8192)
GROUP_DOCS = 50_000
_OVERHEAD = 128


def cost(capacity: int) -> float:
    """Work for one sequence: linear layers, attention (quadratic), and a fixed part."""
    return _OVERHEAD + capacity + capacity * capacity / 16384


class _Waiting:
    """Lengths still to be packed, with their numbers; the next length at or below another is found by halving."""

    def __init__(self, lengths: Sequence[int]):
        self.count = Counter(lengths)
        self.sorted = sorted(self.count)

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            del self.count[n], self.sorted[bisect_left(self.sorted, n)]

    def fill(self, space: int) -> int:
        """What the longest that fit, one after another, come to."""
        start = space
        top = len(self.sorted)
        while space and (top := bisect_right(self.sorted, space, 0, top)):
            n = self.sorted[top - 1]
            space -= n * min(self.count[n], space // n)
            top -= 1
        return start - space


def pack(lengths: Sequence[int], capacities: Sequence[int] = CAPACITIES, price: Callable[[int], float] = cost) -> tuple[list[int], list[int], list[int]]:
    """Best fit for pieces in decreasing order: each piece's bin, each bin's contents and its final length."""
    waiting = _Waiting(lengths)
    bins: list[int] = []
    used: list[int] = []
    size: list[int] = []
    room: list[int] = []  # distinct free spaces, ascending
    at: dict[int, list[int]] = {}

    def each_token(n: int, capacity: int) -> tuple[float, int]:
        held = n + waiting.fill(capacity - n)
        return price(next(c for c in capacities if c >= held)) / held, capacity

    for n in lengths:
        waiting.take(n)
        k = bisect_left(room, n)
        if k < len(room):
            free = room[k]
            stack = at[free]
            b = stack.pop()
            if not stack:
                del room[k], at[free]
        else:
            b = len(used)
            size.append(min(each_token(n, c) for c in capacities if c >= n)[1])
            used.append(0)
            free = size[b]
        bins.append(b)
        used[b] += n
        free -= n
        if free:
            if free in at:
                at[free].append(b)
            else:
                at[free] = [b]
                insort(room, free)
    return bins, used, [next(c for c in capacities if c >= u) for u in used]


def _pack_group(capacities: Sequence[int]) -> Callable:
    most = capacities[-1]

    def run(key: tuple[pa.Scalar], rows: pa.Table) -> pa.Table:
        pieces = []
        for i, n in zip(rows.column("doc_id").to_pylist(), rows.column("n").to_pylist(), strict=True):
            pieces += [(s - min(most + s, n), i is None, i or 0, s) for s in range(0, n, most)]
        pieces.sort()  # by length, descending; then by doc_id, nulls last
        bins, used, size = pack([-p[0] for p in pieces], capacities)
        docs: list[list[dict]] = [[] for _ in used]
        for b, (n, null, i, s) in zip(bins, pieces, strict=True):
            docs[b].append({"doc_id": None if null else i, "start": s, "end": s - n})
        first = key[0].as_py() << 32
        return pa.table(
            {
                "pack_id": pa.array([first + b for b in range(len(used))], pa.int64()),
                "capacity": pa.array(size, pa.int32()),
                "n_tokens": pa.array(used, pa.int64()),
                "docs": pa.array(docs, pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))),
            }
        )

    return run


def best_fit_packs(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, path: str = VOCABULARY, pattern: str = PATTERN, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Rows (pack_id, capacity, n_tokens, docs): one for each sequence, with the token ranges that it
    holds; a document's last token is its separator."""
    capacities = sorted(capacities)
    counts = token_lengths(docs, path, pattern).filter("n_tokens > 0")
    sizes = materialize(counts.select(F.col("doc_id").cast("long"), (F.col("n_tokens") + 1).alias("n")), "lengths")
    groups = max(1, math.ceil(sizes.count() / group_docs))
    group = F.pmod(F.xxhash64(F.coalesce("doc_id", F.col("n"))), F.lit(groups)).alias("g")
    return sizes.groupBy(group).applyInArrow(_pack_group(capacities), "pack_id long, capacity int, n_tokens long, docs array<struct<doc_id:long,start:long,end:long>>")
