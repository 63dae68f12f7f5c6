"""Near-duplicate groups from bottom-k MinHash sketches of one hash function.

A document's set is its shingles of three lower-cased words; the k least hashes are its sketch.
Documents of equal sets become one node first, so that thousands of copies cost no pairs. Inverted
lists of the retained values generate overlaps: in each sketch the values go from rare to frequent,
and two sketches that share enough values for the threshold must share one of the first few, so lists
of frequent values (passages that many documents hold) are never paired. First each document is held
against one hub, the most copied text of the lists that it is in; those whose exact Jaccard index reaches
the threshold are one class, so that near copies of one text cost a row each, not a pair for each two.
Then the lists that still hold several classes pair the documents of different classes, list by list in
blocks of bounded size. Sets of at most k values are their own sketches, so their pairs are decided there,
and a block returns as many edges as join its classes, not its pairs. Of other pairs the k least values of
the union of two sketches estimate the similarity; those that may reach the threshold go on. Classes that
hang together are brought together, and the exact Jaccard index of the documents' sets decides; a pair
within one class is skipped, as it can't change the groups.

Defined results: null texts and texts without words belong to no group; a text of one or two words is
one shingle; rows equal in doc_id and text are one document; null ids count and stay null; other
columns are ignored; an empty table gives no group. Groups are connected by similar pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemicycle.llm._words import Words, lower_ascii, mix, signed, text_rows
from hemicycle.llm.repeats import doc_id, keyed
from hemicycle.session import materialize

K = 64
SHINGLE = 3
THRESHOLD = 0.5
BLOCK = 2048  # members of an inverted list that a task pairs at a time


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct hashes of its shingles."""
    words = Words(lower_ascii(data), offsets)
    roll = words.rolling()
    total = len(words.hash)
    at = np.arange(total)
    ends = np.repeat(words.rows[1:], words.count)
    grams = roll.of(at, np.minimum(at + n, ends))
    for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist(), strict=True):
        x = np.sort(grams[a : max(b - n + 1, min(a + 1, b))])
        if len(x) > 1:
            x = x[np.concatenate([[True], x[1:] != x[:-1]])]
        yield x


def _sketching(k: int, n: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_rows(batch):
                keep, size, name, parts = [], [], [], []
                for i, x in enumerate(shingle_sets(data, offsets, n)):
                    if len(x):
                        keep.append(a + i)
                        size.append(len(x))
                        name.append(mix(x).sum(dtype=np.uint64))
                        parts.append(x[:k])
                if not keep:
                    continue
                ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                sizes = np.array(size, np.int64)
                names = mix(np.array(name, np.uint64) + sizes.astype(np.uint64))
                sketch = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(np.concatenate(parts))))
                taken = pa.array(keep)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(taken), batch.column("t").take(taken), pa.array(signed(names)), pa.array(sizes), sketch], ["id", "t", "node", "n", "sketch"])

    return run


def estimate(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Jaccard index from the k least values of the union of two sketches (sorted, distinct)."""
    both = np.sort(np.concatenate([a, b]))
    return float(_scores(both[None], k, np.array([len(both)]))[0])


def _scores(both: np.ndarray, k: int | np.ndarray, size: np.ndarray) -> np.ndarray:
    """``estimate`` of many pairs: each row has the sorted values of both sketches in its first ``size`` places."""
    twice = both[:, 1:] == both[:, :-1]
    twice &= np.arange(1, both.shape[1]) < size[:, None]
    seen = np.cumsum(twice, 1, dtype=np.int16)
    rank = np.arange(2, both.shape[1] + 1, dtype=np.int16) - seen  # distinct values up to here
    top = np.minimum(k, size - seen[:, -1])
    return np.count_nonzero(twice & (rank <= top[:, None]), 1) / top


def _joined(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Joins the groups of p and q in ``root``, which names each one's group; the edges that were needed."""
    low, high = np.minimum(root[p], root[q]), np.maximum(root[p], root[q])
    taken = []
    for both in np.unique((low * len(root) + high)[low != high]).tolist():
        x, y = divmod(both, len(root))
        while root[x] != x:
            x = int(root[x])
        while root[y] != y:
            y = int(root[y])
        if x != y:
            root[max(x, y)] = min(x, y)
            taken.append((x, y))
    while ((up := root[root]) != root).any():
        root[:] = up
    edges = np.array(taken, np.int64).reshape(-1, 2)
    return edges[:, 0], edges[:, 1]


def _pairing(k: int, threshold: float, least: float, most: int = 1 << 15) -> Callable:
    """Rows sorted by (value, i, j), a block of an inverted list. Edges between classes (a and b are null) as pairs
    of whole sketches decide them, and pairs of documents of different classes whose estimate reaches ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            table = table.combine_chunks()
            value, i, j, part, node, comp, n = (table.column(x).to_numpy() for x in ("value", "i", "j", "part", "node", "comp", "n"))
            names, group = np.unique(comp, return_inverse=True)
            root = np.arange(len(names))
            lists = table.column("sketch").combine_chunks()
            size = np.diff(lists.offsets.to_numpy())
            sketch = np.full((len(size), k), 0xFFFFFFFFFFFFFFFF, np.uint64)
            sketch[np.arange(k) < size[:, None]] = lists.flatten().to_numpy().view(np.uint64)
            ends = np.flatnonzero(np.concatenate([(value[1:] != value[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True]])) + 1
            last = np.repeat(ends, np.diff(np.concatenate([[0], ends])))
            many = last - np.arange(len(last)) - 1  # rows after this one in its block
            upto = np.concatenate([[0], np.cumsum(many)])
            at = 0
            while at < len(many):
                to = max(at + 1, int(np.searchsorted(upto, upto[at] + most, "right")) - 1)
                x = np.repeat(np.arange(at, to), many[at:to])
                y = x + 1 + np.arange(len(x)) - (upto[x] - upto[at])
                at = to
                ok = (root[group[x]] != root[group[y]]) & (n[x] >= threshold * n[y]) & (n[y] >= threshold * n[x]) & ((i[x] == j[x]) | (part[x] != part[y]))
                x, y = x[ok], y[ok]
                if not len(x):
                    continue
                both = np.sort(np.concatenate([sketch[x], sketch[y]], 1), 1)
                sure = (n[x] <= k) & (n[y] <= k)
                score = _scores(both, np.where(sure, 2 * k, k), size[x] + size[y])
                ok = score >= np.where(sure, threshold, least)
                x, y, sure, score = x[ok], y[ok], sure[ok], score[ok]
                p, q = _joined(root, group[x[sure]], group[y[sure]])
                if len(p):
                    none = pa.nulls(len(p), pa.int64())
                    yield pa.RecordBatch.from_arrays([none, none, *map(pa.array, (names[p], names[q], np.ones(len(p))))], ["a", "b", "ca", "cb", "score"])
                ok = ~sure & (root[group[x]] != root[group[y]])
                x, y, score = x[ok], y[ok], score[ok]
                swap = node[x] > node[y]
                x, y = np.where(swap, y, x), np.where(swap, x, y)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (node[x], node[y], comp[x], comp[y], score))], ["a", "b", "ca", "cb", "score"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            keys = [table.column(x).to_numpy() for x in ("value", "i", "j")]
            new = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in keys])) + 1
            if len(new):
                yield from flush(table.slice(0, int(new[-1])))
                held = table.slice(int(new[-1])).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield from flush(pa.Table.from_batches(held))

    return run


def similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    """Whether the Jaccard index of two sorted sets reaches the threshold."""
    both = np.sort(np.concatenate([x, y]))
    common = np.count_nonzero(both[1:] == both[:-1])
    return common >= threshold * (len(both) - common)


def needed(size: int, k: int, threshold: float) -> int:
    """Values that two sketches share, but in one case of a thousand, where the sets reach the threshold."""
    if size <= threshold * k:
        return max(1, math.ceil(threshold * size - 1e-9))  # neither sketch leaves anything out
    return max(1, math.floor(threshold * size - 3.1 * math.sqrt(size * threshold * (1 - threshold))))


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """(node, comp) of an undirected graph (a, b), by alternating large and small stars; the lineage is
    cut on each round, and rounds grow with the logarithm of the diameter."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = F.least(F.min("v").over(Window.partitionBy("u")), F.col("u"))
        large = both.withColumn("m", least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = low.select("u", F.col("m").alias("v")).unionByName(low.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        edges = materialize(small, name)
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        state = new


def _starring(n: int, threshold: float) -> Callable:
    """Rows sorted by hub, the hub's own first: the members whose sets are similar to the hub's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = of = None
        for batch in batches:
            hubs, nodes, found = batch.column("hub").to_pylist(), batch.column("node").to_pylist(), []
            for a, b, data, offsets in text_rows(batch):
                for i, x in zip(range(a, b), shingle_sets(data, offsets, n), strict=True):
                    if nodes[i] == hubs[i]:
                        hub, of = nodes[i], x
                    elif hub == hubs[i] and similar(of, x, threshold):
                        found.append(i)
            yield pa.RecordBatch.from_arrays([batch.column("hub").take(pa.array(found, pa.int64())), batch.column("node").take(pa.array(found, pa.int64()))], ["a", "b"])

    return run


def _verifying(n: int, threshold: float) -> Callable:
    """Rows sorted by component, its documents first and then the candidate pairs, the likeliest first: exact
    similarity along pairs of different groups, and groups of classes by union-find. A component's sets are
    held, its pairs pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top, sets, root = None, {}, {}

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(root), pa.int64()), pa.array([find(c) for c in root], pa.int64())], ["comp", "root"])

        for batch in batches:
            tops, nodes, comps, others, others_comps = (batch.column(x).to_pylist() for x in ("top", "a", "ca", "b", "cb"))
            for a, b, data, offsets in text_rows(batch):
                for i, x in zip(range(a, b), shingle_sets(data, offsets, n), strict=True):
                    if tops[i] != top:
                        if root:
                            yield flush()
                        top, sets, root = tops[i], {}, {}
                    if others[i] is None:
                        sets[nodes[i]] = x
                        root.setdefault(comps[i], comps[i])
                        continue
                    p, q = find(comps[i]), find(others_comps[i])
                    if p != q and similar(sets[nodes[i]], sets[others[i]], threshold):
                        root[max(p, q)] = min(p, q)
        if root:
            yield flush()

    return run


def _named(edges: DataFrame, name: str) -> DataFrame:
    """``components``, with a row for each node that names a component too."""
    found = components(edges, name)
    return found.unionByName(found.select(F.col("comp").alias("node"), "comp").distinct())


def _stars(prefix: DataFrame, nodes: DataFrame, keys: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """(a, b): each document and its hub, where they are similar. Of the lists that a document is in, each has its
    most copied text as a hub; the hub that most of them have is the document's."""
    hubs = prefix.groupBy("value").agg(F.max(F.struct("copies", "node", "n")).alias("hub"))
    close = (F.col("n") >= threshold * F.col("hub.n")) & (F.col("hub.n") >= threshold * F.col("n"))
    votes = prefix.join(hubs, "value").filter((F.col("node") != F.col("hub.node")) & close).groupBy("node", F.col("hub.node").alias("hub")).agg(F.count("*").alias("votes"))
    best = materialize(votes.groupBy("node").agg(F.max(F.struct("votes", "hub"))["hub"].alias("hub")), "hubs")
    asked = best.unionByName(best.select(F.col("hub").alias("node"), "hub").distinct())
    return (
        asked.join(nodes.select("node", "doc.id", "doc.t"), "node")
        .join(keys, ["id", "t"])
        .select("hub", "node", "text")
        .repartition("hub")
        .sortWithinPartitions("hub", F.col("node") != F.col("hub"))
        .mapInArrow(_starring(shingle, threshold), "a long, b long")
    )


def similar_groups(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(id, t, root): every document that has words, and its group's name."""
    keys = keyed(docs)
    sketches = materialize(keys.mapInArrow(_sketching(k, shingle), "id long, t long, node long, n long, sketch array<long>"), "sketches")
    nodes = materialize(sketches.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.min(F.struct("id", "t")).alias("doc"), F.count("*").alias("copies")), "nodes")
    size = F.size("sketch")
    need = F.element_at(F.array(*(F.lit(needed(s, k, threshold)) for s in range(1, k + 1))), F.col("s"))
    lists = nodes.select("node", "n", "copies", size.alias("s"), F.explode("sketch").alias("value"))
    shared = lists.withColumn("df", F.count("*").over(Window.partitionBy("value"))).filter("df > 1")
    of = Window.partitionBy("node")
    prefix = (
        shared.withColumn("rank", F.row_number().over(of.orderBy("df", "value")))
        .withColumn("common", F.count("*").over(of))
        .filter(F.col("s") - F.col("common") + F.col("rank") <= F.col("s") - need + 1)
        .select("value", "node", "n", "copies")
    )
    prefix = materialize(prefix, "prefix")
    stars = _named(_stars(prefix, nodes, keys, threshold, shingle), "stars")
    classes = materialize(prefix.select("node").distinct().join(stars, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")), "classes")
    # Lists of several classes, in blocks: a member of part p goes to the blocks of p and each part.
    members = materialize(prefix.select("value", "node").join(classes, "node"), "members")
    mixed = members.groupBy("value").agg(F.count("*").alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    parts = F.ceil(F.col("m") / block).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (
        members.join(mixed, "value")
        .select("value", "node", "comp", part.alias("part"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
        .join(nodes.select("node", "n", "sketch"), "node")
        .select("value", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", "comp", "n", "sketch")
        .repartition(tasks, "value", "i", "j")
        .sortWithinPartitions("value", "i", "j")
    )
    slack = 3.1 * math.sqrt(threshold * (1 - threshold) / k)
    pairs = blocks.mapInArrow(_pairing(k, threshold, threshold - slack), "a long, b long, ca long, cb long, score double")
    pairs = materialize(pairs.distinct(), "pairs")
    sure = materialize(_named(pairs.filter("a is null").select(F.col("ca").alias("a"), F.col("cb").alias("b")), "sure"), "sure")
    classes = materialize(classes.join(sure.toDF("comp", "to"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "classes")
    likely = pairs.filter("a is not null").join(sure.toDF("ca", "to_a"), "ca", "left").join(sure.toDF("cb", "to_b"), "cb", "left")
    likely = likely.select("a", "b", F.coalesce("to_a", "ca").alias("ca"), F.coalesce("to_b", "cb").alias("cb"), "score")
    likely = materialize(likely.filter("ca <> cb").distinct(), "likely")
    tops = materialize(_named(likely.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "tops").toDF("ca", "top"), "tops")
    ends = likely.select("a", "ca").unionByName(likely.select(F.col("b").alias("a"), F.col("cb").alias("ca"))).distinct()
    none = F.lit(None)
    sets = ends.join(nodes.select(F.col("node").alias("a"), "doc.id", "doc.t"), "a").join(keys, ["id", "t"])
    sets = sets.select("a", "ca", none.cast("long").alias("b"), none.cast("long").alias("cb"), F.lit(2.0).alias("score"), "text")
    found = (
        sets.unionByName(likely.select("a", "ca", "b", "cb", "score", none.cast("string").alias("text")))
        .join(tops, "ca")
        .repartition("top")
        .sortWithinPartitions("top", F.desc("score"), "a", "b")
        .select("top", "a", "ca", "b", "cb", "text")
        .mapInArrow(_verifying(shingle, threshold), "comp long, root long")
    )
    roots = classes.join(found, "comp", "left").select("node", F.coalesce("root", "comp").alias("root"))
    return sketches.select("id", "t", "node").join(roots, "node", "left").select("id", "t", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Rows (keep_doc_id, doc_ids, n_docs): the groups of two or more documents; the one that stays has
    the smallest doc_id (a null comes last)."""
    groups = similar_groups(docs, threshold, k, shingle).distinct()
    ids = F.transform(F.sort_array(F.collect_list(F.struct("id", "t"))), lambda x: doc_id(x["id"], x["t"]))
    return groups.groupBy("root").agg(ids.alias("doc_ids"), F.count("*").alias("n_docs")).filter("n_docs > 1").select(F.col("doc_ids")[0].alias("keep_doc_id"), "doc_ids", "n_docs")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """The documents, one of each group; those without words stay. Of equal rows one stays."""
    groups = materialize(similar_groups(docs, threshold, k, shingle), "groups")
    firsts = groups.groupBy("root").agg(F.min(F.struct("id", "t")).alias("first"))
    marks = groups.join(firsts, "root").groupBy("id", "t").agg(F.min((F.struct("id", "t") == F.col("first"))).alias("stays"), (F.count("*") > 1).alias("twice"))
    rows = keyed(docs, F.struct("*").alias("row")).drop("text").join(marks.filter("not stays or twice"), ["id", "t"], "left")
    once = rows.filter("stays and twice").groupBy("id", "t").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return rows.filter("stays is null").select("row.*").unionByName(once.select("row.*"))
