"""Where word passages repeat: the part suffix arrays and suffix trees share.

Every passage of ``min_words`` words holds at least one anchor: the least k-gram hash among the
``w`` k-grams of the passage (k + w - 1 = min_words). Equal passages pick equal anchors, whatever
their offset, so only an anchor that stands in two places (two documents, or one at least ``min_words``
words apart) can repeat. For each occurrence the context that its passages can reach (w - 1 words
before, min_words after) is hashed; equal contexts (64 bits, below one anchor's 64) are one class, and
only anchors with several classes need their text, which is fetched once a class. A resolver (suffix
array or suffix tree) then finds the equal passages between classes, exactly.

Groups: contexts are partitioned by a prefix of their suffixes, the anchor's k words. Where more than
``group`` contexts have one prefix, the prefix grows to all ``min_words`` words: suffixes that agree on them
(64 bits, below one anchor's 64) are one class again, which is aggregated, whatever its size, without words.

Cost at scale: anchors are about 2 / (w + 1) of the words. Anchors and classes are aggregated before they
are shuffled and joined back, so that a passage in very many documents is split as any skewed join is; texts
cross the network once, only toward the classes that need them. No step pairs documents with one another,
so a passage that n documents share costs n rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemicycle.llm._words import _Q, Rolling, Words, mix, signed, sliding, text_rows
from hemicycle.session import materialize

NO_ID = (1 << 63) - 1
KGRAM = 24
GROUP = 20_000  # contexts of one prefix that a task holds at a time
_KEY = "id long, t long, pos int, lid long, lt long, lpos int"  # a place, and the last place of its class
_OCC = "h long, c long, id long, t long, pos int, a short, b short"
_CTX = f"h long, {_KEY}, a short, hot short, words binary"
_RES = "id long, t long, pos int, dup_lo short, dup_hi short, later_lo short, later_hi short"


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """id: doc_id, nulls as the greatest value; t: 63 bits of the text's hash, and a last bit that is set where
    the id is null. Together they name a document, so that repeated rows are one document and one id with two
    texts is two."""
    null = F.col("doc_id").isNull()
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
        F.xxhash64("text").bitwiseAND(F.lit(-2)).bitwiseOR(F.when(null, 1).otherwise(0)).alias("t"),
        F.col("text").alias("text"),
        *more,
    )


def doc_id(key: Column, text: Column) -> Column:
    """The doc_id of ``keyed``'s id and t."""
    return F.when(text.bitwiseAND(F.lit(1)) == 0, key)


def anchor_positions(words: Words, k: int, length: int) -> np.ndarray:
    """Positions whose k-gram is the least of some passage of ``length`` words within one row."""
    n, w = len(words.hash), length - k + 1
    if n < length:
        return np.zeros(0, np.int64)
    at = np.arange(n - k + 1)
    grams = words.rolling().of(at, at + k)
    ends = np.repeat(words.rows[1:], words.count)
    grams[at + k > ends[at]] = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = sliding(grams, w, np.minimum)
    least[np.arange(len(least)) + length > ends[: len(least)]] = 0
    padded = np.zeros(len(least) + 2 * (w - 1), np.uint64)
    padded[w - 1 : w - 1 + len(least)] = least
    top = sliding(padded, w, np.maximum)
    return np.flatnonzero(top == grams)


def _anchors(k: int, length: int) -> Callable:
    w = length - k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ts = batch.column("id").to_numpy(), batch.column("t").to_numpy()
            for a, b, data, offsets in text_rows(batch):
                words = Words(data, offsets)
                pos = anchor_positions(words, k, length)
                if not len(pos):
                    continue
                row = np.searchsorted(words.rows, pos, "right") - 1
                lo = np.maximum(words.rows[row], pos - w + 1)
                hi = np.minimum(words.rows[row + 1], pos + length)
                roll = words.rolling()
                before, after = (pos - lo).astype(np.int16), (hi - pos).astype(np.int16)
                context = roll.of(lo, hi) ^ roll.of(pos, hi)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (signed(roll.of(pos, pos + k)), signed(context), ids[a:b][row], ts[a:b][row], (pos - words.rows[row]).astype(np.int32), before, after)],
                    ["h", "c", "id", "t", "pos", "a", "b"],
                )

    return run


def _binary(words: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32) * 4
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(words)])


def _spread(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... of each, one after another."""
    return np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words (32-bit hashes) of the asked contexts of each document."""
    for batch in batches:
        want = batch.column("want")
        ids, ts = batch.column("id").to_numpy(), batch.column("t").to_numpy()
        for a, b, data, offsets in text_rows(batch):
            words = Words(data, offsets)
            short = (words.hash >> np.uint64(32)).astype(np.uint32)
            part = want.slice(a, b - a)
            flat = part.flatten()
            row = np.repeat(np.arange(b - a), np.diff(part.offsets.to_numpy()))
            h, pos, lid, lt, lpos, before, after, hot = (flat.field(i).to_numpy() for i in range(8))
            lo, size = words.rows[row] + pos - before, before.astype(np.int64) + after
            columns = h, ids[a:b][row], ts[a:b][row], pos, lid, lt, lpos, before, hot
            names = ["h", "id", "t", "pos", "lid", "lt", "lpos", "a", "hot", "words"]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), _binary(short[_spread(lo, size)], size)], names)


def _words_of(blob: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    off = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64) // 4
    return np.frombuffer(blob.buffers()[2] or b"", np.uint32), off


def _suffixes(length: int) -> Callable:
    """Each suffix of a context, cut to ``length`` words: its place, its class's last one and its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, off = _words_of(batch.column("words"))
            many = np.maximum(np.diff(off) - length + 1, 0)
            ctx = np.repeat(np.arange(len(many)), many)
            start = _spread(np.zeros(len(many), np.int64), many)
            at = off[ctx] + start
            roll = Rolling(mix(words.astype(np.uint64) + np.uint64(1)), _Q)
            shift = (start - batch.column("a").to_numpy()[ctx]).astype(np.int32)
            columns = {n: batch.column(n).to_numpy()[ctx] for n in ("h", "id", "t", "pos", "lid", "lt", "lpos")}
            columns |= {"pos": columns["pos"] + shift, "lpos": columns["lpos"] + shift, "p": signed(roll.of(at, at + length))}
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns.values())], [*columns])

    return run


def _resolved(resolve: Callable, length: int, chunk: int) -> Callable:
    """Feed whole prefix groups (rows sorted by h) to the resolver, about ``chunk`` contexts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            if table.num_rows:
                h, ids, ts, pos = (table.column(x).to_numpy() for x in ("h", "id", "t", "pos"))
                order = np.lexsort((pos, ts, ids, h))
                again = np.zeros(len(h), bool)  # repeated rows give a place twice
                x, y = order[1:], order[:-1]
                again[x] = (h[x] == h[y]) & (ids[x] == ids[y]) & (ts[x] == ts[y]) & (pos[x] == pos[y])
                table = table.filter(pa.array(~again))
                ids, ts, pos, lid, lt, lpos, a = (table.column(x).to_numpy() for x in ("id", "t", "pos", "lid", "lt", "lpos", "a"))
                words, off = _words_of(table.column("words").combine_chunks())
                every = np.concatenate([ids, lid]), np.concatenate([ts, lt])
                order = np.lexsort(every[::-1])
                rank = np.empty(len(order), np.int64)
                new = (every[0][order[1:]] != every[0][order[:-1]]) | (every[1][order[1:]] != every[1][order[:-1]])
                rank[order] = np.concatenate([[0], np.cumsum(new)])
                a = a.astype(np.int64)
                first, last = (rank[: len(ids)] << 32) + pos - a, (rank[len(ids) :] << 32) + lpos - a
                found = resolve(words, off, a, first, last, length)
                columns = ids, ts, pos, *(x.astype(np.int16) for x in found)
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["id", "t", "pos", "dup_lo", "dup_hi", "later_lo", "later_hi"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= chunk:
                table = pa.Table.from_batches(held)
                h = table.column("h").to_numpy()
                ends, start = np.flatnonzero(h[1:] != h[:-1]) + 1, 0
                while len(ends := ends[ends >= start + chunk]):
                    yield from flush(table.slice(start, ends[0] - start))
                    start = int(ends[0])
                held = table.slice(start).combine_chunks().to_batches()
                rows -= start
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run


def marks(a: np.ndarray, start: np.ndarray, ctx: np.ndarray, own: np.ndarray, least: np.ndarray, most: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """For each context, the spans (relative to its anchor) of its passages that stand elsewhere too, and of
    those that stand earlier: ``own``, ``least`` and ``most`` are a passage's place and its group's first and
    last, documents' ranks in the high half. All of a context's passages hold its anchor, so their union is one
    span; empty: (0, 0)."""
    earlier = own - least >= length  # another document's place is further than any length
    out = []
    for mark in (earlier | (most - own >= length), earlier):
        lo, hi = np.full(len(a), 1 << 30), np.full(len(a), -(1 << 30))
        np.minimum.at(lo, ctx[mark], start[mark] - a[ctx[mark]])
        np.maximum.at(hi, ctx[mark], start[mark] - a[ctx[mark]] + length)
        none = hi < lo
        lo[none] = hi[none] = 0
        out += [lo, hi]
    return tuple(out)


def _far(place: Column, other: Column, length: int) -> Column:
    """Two places (id, t, pos) in two documents, or ``length`` words apart."""
    return (place["id"] != other["id"]) | (place["t"] != other["t"]) | (F.abs(place["pos"] - other["pos"]) >= length)


def _equal(suffixes: DataFrame, length: int) -> DataFrame:
    """Spans (id, t, lo, hi, later) of the suffixes that agree on all ``length`` words with one elsewhere."""
    first, last = F.struct("id", "t", "pos"), F.struct(F.col("lid").alias("id"), F.col("lt").alias("t"), F.col("lpos").alias("pos"))
    ends = suffixes.groupBy("h", "p").agg(F.min(first).alias("first"), F.max(last).alias("last")).filter(_far(F.col("first"), F.col("last"), length))
    each = suffixes.select("h", "p", "id", "t", "pos").join(ends, ["h", "p"]).withColumn("own", first)
    each = each.withColumn("later", _far(F.col("own"), F.col("first"), length)).filter(F.col("later") | _far(F.col("own"), F.col("last"), length))
    kinds = F.when(F.col("later"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return each.select("id", "t", F.col("pos").alias("lo"), (F.col("pos") + length).alias("hi"), F.explode(kinds).alias("later"))


def repeated_words(docs: DataFrame, resolve: Callable, min_words: int, kgram: int = KGRAM, chunk: int = 8000, group: int = GROUP) -> DataFrame:
    """(id, t, lo, hi, later): spans of words that stand elsewhere too, in another document or in the same one at
    least ``min_words`` words away. ``later`` spans are those of which an earlier copy stands in a document with
    a smaller (doc_id, text hash), or before in the same one. Spans of one kind may overlap."""
    if min_words <= kgram:
        kgram = max(1, min_words // 2)
    keys = keyed(docs)
    occ = keys.mapInArrow(_anchors(kgram, min_words), _OCC)
    doc = F.xxhash64("id", "t")
    ends = [f(x).alias(f"{f.__name__}_{n}") for n, x in (("d", doc), ("p", F.col("pos")), ("c", F.col("c"))) for f in (F.min, F.max)]
    anchors = occ.groupBy("h").agg(*ends).filter(f"min_d <> max_d or max_p - min_p >= {min_words}").select("h", (F.col("min_c") != F.col("max_c")).alias("mixed"))
    occ = materialize(occ.join(anchors, "h"), "anchors")
    place = F.struct("id", "t", "pos")
    classes = occ.groupBy("h", "c").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    occ = (
        occ.join(classes, ["h", "c"])
        .withColumn("later", _far(place, F.col("first"), min_words))
        .withColumn("dup", F.col("later") | _far(place, F.col("last"), min_words))
        .withColumn("last", F.when(F.col("mixed") & ~F.col("later"), F.col("last")))
        .select("h", "id", "t", "pos", "a", "b", "later", "dup", "last")
    )
    occ = materialize(occ, "repeats")
    whole = (F.col("pos") - F.col("a")).alias("lo"), (F.col("pos") + F.col("b")).alias("hi")
    out = occ.filter("dup").select("id", "t", *whole, F.lit(False).alias("later"))
    out = out.unionByName(occ.filter("later").select("id", "t", *whole, F.lit(True).alias("later")))
    # For the first places of a class, the resolver says which passages other classes hold.
    part = occ.filter("last is not null")
    hot = materialize(part.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > group).select("h", F.lit(1).cast("short").alias("hot")), "hot")
    asked = F.struct("h", "pos", F.col("last.id"), F.col("last.t"), F.col("last.pos"), "a", "b", "hot")

    def contexts(places: DataFrame) -> DataFrame:
        want = places.groupBy("id", "t").agg(F.collect_set(asked).alias("want"))
        return keys.join(want, ["id", "t"]).mapInArrow(_contexts, _CTX)

    def resolved(rows: DataFrame) -> DataFrame:
        tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = rows.repartition(tasks, "h").sortWithinPartitions("h").mapInArrow(_resolved(resolve, min_words, chunk), _RES)
        span = lambda x: ((F.col("pos") + F.col(f"{x}_lo")).alias("lo"), (F.col("pos") + F.col(f"{x}_hi")).alias("hi"), F.lit(x == "later").alias("later"))
        spans = [F.struct(*span(x)) for x in ("dup", "later")]
        return found.select("id", "t", F.explode(F.array(*spans)).alias("s")).select("id", "t", "s.*").filter("hi > lo")

    if hot.isEmpty():
        return out.unionByName(resolved(contexts(part.withColumn("hot", F.lit(0).cast("short")))))
    # Texts are shuffled once, for the hot prefixes and the others.
    places = part.join(hot, "h", "left").withColumn("hot", F.coalesce("hot", F.lit(0).cast("short")))
    every = materialize(contexts(places), "contexts")
    suffixes = materialize(every.filter("hot = 1").mapInArrow(_suffixes(min_words), f"h long, {_KEY}, p long"), "suffixes")
    return out.unionByName(resolved(every.filter("hot = 0"))).unionByName(_equal(suffixes, min_words))


def merged(spans: DataFrame) -> DataFrame:
    """Overlapping or touching spans of a document become one."""
    by = Window.partitionBy("id", "t").orderBy("lo", "hi")
    before = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    return (
        spans.withColumn("new", F.when(before.isNull() | (F.col("lo") > before), 1).otherwise(0))
        .withColumn("island", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "t", "island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("island")
    )


def report(spans: DataFrame) -> DataFrame:
    """One row for each repeated span: doc_id, first word, end, number of words."""
    return merged(spans.filter("not later")).select(
        doc_id(F.col("id"), F.col("t")).alias("doc_id"),
        F.col("lo").alias("start_word"),
        F.col("hi").alias("end_word"),
        (F.col("hi") - F.col("lo")).alias("n_words"),
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans, texts = batch.column("spans").to_pylist(), []
        column = batch.column("text")
        for a, b, data, offsets in text_rows(batch):
            words = None
            for i in range(a, b):
                if not spans[i]:
                    texts.append(column[i].as_py())
                    continue
                words = words or Words(data, offsets, hashes=False)
                row = i - a
                first, last = words.rows[row], words.rows[row + 1]
                raw, parts, at = data, [], offsets[row]
                for s in sorted(spans[i], key=lambda s: s["lo"]):
                    parts.append(raw[at : words.start[first + s["lo"]]].tobytes())
                    end = first + s["hi"]
                    at = words.start[end] if end < last else offsets[row + 1]
                parts.append(raw[at : offsets[row + 1]].tobytes())
                texts.append(b"".join(parts).decode().strip())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])


def quoted(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def without_later(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents, without the spans of which an earlier copy stands; those left empty go."""
    names = docs.columns
    cut = merged(spans.filter("later")).groupBy("id", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    rows = keyed(docs, F.struct(*quoted([n for n in names if n != "text"])).alias("row")).join(cut, ["id", "t"], "left")
    kept, changed = rows.filter("spans is null").select("row", "text"), rows.filter("spans is not null").select("row", "text", "spans")
    schema = kept.schema
    new = changed.mapInArrow(_cut, schema).filter("text <> ''")
    kind = dict(docs.dtypes).get("n_chars")

    def columns(df: DataFrame, cut: bool) -> DataFrame:
        of = lambda n: F.col("text") if n == "text" else F.length("text").cast(kind) if n == "n_chars" and cut else F.col("row").getField(n)
        return df.select(*(of(n).alias(n) for n in names))

    return columns(kept, False).unionByName(columns(new, True))
