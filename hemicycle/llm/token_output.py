"""Token-id output: one zstandard frame a document, all with one shared dictionary.

The dictionary is trained on the serialized ids of every document, all of which zstandard's fast cover counts
(accel=1): each partition trains one on all of its documents, then groups of dictionaries are trained into one
until a single one is left; in these later levels the samples are 1 KB pieces of dictionaries. Below 8 samples
or 8 KiB, or where the trainer finds too little to repeat, the samples' last bytes are the dictionary. Each
document is compressed by itself, so that a reader takes only its bytes: the index has shard, offset
and length, and the dictionary's hash guards against decoding with another one. The result holds the
dictionary itself, on the first row of each shard, so that nothing else is needed to decode it.

Defined results: a null text gives a row with nulls for frame and token count and no bytes; an empty
text gives an empty array's frame; texts of any length are one frame; repeated rows are stored each; rows have
no order but that of the scan, so ties need no rule; a null doc_id stays null; other columns are ignored,
whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.llm.tokens import PATTERN, VOCABULARY, token_ids
from hemicycle.session import materialize

DICTIONARY_BYTES = 112_640
LEVEL = 3
FAN_IN = 32
_TRAIN_MB = 8
_TRAINED = "part long, dictionary binary"


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary's content; with too little to train on, the samples themselves."""
    samples = [s for s in samples if s]
    total = sum(map(len, samples))
    if len(samples) >= 8 and total > 8 * 1024:
        try:
            return zstandard.train_dictionary(min(size, max(1024, total // 8)), samples, k=200, d=8, f=18, accel=1, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


def _pieces(dictionary: bytes) -> list[bytes]:
    return [dictionary[i : i + 1024] for i in range(0, len(dictionary), 1024)]


def _train_partition(size: int) -> Callable:
    """Trains on blocks of some MB; each block's dictionary stands for it in the partition's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, block, held = [], [], 0
        for batch in batches:
            for x in batch.column("ids").to_pylist():
                if x:
                    block.append(x)
                    held += len(x)
                if held > _TRAIN_MB << 20:
                    done.append(train(block, size))
                    block, held = [], 0
        if block:
            done.append(train(block, size))
        if done:
            whole = done[0] if len(done) == 1 else train([p for d in done for p in _pieces(d)], size)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([whole], pa.binary())], ["part", "dictionary"])

    return run


def _train_group(size: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        parts = table.column("dictionary").to_pylist()
        whole = parts[0] if len(parts) == 1 else train([p for d in parts for p in _pieces(d)], size)
        return pa.table({"part": pa.array([table.column("part")[0].as_py() // FAN_IN]), "dictionary": pa.array([whole], pa.binary())})

    return run


def shared_dictionary(ids: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """Train over all rows of ``ids``; what reaches the driver is one dictionary."""
    level = materialize(ids.select("ids").mapInArrow(_train_partition(size), _TRAINED), "dictionaries")
    while (top := level.agg(F.max("part")).first()[0]) is not None and top > 0:
        level = materialize(level.groupBy((F.col("part") / FAN_IN).cast("long")).applyInArrow(_train_group(size), _TRAINED), "dictionaries")
    found = level.select("dictionary").first()
    return bytes(found[0]) if found else b""


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def dictionary_hash(content: bytes) -> str:
    return hashlib.sha256(content).hexdigest()


def _compressing(content: bytes) -> Callable:
    digest = dictionary_hash(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _dictionary(content)
        if known is not None:
            known.precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(**({} if known is not None else {"level": LEVEL}), dict_data=known, write_checksum=False)
        shard, at, first = TaskContext.get().partitionId(), 0, True
        for batch in batches:
            frames = [None if x is None else pack.compress(x) for x in batch.column("ids").to_pylist()]
            sizes = np.array([len(f or b"") for f in frames], np.int64)
            offsets = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            n = len(frames)
            held = pa.array([content if first and i == 0 else None for i in range(n)], pa.binary())
            first = first and not n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), pa.array([shard] * n, pa.int32()), pa.array(offsets), pa.array(sizes), pa.array([digest] * n), pa.array(frames, pa.binary()), held],
                ["doc_id", "n_tokens", "shard", "offset", "n_bytes", "dict_hash", "frame", "dictionary"],
            )

    return run


def token_frames(docs: DataFrame, path: str = VOCABULARY, pattern: str = PATTERN, dictionary: bytes | None = None) -> DataFrame:
    """Rows (doc_id, n_tokens, shard, offset, n_bytes, dict_hash, frame, dictionary). The frames of a shard,
    by offset, are the bytes of the file that ``write_token_shards`` writes; here they are in the rows. The
    first row of each shard has the dictionary, the others null. The scan order of the written ids fixes
    shards and offsets."""
    ids = materialize(token_ids(docs, path, pattern), "token_ids")
    content = shared_dictionary(ids) if dictionary is None else dictionary
    kind = dict(docs.dtypes)["doc_id"]
    return ids.mapInArrow(_compressing(content), f"doc_id {kind}, n_tokens long, shard int, offset long, n_bytes long, dict_hash string, frame binary, dictionary binary")


def decode(frame: bytes, dictionary: bytes, width: int = 2) -> np.ndarray:
    """A document's token ids from its frame."""
    raw = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress(frame)
    return np.frombuffer(raw, "<u2" if width == 2 else "<u4")


def write_token_shards(docs: DataFrame, folder: str, path: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Write shard files, the dictionary (named by its hash) and the Parquet index under ``folder``,
    a URI all executors share. A task that runs again replaces its own file. Returns the index."""
    ids = materialize(token_ids(docs, path, pattern), "token_ids")
    content = shared_dictionary(ids)
    system, root = pyarrow.fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{dictionary_hash(content)}.dict") as out:
        out.write(content)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, base = pyarrow.fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        final = f"{base}/shard-{context.partitionId():06d}.bin"
        draft = f"{final}.{context.taskAttemptId()}"
        with where.open_output_stream(draft) as out:
            for batch in _compressing(content)(batches):
                for frame in batch.column("frame").to_pylist():
                    out.write(frame or b"")
                yield batch.select(["doc_id", "n_tokens", "shard", "offset", "n_bytes", "dict_hash"])
        where.move(draft, final)

    kind = dict(docs.dtypes)["doc_id"]
    index = ids.mapInArrow(store, f"doc_id {kind}, n_tokens long, shard int, offset long, n_bytes long, dict_hash string")
    index.write.mode("overwrite").parquet(f"{folder}/index")
    return docs.sparkSession.read.parquet(f"{folder}/index")


def read_document(folder: str, shard: int, offset: int, n_bytes: int, dict_hash: str, width: int = 2) -> np.ndarray:
    """One document's ids, reading only its bytes and the dictionary."""
    system, root = pyarrow.fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{root}/{dict_hash}.dict") as f:
        content = f.read()
    if dictionary_hash(content) != dict_hash:
        raise ValueError("the dictionary doesn't match its hash")
    with system.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
        return decode(f.read_at(n_bytes, offset), content, width)
