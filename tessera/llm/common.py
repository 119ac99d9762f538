"""What several operators share: shared-folder tables, 64-bit fingerprints of byte ranges, and a packed exchange.

The packed exchange asks a question about many 64-bit keys without one Spark row for each: documents are dealt
to chunks by a hash of their id; every chunk sends its sorted unique keys, split over key-range buckets, as
binary columns; a bucket answers each chunk with one byte a key; and the chunk, which derives the same keys
again, reads the answers in key order.  Chunks and buckets grow in number with the input, their sizes only with
the square root of it, so that no task holds more than a bounded share.
"""

from __future__ import annotations

import ctypes
import gc
import math
import tempfile
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LIBC = ctypes.CDLL(None)
NO_ID = np.iinfo(np.int64).max  # a null doc_id counts as later than any other

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_S32, _S29 = np.uint64(32), np.uint64(29)


# ---------------------------------------------------------------- tables in the shared folder


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, or where that is unset, on one machine, one of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file:" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def save(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: lineage ends here, and lost executors lose nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    SAVED.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SAVED: list[str] = []  # by this process


def discard(spark: SparkSession, since: int = 0) -> int:
    """Deletes the tables that `save` has written since so many were, and says how many; for when results are written.

    What still reads them can't be run any more.  Tables of other processes, and of families of suffix arrays, stay.
    """
    gone, SAVED[since:] = SAVED[since:], []
    for path in gone:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(gone)


def tidy() -> None:
    """Give memory that a batch has freed back to the system: Python workers are reused, and some batches are large."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(LIBC, "malloc_trim"):
        LIBC.malloc_trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# ---------------------------------------------------------------- fingerprints


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers, in place."""
    x ^= x >> _S32
    x *= _B
    x ^= x >> _S29
    x *= _C
    x ^= x >> _S32
    return x


def fold(h, w: np.ndarray) -> np.ndarray:
    """Fingerprint of what h stands for, followed by w."""
    return mix(h * _A + w)


def words64(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, little-endian, without a copy; the last seven bytes must be padding."""
    return np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))


def padded(data: np.ndarray, by: int = 128) -> np.ndarray:
    out = np.zeros(len(data) + by, np.uint8)
    out[: len(data)] = data
    return out


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def ranges64(view: np.ndarray, lo: np.ndarray, hi: np.ndarray, seed: int = 1) -> np.ndarray:
    """Fingerprints of the bytes lo to hi (their number included)."""
    n = (hi - lo).astype(np.int64)
    out = fold(mix(n.astype(np.uint64) + np.uint64((seed << 48) + 1)), view[lo] & _MASK[np.minimum(n, 8)])
    live, at = np.flatnonzero(n > 8), 8
    while len(live):
        left = n[live] - at
        out[live] = fold(out[live], view[lo[live] + at] & _MASK[np.minimum(left, 8)])
        at += 8
        live = live[left > 8]
    return out


def starts_to_ids(lengths: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(lengths)), lengths)


def expand(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i the numbers lo[i] to hi[i] inclusive: which i, and the numbers."""
    n = np.maximum(hi - lo + 1, 0)
    of = starts_to_ids(n)
    return of, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[of]


# ---------------------------------------------------------------- texts of a batch as bytes


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and bytes of a string column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary() if not pa.types.is_large_string(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, data


def ids_of(column) -> np.ndarray:
    return column.combine_chunks().cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False) if isinstance(column, pa.ChunkedArray) else column.cast(pa.int64()).fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


@dataclass
class Block:
    """Some whole documents of a chunk: rows first to last (exclusive), their bytes and where each begins."""

    first: int
    last: int
    data: np.ndarray
    off: np.ndarray


def blocks(column, limit: int = 1 << 20):
    """Blocks of about limit bytes at most (a longer document is a block of its own), so scratch memory is bounded."""
    off, data = text_buffers(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield Block(i, j, data[off[i] : off[j]], off[i : j + 1] - off[i])
        i = j


# ---------------------------------------------------------------- the packed exchange


@dataclass(frozen=True)
class Layout:
    chunks: int
    buckets: int


def layout(docs: DataFrame, chunk_bytes: int = 4 << 20, bucket_bytes: int = 32 << 20) -> Layout:
    """Numbers of chunks and buckets for these texts: sizes grow with the square root beyond about 20 GB."""
    total, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    total += 64 * rows  # so that many short texts aren't one chunk
    root = math.sqrt(700.0 * total)
    return Layout(max(1, math.ceil(total / max(chunk_bytes, root))), max(1, math.ceil(total / max(bucket_bytes, root))))


def in_chunks(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text, chunk; rows of one doc_id share a chunk."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(n)).cast("long").alias("chunk"))


ASKED = "chunk long, bucket long, step int, n long, keys binary, more binary, docs binary, which binary"
TOLD = "chunk long, bucket long, step int, told binary"


def ask(chunk: int, step: int, buckets: int, keys: np.ndarray, more: np.ndarray | None = None, docs: np.ndarray | None = None) -> pa.Table:
    """Rows for keys in ascending order, one for each bucket that has any; `more`: a row of numbers for each key."""
    bucket = ((keys >> _S32) * np.uint64(buckets)) >> _S32
    edge = np.flatnonzero(np.diff(bucket)) + 1 if len(keys) else np.zeros(0, np.int64)
    cuts = [0, *edge.tolist(), len(keys)] if len(keys) else [0]
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    raw = lambda x: pa.array([x[a:b].tobytes() for a, b in spans] if x is not None else [None] * len(spans), pa.binary())
    # the documents of a row once each, and which of them every key has: short numbers instead of long ids
    once = [np.unique(docs[a:b], return_inverse=True) for a, b in spans] if docs is not None else []
    short = lambda d, i: i.astype("<u2" if len(d) <= 1 << 16 else "<u4").tobytes()
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(spans), pa.int64()),
            "bucket": pa.array([int(bucket[a]) for a, _ in spans], pa.int64()),
            "step": pa.array([step] * len(spans), pa.int32()),
            "n": pa.array([b - a for a, b in spans], pa.int64()),
            "keys": raw(keys),
            "more": raw(more),
            "docs": pa.array([d.tobytes() for d, _ in once] if once else [None] * len(spans), pa.binary()),
            "which": pa.array([short(d, i) for d, i in once] if once else [None] * len(spans), pa.binary()),
        }
    )


def asked(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x, kind) for x in table[name].to_pylist()]


def tell(table: pa.Table, flags: np.ndarray) -> pa.Table:
    """Answers, given one byte for every key in the order of the rows."""
    ends = np.cumsum(table["n"].to_numpy())
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "step": table["step"], "told": pa.array([flags[e - n : e].tobytes() for e, n in zip(ends.tolist(), table["n"].to_pylist(), strict=True)], pa.binary())})


def told(replies: pa.Table, step: int) -> np.ndarray:
    """The bytes told to this chunk at a step, in the order of its ascending keys."""
    rows = sorted((b, t) for b, s, t in zip(replies["bucket"].to_pylist(), replies["step"].to_pylist(), replies["told"].to_pylist(), strict=True) if s == step)
    return np.frombuffer(b"".join(t for _, t in rows), np.uint8)


def earliest(table: pa.Table) -> pa.Table:
    """For every pair of a key and its `more` bit 1: a chunk has it in a smaller document; bit 2: its key comes with another `more`."""
    keys = np.concatenate(asked(table, "keys", "<u8"))
    docs = []
    for d, w in zip(asked(table, "docs", "<i8"), table["which"].to_pylist(), strict=True):
        docs.append(d[np.frombuffer(w, "<u2" if len(d) <= 1 << 16 else "<u4")])
    docs = np.concatenate(docs)
    more = np.concatenate(asked(table, "more", "<u8")).reshape(len(keys), -1)
    order = np.lexsort((docs, *more.T, keys))
    k, m, d = keys[order], more[order], docs[order]
    new_key = np.r_[True, k[1:] != k[:-1]]
    new = new_key | np.r_[True, (m[1:] != m[:-1]).any(1)]
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    group = np.cumsum(new_key) - 1
    kinds = np.bincount(group, weights=new)
    flags = np.zeros(len(keys), np.uint8)
    flags[order] = (least < d).astype(np.uint8) | (kinds[group] > 1).astype(np.uint8) << 1
    return tell(table, flags)


# ---------------------------------------------------------------- connected components


def connected_components(edges: DataFrame, tag: str = "cc") -> DataFrame:
    """(node, component = its smallest reachable node) for the nodes of edges a, b; alternating large and small stars.

    Every round is joins and aggregations over edges, written to the shared folder; no component meets in one task.
    """
    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()

    def large(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def state(e: DataFrame):
        # sums of hashes, wrapped by hand: equal states have equal edges
        return tuple(e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40))), F.sum(F.pmod(F.hash("a", "b"), F.lit(1 << 30)))).first())

    edges = save(edges.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct(), tag)
    before = state(edges)
    while before[0]:
        edges = save(small(large(edges)), tag)
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
