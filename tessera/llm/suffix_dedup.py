"""Substring dedup over bytes by a logarithmic family of sparse suffix arrays.

Sampling.  A suffix is indexed where its first 8 bytes have the smallest fingerprint among the 27 starts of a
50-byte string (`length` - `prefix` + 1 in general).  Equal strings choose the same starts, so two equal 50-byte
strings always share an indexed suffix, 24 bytes of which lie within both; about one suffix in 14 is indexed.

Family.  The suffixes of a batch of documents, in the order of the names of their 24-byte prefixes, with the chunks
that hold them, are a table in the shared folder, cut into key ranges: a level.  A new batch is merge-scanned, range
by range, against every level for prefixes that occur more than once, then becomes a level itself, and levels of
equal rank merge, as in a binary counter: n batches rewrite each entry log n times.  A family can be opened later
and takes further batches.

Matches.  For shared prefixes the bytes around them travel: 26 before the suffix and 50 from it on, each content once
a chunk.  They are sorted into a suffix array of whole suffixes and one of the reversed bytes before them; the lengths
that neighbours have in common (bytes are compared, not fingerprints) tell which of the 27 strings around a suffix
stand in a document of smaller id.  A prefix that more than `hot` chunks hold might bring together too many contexts;
there the strings themselves are dealt to tasks, each once a chunk, by 128-bit names that stand for their bytes.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
ENTRIES = "bucket long, holder long, names binary, holders binary, own boolean"
SCANNED = "kind string, bucket long, holder long, names binary, holders binary, told binary"
AROUND = "bucket long, holder long, own boolean, n long, contexts binary, docs binary"
TOLD = "bucket long, holder long, told binary"
HOT = 1000  # chunks that may hold a prefix before its strings are dealt out one by one; a quarter of them, if more
BATCH = 1 << 32  # holders are chunks: batch * BATCH + chunk


def packed(x: np.ndarray) -> bytes:
    """Numbers, those of sorted ones by their differences; alike bytes of neighbours are put together and compressed."""
    x = np.ascontiguousarray(x).view(np.uint64)
    diff = np.diff(x, prepend=np.uint64(0))
    return zstandard.compress(np.ascontiguousarray(diff.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(raw: bytes, kind: type = np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64), dtype=np.uint64).view(kind)


class Sampler:
    """Indexed suffixes of a block of documents, and the strings around them."""

    def __init__(self, block: C.Block, length: int, prefix: int) -> None:
        self.block, self.length, self.prefix, self.reach = block, length, prefix, length - prefix
        buf = C.padded(block.data)
        self.view = C.words64(buf)
        n = len(block.data)
        starts, ends = block.off[:-1], block.off[1:]
        # smallest fingerprint of each window of starts, 0 where no whole string begins
        h = ((self.view[:n] * C._A) >> np.uint64(32)).astype(np.uint32)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h |= np.uint32(1)
        width = self.reach + 1
        low = slide(h, width, np.minimum)
        short = np.minimum(ends - starts, length - 1)
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, ends - short, 1)
        np.add.at(edge, ends, -1)
        low[np.cumsum(edge[:-1]) > 0] = 0
        high = slide(low[::-1], width, np.maximum, 0)[::-1]
        self.at = np.flatnonzero(high == h)
        doc = np.searchsorted(block.off, self.at, "right") - 1
        self.row = doc + block.first
        self.before = np.minimum(self.at - starts[doc], self.reach)
        self.behind = np.minimum(ends[doc] - self.at, length)

    def names(self) -> np.ndarray:
        return C.ranges64(self.view, self.at, self.at + self.prefix, 3)

    def contexts(self, i: np.ndarray) -> np.ndarray:
        """A row for each suffix: the bytes before it (the nearest first), those from it on, and how many of both."""
        at, before, behind = self.at[i, None], self.before[i, None], self.behind[i, None]
        back, on = np.arange(self.reach)[None], np.arange(self.length)[None]
        data = self.block.data
        left = np.where(back < before, data[np.maximum(at - 1 - back, 0)], 0)
        right = np.where(on < behind, data[np.minimum(at + on, len(data) - 1)], 0)
        return np.concatenate([left, right, before, behind], 1).astype(np.uint8)


def slide(x: np.ndarray, width: int, best, fill: int | None = None) -> np.ndarray:
    """best over x[i] to x[i + width - 1]; beyond the end there is nothing."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step < len(out):
            best(out[:-step], out[step:], out=out[:-step])
        have += step
    return out


class Names:
    """Names with their documents: each once, in order, and which of them are shared."""

    def __init__(self, names: np.ndarray, docs: np.ndarray) -> None:
        self.order = np.argsort(names, kind="stable")
        s, d = names[self.order], docs[self.order]
        new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.zeros(0, bool)
        self.unique, self.group = s[new], np.cumsum(new) - 1
        other = d != d[new][self.group] if len(s) else np.zeros(0, bool)
        self.here = np.bincount(self.group, weights=other, minlength=len(self.unique)) > 0  # in two documents of this chunk

    def all(self, each: np.ndarray) -> np.ndarray:
        """What is given for each different name, for all names."""
        out = np.zeros(len(self.order), each.dtype)
        out[self.order] = each[self.group]
        return out


def bucket_of(names: np.ndarray, buckets: int) -> np.ndarray:
    return (((names >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def runs(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(sorted_keys)) + 1).tolist(), len(sorted_keys)] if len(sorted_keys) else [0]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


# ---------------------------------------------------------------- suffix arrays by key range


def merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a key range in the order of names: name, holder, own."""
    names, holders, own = [], [], []
    for row in table.select(["names", "holder", "holders", "own"]).to_pylist():
        x = unpacked(row["names"])
        names.append(x)
        holders.append(np.full(len(x), row["holder"]) if row["holders"] is None else unpacked(row["holders"], np.int64))
        own.append(np.full(len(x), row["own"]))
    names, holders, own = np.concatenate(names), np.concatenate(holders), np.concatenate(own)
    order = np.argsort(names, kind="stable")
    return names[order], holders[order], own[order]


def level_row(bucket: int, names: np.ndarray, holders: np.ndarray) -> dict:
    return {"kind": "level", "bucket": bucket, "holder": None, "names": packed(names), "holders": packed(holders), "told": None}


def scan(table: pa.Table, hot: int) -> pa.Table:
    """Merge-scan of a key range: the new batch's suffix array, and which of its names, and of the levels', are shared.

    A chunk of the batch is told a byte for each of its names there, in order: 1 shared, 2 shared by many; a chunk of a
    level gets those of its names that the batch has too, with such bytes.
    """
    names, holders, own = merged(table)
    bucket = table["bucket"][0].as_py()
    new = np.r_[True, names[1:] != names[:-1]]
    group = np.cumsum(new) - 1
    mine = np.bincount(group, weights=own)[group]
    held = np.bincount(group)[group]
    shared = ((held > 1) & (mine > 0)).astype(np.uint8) * (1 + (held > hot).astype(np.uint8))
    out = [level_row(bucket, names[own], holders[own])]
    order = np.lexsort((names, holders))
    for a, b in runs(holders[order]):
        i = order[a:b]
        if own[i[0]]:
            out.append({"kind": "own", "bucket": bucket, "holder": int(holders[i[0]]), "told": shared[i].tobytes()})
        elif shared[i].any():
            i = i[shared[i] > 0]
            out.append({"kind": "old", "bucket": bucket, "holder": int(holders[i[0]]), "names": packed(names[i]), "told": shared[i].tobytes()})
    return pa.Table.from_pylist(out, SCHEMA)


def merge(table: pa.Table) -> pa.Table:
    names, holders, _ = merged(table)
    return pa.Table.from_pylist([level_row(table["bucket"][0].as_py(), names, holders)], SCHEMA)


SCHEMA = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("holder", pa.int64()), ("names", pa.binary()), ("holders", pa.binary()), ("told", pa.binary())])


# ---------------------------------------------------------------- matches by suffix array and common lengths


def common_lengths(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of bytes, and how many first bytes each has in common with the one before it."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    keys = np.ascontiguousarray(wide).view(">u8").astype(np.uint64)
    order = np.lexsort(keys.T[::-1])
    s = rows[order]
    same = s[1:] == s[:-1]
    lengths = np.where(same.all(1), rows.shape[1], same.argmin(1)) if len(s) > 1 else np.zeros(0, np.int64)
    return order, np.r_[0, lengths]


def repeated(contexts: np.ndarray, docs: np.ndarray, length: int, reach: int) -> np.ndarray:
    """For each context the least and the largest number of bytes before the suffix with which a string around it
    stands in a document of smaller id; 255 and 0 if none does.
    """
    n = len(contexts)
    whole = np.ascontiguousarray(contexts).view(f"V{contexts.shape[1]}").ravel()
    _, first, of = np.unique(whole, return_index=True, return_inverse=True)
    some = contexts[first]
    least = np.full(len(first), C.NO_ID)
    np.minimum.at(least, of, docs)
    after, common_after = common_lengths(some[:, reach : reach + length])
    ahead, common_ahead = common_lengths(some[:, :reach])
    before, behind = some[:, -2].astype(int), some[:, -1].astype(int)
    out = np.tile(np.array([255, 0], np.uint8), (n, 1))
    a, b = np.empty(len(some), np.int64), np.empty(len(some), np.int64)
    for k in range(reach + 1):
        # strings of k bytes before the suffix and length - k from it on: equal where both parts are
        a[after] = np.cumsum(common_after < length - k)
        b[ahead] = np.cumsum(common_ahead < k)
        live = np.flatnonzero((before >= k) & (behind >= length - k))
        if not len(live):
            continue
        key = a[live] * (len(some) + 1) + b[live]
        order = np.argsort(key, kind="stable")
        key, live = key[order], live[order]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        low = np.full(len(some), C.NO_ID)
        low[live] = np.repeat(np.minimum.reduceat(least[live], start), np.diff(np.r_[start, len(live)]))
        hit = low[of] < docs
        out[hit, 0] = np.minimum(out[hit, 0], k)
        out[hit, 1] = k
    return out


def earlier(strings: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """1 for each named string that stands in a document of smaller id."""
    order = np.lexsort((docs, *strings.T))
    k, d = strings[order], docs[order]
    new = np.r_[True, (k[1:] != k[:-1]).any(1)]
    out = np.zeros(len(docs), np.uint8)
    out[order] = d[new][np.cumsum(new) - 1] < d
    return out


def match(table: pa.Table, length: int, reach: int, buckets: int) -> pa.Table:
    """Answers for the chunks of the batch: on contexts or, in buckets from `buckets` on, on strings."""
    rows = table.to_pylist()
    raw = [zstandard.decompress(r["contexts"]) for r in rows]
    docs = np.concatenate([unpacked(r["docs"], np.int64) for r in rows])
    if rows[0]["bucket"] >= buckets:
        told = earlier(np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 2) for x in raw]), docs)
    else:
        told = repeated(np.concatenate([np.frombuffer(x, np.uint8).reshape(-1, reach + length + 2) for x in raw]), docs, length, reach)
    ends = np.cumsum([r["n"] for r in rows])
    own = [(r, told[e - r["n"] : e]) for r, e in zip(rows, ends.tolist(), strict=True) if r["own"]]
    return pa.table({"bucket": pa.array([r["bucket"] for r, _ in own], pa.int64()), "holder": pa.array([r["holder"] for r, _ in own], pa.int64()), "told": pa.array([x.tobytes() for _, x in own], pa.binary())})


class Chunk:
    """The documents of a chunk: their indexed suffixes, the shared ones among them, and what stands around these."""

    def __init__(self, docs: pa.Table, length: int, prefix: int) -> None:
        self.ids = C.ids_of(docs["doc_id"])
        self.parts = [Sampler(b, length, prefix) for b in C.blocks(docs["text"])]
        none = np.zeros(0, np.int64)
        self.rows = np.concatenate([none, *(p.row for p in self.parts)])
        self.names = np.concatenate([none.view(np.uint64), *(p.names() for p in self.parts)])
        self.known = Names(self.names, self.ids[self.rows])

    def told(self, replies: pa.Table) -> np.ndarray:
        """For each indexed suffix 1 if it is shared, 2 if by many, after the scan's answers."""
        flags = b"".join(t for _, t in sorted(zip(replies["bucket"].to_pylist(), replies["told"].to_pylist(), strict=True)))
        return self.known.all(np.maximum(np.frombuffer(flags, np.uint8), self.known.here))

    def picked(self, hit: np.ndarray) -> list[np.ndarray]:
        cut = np.cumsum([0, *(len(p.at) for p in self.parts)])
        return [np.flatnonzero(hit[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def strings(self, hit: np.ndarray, buckets: int):
        """Starts of the strings around these suffixes, and their names, each once with its least document, by bucket."""
        starts, names, docs = [], [], []
        for p, i in zip(self.parts, self.picked(hit), strict=True):
            _, s = C.expand(p.at[i] - p.before[i], p.at[i] - np.maximum(p.length - p.behind[i], 0))
            s = np.unique(s).astype(np.int64)
            starts.append(s)
            names.append(np.stack([C.ranges64(p.view, s, s + p.length, seed) for seed in (7, 6)], 1))
            docs.append(self.ids[np.searchsorted(p.block.off, s, "right") - 1 + p.block.first])
        if not hit.any():
            return starts, None
        names, docs = np.concatenate(names), np.concatenate(docs)
        order = np.lexsort((docs, names[:, 1], names[:, 0]))
        k, d = names[order], docs[order]
        new = np.r_[True, (k[1:] != k[:-1]).any(1)]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        return starts, (k[new], d[new], bucket_of(k[new][:, 0], buckets) + buckets, rank, docs)

    def around(self, hit: np.ndarray, buckets: int):
        """Contexts of shared suffixes, each once with its least document, by bucket; and which every suffix has."""
        picks = self.picked(hit)
        if not hit.any():
            return picks, None
        contexts = np.concatenate([p.contexts(i) for p, i in zip(self.parts, picks, strict=True)])
        docs, buckets_of = self.ids[self.rows[hit]], bucket_of(self.names[hit], buckets)
        whole = np.ascontiguousarray(contexts).view(f"V{contexts.shape[1]}").ravel()
        _, first, of = np.unique(whole, return_index=True, return_inverse=True)
        least = np.full(len(first), C.NO_ID)
        np.minimum.at(least, of, docs)
        # in the order of buckets; a context's suffix has one name, so one bucket
        order = np.argsort(buckets_of[first], kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return picks, (contexts[first[order]], least[order], buckets_of[first[order]], rank[of], docs)


def asks(holder: int, chunk: Chunk, codes: np.ndarray, buckets: int, own: bool) -> pa.Table:
    return pa.concat_tables([asked(holder, chunk.around(codes == 1, buckets), own), asked(holder, chunk.strings(codes == 2, buckets), own)])


def asked(holder: int, got, own: bool) -> pa.Table:
    contexts, least, bucket = got[1][:3] if got[1] else ([], [], np.zeros(0, np.int64))
    spans = runs(bucket)
    return pa.table({
        "bucket": pa.array([int(bucket[a]) for a, _ in spans], pa.int64()),
        "holder": pa.array([holder] * len(spans), pa.int64()),
        "own": pa.array([own] * len(spans), pa.bool_()),
        "n": pa.array([b - a for a, b in spans], pa.int64()),
        "contexts": pa.array([zstandard.compress(contexts[a:b].tobytes(), 1) for a, b in spans], pa.binary()),
        "docs": pa.array([packed(least[a:b]) for a, b in spans], pa.binary()),
    })


def results(table: pa.Table, chunk: Chunk, codes: np.ndarray, answers: pa.Table, length: int, buckets: int, with_text: bool) -> pa.Table:
    """Rows of OUT for the documents of a chunk, from what was told about its shared suffixes."""
    rows = sorted(zip(answers["bucket"].to_pylist(), answers["told"].to_pylist(), strict=True))
    told = lambda some: np.frombuffer(b"".join(t for k, t in rows if some(k)), np.uint8)
    edges = [np.zeros(len(p.block.data) + 1, np.int32) for p in chunk.parts]
    picks, of = chunk.around(codes == 1, buckets)
    if of:
        _, least, _, which, docs = of
        span = told(lambda k: k < buckets).reshape(-1, 2)[which].astype(np.int64)
        # a context of a smaller document of this chunk repeats as a whole
        later = docs > least[which]
        behind = np.concatenate([p.behind[i] for p, i in zip(chunk.parts, picks, strict=True)])
        before = np.concatenate([p.before[i] for p, i in zip(chunk.parts, picks, strict=True)])
        span[later] = np.stack([np.maximum(length - behind, 0), before], 1)[later]
        at = np.cumsum([0, *(len(i) for i in picks)])
        for p, i, edge, a, b in zip(chunk.parts, picks, edges, at[:-1], at[1:], strict=True):
            few, most = span[a:b].T
            hit = few <= most
            np.add.at(edge, p.at[i[hit]] - most[hit], 1)
            np.add.at(edge, p.at[i[hit]] - few[hit] + length, -1)
    starts, of = chunk.strings(codes == 2, buckets)
    if of:
        _, least, _, which, docs = of
        gone = (told(lambda k: k >= buckets)[which] > 0) | (docs > least[which])
        at = np.cumsum([0, *(len(x) for x in starts)])
        for x, edge, a, b in zip(starts, edges, at[:-1], at[1:], strict=True):
            np.add.at(edge, x[gone[a:b]], 1)
            np.add.at(edge, x[gone[a:b]] + length, -1)
    n_bytes, n_removed, n_spans, sha, kept = [], [], [], [], []
    for p, edge in zip(chunk.parts, edges, strict=True):
        cover, b = np.cumsum(edge[:-1]) > 0, p.block
        for a, e in zip(b.off[:-1].tolist(), b.off[1:].tolist(), strict=True):
            gone = cover[a:e]
            k = int(gone.sum())
            left = b.data[a:e].tobytes() if not k else b.data[a:e][~gone].tobytes()
            n_bytes.append(e - a)
            n_removed.append(k)
            n_spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if k else 0)
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left if with_text else None)
    out = {"doc_id": table["doc_id"], "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
    return pa.table(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))


class SuffixFamily:
    """A logarithmic family of suffix arrays in a folder that all executors see; batches of documents are added to it."""

    def __init__(self, spark: SparkSession, folder: str, length: int = 50, prefix: int = 24, hot: int | None = None) -> None:
        if not 8 <= prefix < length <= 254:
            raise ValueError("prefix must be at least 8 and less than length, which may be 254")
        self.spark, self.folder, self.length, self.prefix, self.hot = spark, folder, length, prefix, hot
        self.state: dict = {"version": 0, "buckets": 0, "batches": [], "levels": []}
        try:
            known = spark.read.text(f"{folder}/state-*").orderBy(F.desc(F.get_json_object("value", "$.version").cast("long"))).first()
            self.state = json.loads(known[0]) if known else self.state
        except AnalysisException:  # a new family
            pass

    def write(self, df: DataFrame, name: str) -> str:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        return path

    def level(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path).where("kind = 'level'").select("bucket", "holder", "names", "holders", F.lit(False).alias("own"))

    def add(self, docs: DataFrame, path: str | None = None, with_text: bool = False) -> DataFrame:
        """The results of remove_repeats for the rows of docs, against each other and all batches before.

        Earlier batches are known by the table at `path`, or by a copy in the folder; their results stand.
        """
        length, prefix, reach = self.length, self.prefix, self.length - self.prefix
        batch = len(self.state["batches"])
        size = C.layout(docs, bucket_bytes=24 << 20)
        buckets = self.state["buckets"] = self.state["buckets"] or size.buckets
        hot = self.hot if self.hot is not None else max(HOT, size.chunks // 4)
        path = path or self.write(docs.select("doc_id", "text"), "documents")
        held = lambda docs, batch, chunks: C.in_chunks(docs, chunks).withColumn("holder", F.col("chunk") + batch * BATCH).drop("chunk")
        base = held(docs, batch, size.chunks)

        def step1(key, table):
            names = Chunk(table, length, prefix).known.unique
            spans = runs(bucket_of(names, buckets))
            n = len(spans)
            return pa.table({"bucket": pa.array([int(bucket_of(names[a : a + 1], buckets)[0]) for a, _ in spans], pa.int64()), "holder": pa.array([key[0].as_py()] * n, pa.int64()), "names": pa.array([packed(names[a:b]) for a, b in spans], pa.binary()), "holders": pa.nulls(n, pa.binary()), "own": pa.array([True] * n, pa.bool_())})

        def step2(key, table, replies):
            chunk = Chunk(table, length, prefix)
            return asks(key[0].as_py(), chunk, chunk.told(replies), buckets, True)

        def of_old(key, table, replies):
            chunk = Chunk(table, length, prefix)
            shared = np.concatenate([unpacked(x) for x in replies["names"].to_pylist()])
            flags = np.frombuffer(b"".join(replies["told"].to_pylist()), np.uint8)
            each = np.zeros(len(chunk.known.unique), np.uint8)
            each[np.searchsorted(chunk.known.unique, shared)] = flags
            return asks(key[0].as_py(), chunk, chunk.known.all(each), buckets, False)

        def last(key, table, replies, answers):
            chunk = Chunk(table, length, prefix)
            return results(table, chunk, chunk.told(replies), answers, length, buckets, with_text)

        entries = base.groupBy("holder").applyInArrow(step1, ENTRIES)
        for level in self.state["levels"]:
            entries = entries.unionByName(self.level(level["path"]))
        scanned = self.write(entries.groupBy("bucket").applyInArrow(lambda t: scan(t, hot), SCANNED), "level")
        found = self.spark.read.parquet(scanned)
        own = found.where("kind = 'own'").select("bucket", "holder", "told")
        around = base.groupBy("holder").cogroup(own.groupBy("holder")).applyInArrow(step2, AROUND)
        if self.state["levels"]:
            old = found.where("kind = 'old'").select("holder", "names", "told")
            known = None
            for k, b in enumerate(self.state["batches"]):
                rows = held(self.spark.read.parquet(b["path"]), k, b["chunks"])
                known = rows if known is None else known.unionByName(rows)
            wanted = known.join(old.select("holder").distinct(), "holder", "left_semi")
            around = around.unionByName(wanted.groupBy("holder").cogroup(old.groupBy("holder")).applyInArrow(of_old, AROUND))
        matched = around.groupBy("bucket").applyInArrow(lambda t: match(t, length, reach, buckets), TOLD)
        both = own.withColumn("step", F.lit(1)).unionByName(matched.withColumn("step", F.lit(2)))

        def split(key, table, replies):
            step = np.array(replies["step"].to_pylist(), int)
            return last(key, table, replies.filter(pa.array(step == 1)), replies.filter(pa.array(step == 2)))

        out = base.groupBy("holder").cogroup(both.groupBy("holder")).applyInArrow(split, OUT + (", kept binary" if with_text else ""))
        self.keep(scanned, {"path": path, "chunks": size.chunks})
        return out

    def keep(self, path: str, batch: dict) -> None:
        """The batch becomes a level; levels of equal rank merge."""
        levels, rank = self.state["levels"], 0
        while levels and levels[-1]["rank"] == rank:
            both = self.level(levels.pop()["path"]).unionByName(self.level(path))
            path, rank = self.write(both.groupBy("bucket").applyInArrow(merge, SCANNED), "level"), rank + 1
        levels.append({"rank": rank, "path": path})
        self.state["batches"].append(batch)
        self.state["version"] += 1
        self.spark.createDataFrame([(json.dumps(self.state),)], "value string").coalesce(1).write.text(f"{self.folder}/state-{self.state['version']:06d}")


def remove_repeats(docs: DataFrame, length: int = 50, prefix: int = 24, with_text: bool = False, path: str | None = None, hot: int | None = None) -> DataFrame:
    """Remove every byte covered by a string of `length` bytes that also starts in a document of smaller doc_id.

    Returns one row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the
    remaining bytes, with_text).  A null text is empty; an empty or short text loses nothing; rows of one doc_id do
    not count against each other; a null doc_id is later than any other; other columns are ignored; an empty table
    gives none.  The rows are the first batch of a new family in the shared folder.
    """
    folder = f"{C.shared_dir(docs.sparkSession)}/suffix-family-{uuid.uuid4().hex}"
    return SuffixFamily(docs.sparkSession, folder, length, prefix, hot).add(docs, path, with_text)


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(C.documents(spark, sf_dir), path=f"{sf_dir}/documents.parquet")
