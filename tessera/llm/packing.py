"""Best-fit packing of token sequences by exact-complement hashing.

How many pieces have each length is all that packing needs, and there are at most `capacity` lengths: that table,
bounded whatever the input, is planned on the driver.  The plan looks up, for each length from the longest down, what
fills its gap exactly: a single length, a pair from an index of pairs by their sum, or a triple (a length and a pair
of that index), as often as counts allow.  What is left is packed best fit.  The plan's patterns, each with a number of times, are then dealt to the pieces by their rank
among equal lengths, which is counted in parts so that a frequent length isn't ranked in one task.
"""

from __future__ import annotations

import functools
import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

CAPACITY = 1024
END = 2
#: How a byte-level tokenizer of this family splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest for 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


def encoder(path: str):
    """Ids of a text by the byte-level tokenizer file, as an array.

    The merges of such a file rank as its ids do, so a faster library gives the same ids; texts that hold a special
    token's own string, and any that library refuses, go through `tokenizers`, which is loaded only for them.
    """
    import tiktoken

    @functools.cache
    def slow():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = [t["content"] for t in spec["added_tokens"]]
    chars = byte_of_char()
    ranks = {bytes(chars[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding("byte level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> np.ndarray:
        if not any(s in text for s in special):
            try:
                return np.array(fast.encode_ordinary(text), np.uint32)
            except Exception:  # its pattern gives up on some texts; `tokenizers` reads any
                pass
        return np.array(slow().encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, with_ids: bool = False) -> DataFrame:
    """Documents as pieces of at most capacity ids, the last id being `end`; only longer documents are cut.

    All pieces of a cut document but the first have capacity ids.
    """

    def cut(batches):
        ids = encoder(path)
        for batch in batches:
            doc, piece, start, length, crc, own = [], [], [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.append(ids(text.as_py() or ""), np.uint32(end)).astype("<u4")
                first = (len(x) - 1) % capacity + 1
                for k, a in enumerate([0, *range(first, len(x), capacity)]):
                    b = first if not k else a + capacity
                    raw = x[a:b].tobytes()
                    doc.append(d)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(raw))
                    own.append(raw)
            cols = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(own, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
            C.tidy()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES + (", ids binary" if with_ids else ""))


RESERVES = (1, 8, 16, 32, 48, 64, 96, 128, 192, 256)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths that fit one sequence, and how many sequences follow each; uses up all counts.

    Short pieces that fill gaps exactly may be missed later by the best fit, so pairs and triples leave those below a
    reserve alone; of some reserves, and of singles only, the plan with the fewest sequences is taken, and of equal ones
    that which fills most sequences by pairs and triples.
    """
    tried = [complements(counts, capacity, k, least) for k in (3, 2) for least in RESERVES] + [complements(counts, capacity, 1)]
    return min(tried, key=lambda p: (sum(n for _, n in p), -sum(n for x, n in p if len(x) > 2 and sum(x) == capacity)))


def complements(counts: dict[int, int], capacity: int, most: int, least: int = 1) -> list[tuple[tuple[int, ...], int]]:
    """A plan whose gaps are filled exactly by up to `most` lengths where they can be, and best fit elsewhere.

    Pairs and triples hold no length below `least`; of those of one sum the most even ones come first.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> None:
        """This combination as often as counts allow."""
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        n = min(int(left[x]) // k for x, k in need.items())
        if n > 0:
            for x, k in need.items():
                left[x] -= n * k
            out.append((tuple(lengths), n))

    # by sum, the longer lengths of all pairs that are there, the most even pair last; what counts have used up is struck off when met
    index: list[list[int]] = [[] for _ in range(capacity)]
    for total in range(2 * least, capacity if most > 1 else 0):
        a = np.arange(total - least, (total + 1) // 2 - 1, -1)
        index[total] = a[(left[a] > 0) & (left[total - a] > 0)].tolist()

    def pairs(total: int):
        entries = index[total]
        for i in range(len(entries) - 1, -1, -1):
            if left[entries[i]] and left[total - entries[i]]:
                yield entries[i]
            else:
                del entries[i]

    take(capacity)
    for anchor in range(capacity - 1, 0, -1):
        gap = capacity - anchor
        if left[anchor]:
            take(anchor, gap)
        for a in pairs(gap) if left[anchor] and most > 1 else ():
            take(anchor, a, gap - a)
            if not left[anchor]:
                break
        # triples: a length and a pair from the index
        for a in range(min(gap - 2 * least, anchor), least - 1, -1) if left[anchor] and most > 2 else ():
            if left[a]:
                for b in pairs(gap - a):
                    take(anchor, a, b, gap - a - b)
            if not left[anchor]:
                break
    # best fit of the rest, longest first: sequences of the same room go together
    room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []

    def put(pattern: tuple[int, ...], n: int) -> None:
        g = capacity - sum(pattern)
        if g not in room:
            room[g] = []
            gaps.append(g)
        room[g].append((pattern, n))

    for length in np.flatnonzero(left)[::-1].tolist():
        n = int(left[length])
        while n:
            fit = min((g for g in gaps if g >= length and room[g]), default=None)
            if fit is None:
                each = capacity // length
                if n >= each:
                    put((length,) * each, n // each)
                if n % each:
                    put((length,) * (n % each), 1)
                n = 0
                continue
            pattern, times = room[fit].pop()
            used = min(times, n)
            if times > used:
                room[fit].append((pattern, times - used))
            put((*pattern, length), used)
            n -= used
    return out + [x for g in sorted(room) for x in room[g]]


def intervals(patterns: list[tuple[tuple[int, ...], int]]):
    """The plan by ranks: from (length, rank) on, the first sequence and the place there; in ascending order."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for pattern, times in patterns:
        at = 0
        for length in pattern:
            rank = used.get(length, 0)
            rows.append((length, rank, base, at))
            used[length] = rank + times
            at += length
        base += times
    rows.sort()
    return [np.array(x, np.int64) for x in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 4


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset, in sequences of at most capacity ids without gaps from 0 on.

    cut is read more than once, so it should be a written table.  Equal rows are packed each.
    """
    parts = max(8, min(4096, cut.count() // 50_000))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    counted = C.save(dealt.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    ahead = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("length", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    # at most `capacity` rows, whatever the input
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    lengths, ranks, bases, places = intervals(plan(counts, capacity))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("ahead")).drop("part", "ahead")
    columns = [c for c in cut.columns]
    keys = lengths * (1 << 40) + ranks

    def place(batches):
        for batch in batches:
            key = batch.column("length").to_numpy() * (1 << 40) + batch.column("rank").to_numpy()
            i = np.searchsorted(keys, key, "right") - 1
            seq = bases[i] + key - keys[i]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(seq), pa.array(places[i])], names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{c} {t}" for c, t in cut.dtypes)
    return ranked.select(*columns, F.col("rank").cast("long").alias("rank")).mapInArrow(place, kinds + ", sequence_id long, offset long")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for all documents.

    A null or empty text is one piece that holds only `end`; repeated rows are packed each; an empty table gives
    none; other columns are ignored.
    """
    return pack(C.save(pieces(docs, path or tokenizer_path(), capacity, end), "pieces"), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(C.documents(spark, sf_dir))
