"""Substring dedup over words by recompression.

Naming.  A word's symbol is a 64-bit fingerprint of its bytes.  Each round gives runs of one symbol and pairs of
neighbours from opposite classes (a bit of the symbol and round decides) new symbols, named by fingerprints of what
they replace.  Names depend on content alone, so all Spark tasks give equal strings the same names without asking
one another.  Beside each symbol stands its context: the words that decided it.  Wherever those words recur, the
symbol recurs, so equal windows agree on every symbol whose context lies inside.

Revealing.  Each 20-word window chooses, among the symbols with contexts inside, the one of smallest name (the name
also covers the context); one packed exchange finds the chosen symbols that occur more than once.  A window with a
symbol that occurs once is unique and done with.

Verifying.  For a repeated symbol the words of all windows around it are compared first (by 128 bits beside the
name), which settles copies; windows whose surroundings differ are compared themselves (by 128 bits), and so are the
few windows, inside long runs, that hold no whole context, and those of a symbol that more than `hot` chunks hold:
its surroundings might be too many for one task.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common as C


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
ROUNDS = 2
HOT = 1000  # chunks that may hold a symbol before its windows are dealt out one by one; a quarter of them, if more
RUN, PAIR, NAME, WIDE, WINDOW, *CLASS = (np.uint64(x) for x in range(11, 32))


def words_of(block: C.Block, seed: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """A fingerprint for every word of the block, and the number of words in each document."""
    buf = C.padded(block.data)
    b = buf[: len(block.data)]
    inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.zeros(len(b) + 1, bool)
    edge[block.off] = True
    before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    at = np.searchsorted(start, block.off)
    return C.ranges64(C.words64(buf), start, end, seed), np.diff(at)


def recompress(words: np.ndarray, doc: np.ndarray, rounds: int):
    """Symbols after some rounds: names, documents, and first and last word (exclusive) of their contexts."""
    n = len(words)
    sym, doc, lo, hi = words.copy(), doc.copy(), np.arange(n), np.arange(n) + 1
    for r in range(rounds):
        # runs: all decided by their symbols and both neighbours
        same = np.r_[False, (sym[1:] == sym[:-1]) & (doc[1:] == doc[:-1])] if len(sym) else np.zeros(0, bool)
        first = np.flatnonzero(~same)
        last = np.r_[first[1:], len(sym)] - 1 if len(first) else first
        count = last - first + 1
        new = sym[first]
        many = count > 1
        new[many] = C.fold(C.fold(new[many], count[many].astype(np.uint64)), RUN)
        d = doc[first]
        a, b = np.maximum(first - 1, 0), np.minimum(last + 1, len(sym) - 1)
        # at either end of a document the missing neighbour decided too: such contexts lie in no window
        left = np.where((doc[a] == d) & (a < first), lo[a], lo[first] - 1)
        right = np.where((doc[b] == d) & (b > last), hi[b], hi[last] + 1)
        lo, hi, sym, doc = np.minimum(left, lo[first]), np.maximum(right, hi[last]), new, d
        # pairs: a symbol of the first class followed by one of the second
        if not len(sym):
            break
        kind = (C.mix(sym ^ CLASS[r % len(CLASS)]) & np.uint64(1)).astype(bool)
        head = np.r_[~kind[:-1] & kind[1:] & (doc[1:] == doc[:-1]), False]
        tail = np.r_[False, head[:-1]]
        here = np.arange(len(sym))
        out = sym.copy()
        h = np.flatnonzero(head)
        out[h] = C.fold(C.fold(sym[h], sym[h + 1]), PAIR)
        # a symbol left alone is so because of the neighbour it might have joined
        other = np.clip(np.where(kind, here - 1, here + 1), 0, len(sym) - 1)
        alone = (other == here) | (doc[other] != doc)
        lo2 = np.where(alone, lo - kind, np.minimum(lo, lo[other]))
        hi2 = np.where(alone, hi + ~kind, np.maximum(hi, hi[other]))
        keep = ~tail
        sym, doc, lo, hi = out[keep], doc[keep], lo2[keep], hi2[keep]
    return sym, doc, lo, hi


def prefix_names(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and powers from which the fingerprint of any run of words follows at once."""
    base = np.uint64(0xD1342543DE82EF95)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(words), base, np.uint64)])
        back = np.uint64(pow(int(base), -1, 1 << 64))
        inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(words), back, np.uint64)])
        total = np.r_[np.uint64(0), np.cumsum(words * power[:-1])]
    return total, inverse, power


def runs64(sums, lo: np.ndarray, hi: np.ndarray, kind: np.uint64) -> np.ndarray:
    total, inverse, _ = sums
    return C.fold(C.fold((total[hi] - total[lo]) * inverse[lo], (hi - lo).astype(np.uint64)), kind)


def smallest(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the first smallest of x[a] to x[b - 1] is, for many ranges, none of them empty."""
    if not len(a):
        return np.zeros(0, np.int64)
    tables = [np.arange(len(x))]
    width = b - a
    power = np.frexp(width)[1] - 1  # floor of the logarithm
    for k in range(int(power.max())):
        t = tables[-1]
        i, j = t[: -(1 << k)], t[1 << k :]
        tables.append(np.where(x[i] <= x[j], i, j))
    out = np.empty(len(a), np.int64)
    for k, t in enumerate(tables):
        w = np.flatnonzero(power == k)
        i, j = t[a[w]], t[b[w] - (1 << k)]
        out[w] = np.where(x[i] <= x[j], i, j)
    return out


class Parse:
    """Words, chosen symbols and their windows for the documents of a block."""

    def __init__(self, block: C.Block, length: int, rounds: int) -> None:
        self.block, self.length = block, length
        self.words, self.count = words_of(block)
        n = len(self.words)
        self.off = np.r_[0, np.cumsum(self.count)]
        doc = C.starts_to_ids(self.count)
        self.doc = doc
        self.sums = prefix_names(self.words)
        sym, of, lo, hi = recompress(self.words, doc, rounds)
        self.whole = np.arange(n) + length <= self.off[1:][doc]
        # windows that hold context [lo, hi) start at hi - length to lo; each takes the smallest name
        first = np.maximum(self.off[:-1][of], hi - length)
        last = np.minimum(lo, self.off[1:][of] - length)
        some = first <= last
        sym, of, lo, hi, first, last = sym[some], of[some], lo[some], hi[some], first[some], last[some]
        name = C.fold(C.fold(sym, runs64(self.sums, lo, hi, NAME)), NAME)
        # contexts move to the right in order, so those inside a window are neighbours: from a to b, exclusive
        b = np.cumsum(np.bincount(first, minlength=n + 1)[: n + 1])
        a = np.cumsum(np.bincount(last + 1, minlength=n + 1)[: n + 1])
        start = np.flatnonzero(self.whole & (a[:n] < b[:n]))
        best = np.unique(smallest(name, a[start], b[start]))
        self.name, self.first, self.last, self.lo = name[best], first[best], last[best], lo[best]
        self.row = of[best] + block.first
        self.bare = np.flatnonzero(self.whole & (a[:n] >= b[:n]))

    @functools.cached_property
    def other_sums(self):
        """From a second fingerprint of every word: where runs are compared, 128 bits stand for them."""
        return prefix_names(words_of(self.block, 4)[0])

    def around(self, i: np.ndarray) -> np.ndarray:
        """All words of the windows that hold symbol i, and its place among them, as two numbers."""
        runs = [runs64(s, self.first[i], self.last[i] + self.length, WIDE) for s in (self.sums, self.other_sums)] if len(i) else [np.zeros(0, np.uint64)] * 2
        return np.stack([C.fold(x, (self.lo[i] - self.first[i]).astype(np.uint64)) for x in runs], 1)

    def windows(self, s: np.ndarray) -> np.ndarray:
        return np.stack([runs64(x, s, s + self.length, WINDOW) for x in (self.sums, self.other_sums)] if len(s) else [np.zeros(0, np.uint64)] * 2, 1)


def later(keys: tuple[np.ndarray, ...], doc: np.ndarray, row: np.ndarray, place: np.ndarray):
    """Order by keys, document, row and place; the groups; and who stands behind another of its group."""
    order = np.lexsort((place, row, doc, *reversed(keys)))
    sorted_keys = [k[order] for k in keys]
    d, r = doc[order], row[order]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([k[1:] != k[:-1] for k in sorted_keys], axis=0)
    group = np.cumsum(new) - 1
    least = d[new]
    behind = (d > least[group]) | np.r_[False, ~new[1:] & (r[1:] == r[:-1])] if len(order) else np.zeros(0, bool)
    return order, [k[new] for k in sorted_keys], least, group, behind


def chunk_state(docs: pa.Table, replies: pa.Table | None, length: int, rounds: int, upto: int):
    ids = C.ids_of(docs["doc_id"])
    parts = [Parse(b, length, rounds) for b in C.blocks(docs["text"])]
    if not parts:
        return None
    names = np.concatenate([p.name for p in parts])
    order = np.argsort(names, kind="stable")
    s = names[order]
    new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.zeros(0, bool)
    if upto == 1:
        return s[new]
    group = np.cumsum(new) - 1
    codes = np.zeros(len(names), np.uint8)  # 1 repeated, 2 in very many chunks
    if len(s):
        codes[order] = np.maximum(C.told(replies, 1), np.bincount(group) > 1)[group]
    cut = np.cumsum([0, *(len(p.name) for p in parts)])
    picks = [np.flatnonzero(codes[a:b] == 1) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    hots = [np.flatnonzero(codes[a:b] == 2) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    key = np.concatenate([p.name[i] for p, i in zip(parts, picks, strict=True)])
    ctx = np.concatenate([p.around(i) for p, i in zip(parts, picks, strict=True)])
    row = np.concatenate([p.row[i] for p, i in zip(parts, picks, strict=True)])
    place = np.concatenate([p.lo[i] for p, i in zip(parts, picks, strict=True)])
    order, uniq, least, group, behind = later((key, *ctx.T), ids[row] if len(row) else row, row, place)
    if upto == 2:
        return uniq[0], np.stack(uniq[1:], 1), least
    bits = C.told(replies, 2)
    copied, open_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    if len(key):
        copied[order] = (bits[group] & 1).astype(bool) | behind
        open_[order] = (bits[group] & 2) > 0
    open_ &= ~copied
    cut = np.cumsum([0, *(len(i) for i in picks)])
    lists = []
    for p, i, hot, a, b in zip(parts, picks, hots, cut[:-1], cut[1:], strict=True):
        j = np.r_[i[open_[a:b]], hot]
        _, start = C.expand(p.first[j], p.last[j])
        start = np.union1d(start, p.bare).astype(np.int64)
        lists.append((start, p.doc[start] + p.block.first if len(start) else start, p.windows(start)))
    whole = np.concatenate([x[2] for x in lists])
    row = np.concatenate([x[1] for x in lists])
    place = np.concatenate([x[0] for x in lists])
    order, uniq, least, group, behind = later(tuple(whole.T), ids[row] if len(row) else row, row, place)
    if upto == 3:
        return uniq[0], np.stack(uniq[1:], 1), least
    bits = C.told(replies, 3)
    again = np.zeros(len(whole), bool)
    if len(whole):
        again[order] = (bits[group] & 1).astype(bool) | behind
    covers, at = [], 0
    for p, i, a, b, (start, _, _) in zip(parts, picks, cut[:-1], cut[1:], lists, strict=True):
        edge = np.zeros(len(p.words) + 1, np.int32)
        j = i[copied[a:b]]
        np.add.at(edge, p.first[j], 1)
        np.add.at(edge, p.last[j] + length, -1)
        t = start[again[at : at + len(start)]]
        at += len(start)
        np.add.at(edge, t, 1)
        np.add.at(edge, t + length, -1)
        covers.append(np.cumsum(edge[:-1]) > 0)
    return parts, covers


def remove_repeats(docs: DataFrame, length: int = 20, rounds: int = ROUNDS, with_text: bool = False, hot: int | None = None) -> DataFrame:
    """Remove every word covered by a window of `length` words that also starts earlier.

    Earlier: in a document of smaller doc_id, or in the same document before.  Words are `[^\\x20\\x09-\\x0D]+`.
    Returns one row for each row of docs: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by one
    space), and kept with_text.  A null or blank text has no words and the hash of nothing; a shorter text loses
    nothing; rows of one doc_id don't count against each other; a null doc_id is later than any other; other columns
    are ignored.
    """
    size = C.layout(docs)
    base = C.in_chunks(docs, size.chunks)
    buckets = size.buckets
    most = hot if hot is not None else max(HOT, size.chunks // 4)
    none = np.zeros(0, np.uint64)

    def step1(key, table):
        got = chunk_state(table, None, length, rounds, 1)
        return C.ask(key[0].as_py(), 1, buckets, none if got is None else got)

    def step2(key, table, replies):
        got = chunk_state(table, replies, length, rounds, 2)
        return C.ask(key[0].as_py(), 2, buckets, *(got or [none]))

    def step3(key, table, replies):
        got = chunk_state(table, replies, length, rounds, 3)
        return C.ask(key[0].as_py(), 3, buckets, *(got or [none]))

    def last(key, table, replies):
        got = chunk_state(table, replies, length, rounds, 4)
        n_words, n_removed, sha, kept = [], [], [], []
        for p, cover in zip(*got, strict=True) if got else []:
            b = p.block
            for i, (a, e) in enumerate(zip(p.off[:-1].tolist(), p.off[1:].tolist(), strict=True)):
                words = b.data[b.off[i] : b.off[i + 1]].tobytes().split()
                gone = cover[a:e]
                k = int(gone.sum())
                left = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if k else words)
                n_words.append(e - a)
                n_removed.append(k)
                sha.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept.append(left)
        out = {"doc_id": table["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.binary())} if with_text else {}))

    def repeated(table):
        keys = np.concatenate(C.asked(table, "keys", "<u8"))
        order = np.argsort(keys, kind="stable")
        k = keys[order]
        group = np.cumsum(np.r_[True, k[1:] != k[:-1]]) - 1
        held = np.bincount(group)[group]  # chunks, as each sends a name once
        flags = np.zeros(len(k), np.uint8)
        flags[order] = (held > 1).astype(np.uint8) + (held > most)
        return C.tell(table, flags)

    pair = lambda replies, f, out: base.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(f, out)
    told1 = base.groupBy("chunk").applyInArrow(step1, C.ASKED).groupBy("bucket").applyInArrow(repeated, C.TOLD)
    told2 = pair(told1, step2, C.ASKED).groupBy("bucket").applyInArrow(C.earliest, C.TOLD)
    sofar = told1.unionByName(told2)
    told3 = pair(sofar, step3, C.ASKED).groupBy("bucket").applyInArrow(C.earliest, C.TOLD)
    return pair(sofar.unionByName(told3), last, OUT + (", kept binary" if with_text else ""))


def op2_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(C.documents(spark, sf_dir))
