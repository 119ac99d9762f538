"""Near-duplicate documents by ProbMinHash over weighted word shingles.

Shingles are five consecutive words (a shorter text is one shingle), weighted by how often they stand in the text.
Every shingle is a Poisson process seeded by the shingle, its rate its weight; each arrival hits a random register,
and a register keeps the shingle that arrives first.  Processes end early, at the time by which all registers of the
document have been hit.  Two documents agree on a register with a probability equal to their probability Jaccard
similarity.

Copies (equal word sequences) collapse first and count once.  Bands of registers name buckets.  In cells of bounded
size, registers are compared: a pair that agrees on less than `similarity` minus four standard errors is dismissed,
the others are proposed.  Whole shingle sets decide on what is proposed.  A first round looks at the first bands'
buckets and leaves components; later rounds look only at buckets that still hold several components, and at pairs
that would join them.  In the first two, a proposal that is all but certain makes others between its components
needless and the best few of a document come first.  The last round decides on every pair that is left, where its
cell is: the shingle sets of documents with such a pair come to the cell, and only links that join components leave
it, so that rows grow with the members of a cell, not with its pairs.  A pair is decided on in the cell of the first
band that it shares.  Large buckets are split: members are dealt to parts, and what isn't linked to the bucket's
smallest document meets every part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .recompression_dedup import words_of

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 4  # a pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^24 = 3e-6
FIRST_BANDS = 4
PART = 1000  # members of a bucket that meet in one task with their registers, of half a kilobyte
SET_BYTES = 64 << 20  # where whole shingle sets meet, parts are smaller if they might hold more than this
REGISTERS = 384  # of which the bands take the first; a byte of each is kept to estimate similarities by
ERRORS, SURE = 4.0, 0.84  # standard errors of an estimate that is given the benefit; agreement taken for a link meanwhile
FEW = 3  # proposals for a document of a cell in the rounds before the last, which looks at all
BROADCAST_IDS = 500_000  # ids up to this number (8 MB) go to all executors
FEATURES = "doc_id long, h1 long, h2 long, shingles long, bands array<long>, registers binary"
SETS = "doc long, keys binary, counts binary"


def shingles_of(block: C.Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document in the block, shingle and weight, for each document's distinct shingles."""
    words, count = words_of(block)
    start = np.cumsum(count) - count
    n = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    doc = C.starts_to_ids(n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[doc]
    length = np.minimum(count, size)[doc]
    key = np.full(len(doc), 17, np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for k in range(size):
        key = np.where(k < length, C.fold(key, padded[at + k]), key)
    own = C.fold(doc.astype(np.uint64) + np.uint64(1), key)  # equal shingles of one document meet in the order of this
    order = np.argsort(own, kind="stable")
    s = own[order]
    new = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    weight = np.diff(np.r_[new, len(s)])
    pick = order[new]
    again = np.argsort(doc[pick], kind="stable")
    return doc[pick][again], key[pick][again], weight[again]


def signatures(doc: np.ndarray, key: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """n_docs x m registers: the shingle whose process hits each first (0 for documents without any)."""
    total = np.bincount(doc, weight, n_docs)
    with np.errstate(divide="ignore"):
        limit = (np.log(m) + 3) * m / total
    when = np.full(n_docs * m, np.inf)
    who = np.zeros(n_docs * m, np.uint64)
    live = np.arange(len(doc))
    while len(live):
        hits, act, time, step = [], live, np.zeros(len(live)), 0
        while len(act):
            state = C.mix(key[act] + np.uint64((step + 1) * 0x632BE59BD9B4E019 & (2**64 - 1)))
            time = time - np.log1p(-(state >> np.uint64(11)).astype(np.float64) * 2.0**-53) / weight[act]
            soon = time <= limit[doc[act]]
            act, time = act[soon], time[soon]
            slot = doc[act] * m + (C.mix(state[soon] ^ C._A) % np.uint64(m)).astype(np.int64)
            np.minimum.at(when, slot, time)
            hits.append((slot, time, act))
            step += 1
        for slot, time, act in hits:
            won = when[slot] == time
            who[slot[won]] = key[act[won]]
        # documents with a register not hit yet go on for longer
        open_ = np.isinf(when.reshape(n_docs, m)).any(1)
        live = live[open_[doc[live]]]
        limit = limit * 2
    return who.reshape(n_docs, m)


def bands_of(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(registers), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(registers), b + 1, np.uint64)
        for r in range(rows):
            h = C.fold(h, registers[:, b * rows + r])
        out[:, b] = h
    return out


def features(batches):
    for batch in batches:
        for block in C.blocks(batch.column("text")):
            n = block.last - block.first
            doc, key, weight = shingles_of(block)
            count = np.bincount(doc, minlength=n)
            registers = signatures(doc, key, weight, n, REGISTERS)
            bands = bands_of(registers, BANDS, ROWS).view(np.int64)
            short = (registers >> np.uint64(56)).astype(np.uint8)
            full = [hashlib.blake2b(b" ".join(block.data[a:e].tobytes().split()), digest_size=16).digest() for a, e in zip(block.off[:-1].tolist(), block.off[1:].tolist(), strict=True)]
            h = np.frombuffer(b"".join(full), np.int64).reshape(n, 2)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(bands.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, n), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(count), lists, pa.array([x.tobytes() for x in short], pa.binary())], names=["doc_id", "h1", "h2", "shingles", "bands", "registers"])
        C.tidy()


def sets(batches):
    for batch in batches:
        for block in C.blocks(batch.column("text")):
            n = block.last - block.first
            doc, key, weight = shingles_of(block)
            order = np.lexsort((key, doc))
            key, weight = key[order], weight[order].astype(np.uint32)
            cut = np.r_[0, np.cumsum(np.bincount(doc, minlength=n))].tolist()
            parts = list(zip(cut[:-1], cut[1:], strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, n), pa.array([key[a:b].tobytes() for a, b in parts], pa.binary()), pa.array([weight[a:b].tobytes() for a, b in parts], pa.binary())], names=["doc", "keys", "counts"])
        C.tidy()


def probability_jaccard(a, b) -> float:
    """Sum over common shingles i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    (ka, xa), (kb, yb) = a, b
    at = np.searchsorted(kb, ka)
    at[at == len(kb)] = 0
    both = kb[at] == ka
    x, y = xa[both].astype(float), yb[at[both]].astype(float)
    if not len(x):
        return 0.0
    if xa.max() == 1 and yb.max() == 1:
        return len(x) / (len(ka) + len(kb) - len(x))
    only_a, only_b = float(xa.sum()) - x.sum(), float(yb.sum()) - y.sum()
    total = 0.0
    pairs, n = np.unique(np.stack([x, y]), axis=1, return_counts=True)
    for (p, q), k in zip(pairs.T, n.tolist(), strict=True):
        total += k / (np.maximum(pairs[0] / p, pairs[1] / q) @ n + only_a / p + only_b / q)
    return total


def agreeing(table: pa.Table, similarity: float):
    """Members of a cell (doc, first row, component) and the pairs of them, one a probe, that registers don't dismiss.

    Pairs are of different components, as places in the members, with their agreement.  If the table has bands and
    the band of the cell, pairs that share an earlier band are left to the cell of that.
    """
    docs, first = np.unique(table["doc"].to_numpy(), return_index=True)
    comp, probe = table["comp"].to_numpy()[first], np.zeros(len(docs), bool)
    flagged = table["doc"].to_numpy()[table["probe"].to_numpy(zero_copy_only=False)]
    probe[np.searchsorted(docs, flagged)] = True
    raw = table["registers"].to_pylist()
    registers = np.stack([np.frombuffer(raw[i], np.uint8) for i in first.tolist()])
    m = registers.shape[1]
    least = similarity - ERRORS * np.sqrt(similarity * (1 - similarity) / m)
    bands = None
    if "bands" in table.column_names:
        lists, band = table["bands"].to_pylist(), table["band"][0].as_py()
        bands = np.array([lists[i] for i in first.tolist()], np.int64)
    where, agree = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
    for i in np.flatnonzero(probe).tolist():
        other = np.flatnonzero((comp != comp[i]) & (~probe | (np.arange(len(docs)) > i)))
        if bands is not None:
            shared = bands[other] == bands[i]
            other = other[shared[:, band] & (shared.argmax(1) == band)]
        same = (registers[other] == registers[i]).mean(1)
        same = (same - 1 / 256) / (1 - 1 / 256)  # without the bytes that agree by chance
        keep = same >= least
        where.append(np.stack([np.full(keep.sum(), i), other[keep]], 1))
        agree.append(same[keep])
    return docs, first, comp, np.concatenate(where), np.concatenate(agree)


class Roots(dict):
    """Components of a cell that links have joined."""

    def of(self, c: int) -> int:
        while self[c] != c:
            self[c] = self[self[c]]
            c = self[c]
        return c


def propose(table: pa.Table, similarity: float, sure: float) -> pa.Table:
    """Pairs (a, b) of different components, one of them a probe, whose registers agree enough: a document's best few."""
    docs, _, comp, where, agree = agreeing(table, similarity)
    roots = Roots((c, c) for c in comp.tolist())
    a, b = [], []
    proposed = np.zeros(len(docs), np.int64)
    for k in np.argsort(-agree, kind="stable").tolist():
        i, j = where[k].tolist()
        if min(proposed[i], proposed[j]) >= FEW:
            continue  # there are rounds to come
        r, s = roots.of(int(comp[i])), roots.of(int(comp[j]))
        if r != s:
            proposed[[i, j]] += 1
            a.append(min(docs[i], docs[j]))
            b.append(max(docs[i], docs[j]))
            if agree[k] >= sure:
                roots[s] = r
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def in_question(table: pa.Table, similarity: float) -> pa.Table:
    """Members of a cell that stand in a pair to be decided on."""
    docs, _, comp, where, _ = agreeing(table, similarity)
    at = np.unique(where)
    probe = np.isin(docs, table["doc"].to_numpy()[table["probe"].to_numpy(zero_copy_only=False)])
    n = len(at)
    return pa.table({"cell": pa.array([table["cell"][0].as_py()] * n, pa.int64()), "band": pa.array([table["band"][0].as_py()] * n, pa.int32()), "doc": pa.array(docs[at]), "comp": pa.array(comp[at]), "probe": pa.array(probe[at])})


def settle(table: pa.Table, similarity: float) -> pa.Table:
    """Links (a, b) that join components of a cell, after whole shingle sets; every pair left is looked at."""
    docs, first, comp, where, agree = agreeing(table, similarity)
    keys, counts = table["keys"].to_pylist(), table["counts"].to_pylist()
    whole = [(np.frombuffer(keys[i], np.uint64), np.frombuffer(counts[i], np.uint32)) for i in first.tolist()]
    roots = Roots((c, c) for c in comp.tolist())
    a, b = [], []
    for k in np.argsort(-agree, kind="stable").tolist():
        i, j = where[k].tolist()
        r, s = roots.of(int(comp[i])), roots.of(int(comp[j]))
        if r != s and probability_jaccard(whole[i], whole[j]) >= similarity:
            roots[s] = r
            a.append(min(docs[i], docs[j]))
            b.append(max(docs[i], docs[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def decide(similarity: float):
    def run(batches):
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("keys_a", "counts_a", "keys_b", "counts_b")]
            ok = [probability_jaccard((np.frombuffer(k, np.uint64), np.frombuffer(x, np.uint32)), (np.frombuffer(q, np.uint64), np.frombuffer(y, np.uint32))) >= similarity for k, x, q, y in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    return run


def sets_of(wanted: DataFrame, docs: DataFrame, tag: str) -> DataFrame:
    """Shingle sets of the documents named by wanted's doc_id."""
    wanted = C.save(wanted.distinct(), f"{tag}-wanted")
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    texts = docs.join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    return C.save(texts.mapInArrow(sets, SETS), f"{tag}-sets")


def compare(cells: DataFrame, reps: DataFrame, docs: DataFrame, tested: DataFrame | None, similarity: float, sure: float, tag: str) -> DataFrame:
    """Pairs proposed in cells (members array<struct<doc, comp, probe>>) and not tested yet: a, b, ok."""
    cells = C.save(cells.where(F.size("members") > 1).select("members").distinct().withColumn("cell", F.xxhash64("members")), f"{tag}-cells")
    flat = cells.select("cell", F.inline("members")).join(reps.select("doc", "registers"), "doc")
    pairs = flat.groupBy("cell").applyInArrow(lambda t: propose(t, similarity, sure), "a long, b long").distinct()
    if tested is not None:
        pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    pairs = C.save(pairs, f"{tag}-pairs")
    whole = sets_of(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))), docs, tag)
    side = lambda x: whole.select(F.col("doc").alias(x), F.col("keys").alias(f"keys_{x}"), F.col("counts").alias(f"counts_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "keys_a", "counts_a", "keys_b", "counts_b")
    return C.save(both.mapInArrow(decide(similarity), "a long, b long, ok boolean"), f"{tag}-tested")


def last_links(cells: DataFrame, reps: DataFrame, docs: DataFrame, similarity: float, tag: str) -> DataFrame:
    """All links (a, b) that are left between components, found in cells (members and their band)."""
    # equal cells of several bands are one, of the first: a pair in it shares no earlier band
    cells = cells.where(F.size("members") > 1).groupBy("members").agg(F.min("band").alias("band"))
    cells = C.save(cells.withColumn("cell", F.xxhash64("members", "band")), f"{tag}-cells")
    flat = cells.select("cell", "band", F.inline("members")).join(reps.select("doc", "registers", "bands"), "doc")
    asked = C.save(flat.groupBy("cell").applyInArrow(lambda t: in_question(t, similarity), "cell long, band int, doc long, comp long, probe boolean"), f"{tag}-asked")
    whole = sets_of(asked.select(F.col("doc").alias("doc_id")), docs, tag)
    met = asked.join(reps.select("doc", "registers", "bands"), "doc").join(whole, "doc")
    return C.save(met.groupBy("cell").applyInArrow(lambda t: settle(t, similarity), "a long, b long").distinct(), f"{tag}-links")


def mixed_cells(banded: DataFrame, parts: DataFrame, whole: bool, tag: str) -> DataFrame:
    """Cells (members, band) for the buckets that hold more than one component: whole small ones, grids of parts for large ones."""
    comps = banded.select("doc", "value", "band", "shingles").join(parts.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "doc"))
    mixed = comps.groupBy("value").agg(F.count("*").alias("n"), F.max("shingles").alias("most"), F.min(F.struct("doc", "comp")).alias("c"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    # where whole sets are to meet, parts are the smaller the longer the bucket's longest document is
    fit = F.greatest(F.least(F.lit(SET_BYTES) / (12 * F.col("most")), F.lit(PART)), F.lit(2)).cast("long") if whole else F.lit(PART).cast("long")
    mixed = mixed.withColumn("size", fit)
    mixed = C.save(comps.join(mixed, "value").select("value", "band", "doc", "comp", "n", "size", (F.col("comp") != F.col("c.comp")).alias("apart")), f"{tag}-mixed")
    small = mixed.where("n <= size").groupBy("value").agg(F.array_sort(F.collect_list(member(F.col("comp"), F.lit(True)))).alias("members"), F.min("band").alias("band")).select("members", "band")
    large = mixed.where("n > size")
    apart = large.where("apart").groupBy("value").agg(F.count("*").alias("r"))
    grid = large.join(apart, "value").withColumns({"parts": F.ceil(F.col("n") / F.col("size")).cast("long"), "slices": F.ceil(F.col("r") / F.col("size")).cast("long")})
    deal = lambda of, salt: F.pmod(F.xxhash64("doc", F.lit(salt)), F.col(of))
    all_of = lambda of: F.explode(F.sequence(F.lit(0).cast("long"), F.col(of) - 1))
    members = grid.select("value", "band", deal("parts", 10).alias("part"), all_of("slices").alias("slice"), member(F.col("comp"), F.lit(False)).alias("x"))
    probes = grid.where("apart").select("value", "band", all_of("parts").alias("part"), deal("slices", 11).alias("slice"), member(F.col("comp"), F.lit(True)).alias("x"))
    crossed = members.unionByName(probes).groupBy("value", "part", "slice").agg(F.array_sort(F.collect_set("x")).alias("members"), F.min("band").alias("band")).select("members", "band")
    return small.unionByName(crossed)


def member(comp, probe):
    return F.struct(F.col("doc"), comp.alias("comp"), probe.alias("probe"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its class), n_shingles, kept (doc_id = class_id), for each row of docs.

    Classes are the components of links of probability Jaccard similarity >= `similarity`; equal word sequences are
    in one class.  Documents without words (null, empty, blank) are classes of their own; so are rows without a
    doc_id, whose class is null.  Rows that repeat a doc_id are the same document: where their texts differ, all are in
    one class, and the smallest text decides on its links.  Other columns are ignored; an empty table gives none.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    feats = C.save(rows.mapInArrow(features, FEATURES), "features")
    known = feats.where("doc_id is not null and shingles > 0")
    reps = C.save(known.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("bands", "registers", "shingles"), "doc_id").alias("s")), "reps")
    # buckets of one document are left out of everything that follows
    banded = reps.select(F.col("rep").alias("doc"), F.col("s.shingles").cast("int").alias("shingles"), F.posexplode("s.bands").alias("band", "value")).withColumn("band", F.col("band").cast("byte"))
    held = banded.groupBy("value").agg(F.count("*").alias("n"), F.min("doc").alias("center")).where("n > 1")
    banded = C.save(banded.join(held, "value"), "banded")
    # registers are sent about for documents in these buckets only
    met = C.save(banded.select("doc").distinct(), "met")
    met = F.broadcast(met) if met.count() <= BROADCAST_IDS else met
    signed = C.save(reps.select(F.col("rep").alias("doc"), "s.registers", "s.bands").join(met, "doc", "left_semi"), "signed")
    texts = rows.where("doc_id is not null")

    # first round: each member of a bucket of the first bands meets a part of it and its smallest document
    dealt = banded.where(F.col("band") < FIRST_BANDS).withColumn("part", F.pmod(F.xxhash64("doc", F.lit(9)), F.ceil(F.col("n") / PART).cast("long")))
    whole = dealt.groupBy("value", "part").agg(F.collect_list(member(F.col("doc"), F.lit(True))).alias("m"), F.min("center").alias("c"))
    center = F.array(F.struct(F.col("c").alias("doc"), F.col("c").alias("comp"), F.lit(True).alias("probe")))
    tested = compare(whole.select(F.array_sort(F.array_union("m", center)).alias("members")), signed, texts, None, similarity, SURE, "near1")
    parts = C.connected_components(tested.where("ok").select("a", "b"), "near1-components")
    more = compare(mixed_cells(banded, parts, False, "near2"), signed, texts, tested, similarity, SURE, "near2")
    links = tested.unionByName(more).where("ok").select("a", "b")
    parts = C.connected_components(links, "near2-components")
    links = links.unionByName(last_links(mixed_cells(banded, parts, True, "near3"), signed, texts, similarity, "near3"))
    hashes = F.struct("h1", "h2")
    several = C.save(known.groupBy("doc_id").agg(F.min(hashes).alias("low"), F.max(hashes).alias("high")).where("low < high").select("doc_id"), "several-texts")
    if not several.isEmpty():
        own = known.join(several, "doc_id", "left_semi").select("doc_id", "h1", "h2").distinct().join(reps.select("h1", "h2", "rep"), ["h1", "h2"])
        links = links.unionByName(own.join(own.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").select(F.col("rep").alias("a"), "b").where("a <> b"))
    parts = C.connected_components(links, "near3-components")

    told = known.select("doc_id", "h1", "h2", "shingles").join(reps.select("h1", "h2", "rep"), ["h1", "h2"]).join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    out = told.select("doc_id", F.coalesce("component", "rep").alias("class_id"), F.col("shingles").alias("n_shingles"))
    rest = feats.where("doc_id is null or shingles = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.col("shingles").alias("n_shingles"))
    return out.unionByName(rest).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stand for their class; a doc_id that repeats stands once, with its smallest text."""
    gone = C.save(near_duplicates(docs, similarity).where("not kept").select("doc_id"), "near-copies")
    left = docs.join(gone.distinct(), "doc_id", "left_anti").select(*docs.columns)
    once = left.where("doc_id is not null").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), "text").alias("_row"), F.any_value(F.struct(*docs.columns)).alias("_any"))
    once = once.select(F.coalesce("_row", "_any").alias("_row")).select("_row.*")  # min_by passes over null texts
    return once.unionByName(left.where("doc_id is null"))


def op7_probminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(C.documents(spark, sf_dir))
