"""Near-duplicate vectors by randomised-rotation binary codes.

Index.  Unit vectors are turned by one random rotation; a code keeps the signs, and beside it the correction factor
f, the inner product of the turned vector with its code as a unit vector.

Estimates.  For a code s and a turned vector y, (s . y) / (sqrt(d) f) is an unbiased estimate of the inner product,
with an error of at most `widths` times sqrt((1 - f^2) / (f^2 (d - 1))), except with a probability that falls
exponentially with the square of `widths` (5 here, chosen to lose practically no link).  Only pairs whose upper
bound reaches the threshold are computed again in double precision, which alone decides.

Copies of a vector count once, with their number.  The rest meet where the signs of their products with some random
directions agree, in one of several bands of directions.  There are as many directions in a band as make buckets of
some hundred vectors, and as many bands as leave a pair just at the threshold in no common bucket with a probability
of one in ten thousand (fewer above it); below a few hundred vectors there is one bucket, and nothing is missed.  A pair
counts in the first band that it shares.  Large buckets are cut into blocks, each of which meets each.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

INDEX = "rep long, copies long, e array<double>, code binary, factor double, keys array<long>"
LINKS = "a long, b long, n long"


def rotation(d: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed + d).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def units(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)  # squares must not overflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def banding(n: int, threshold: float, occupancy: int = 512, miss: float = 1e-4) -> tuple[int, int]:
    """Directions in a band, and bands, for n vectors."""
    bits = max(0, math.ceil(math.log2(max(n, 1) / occupancy)))
    agree = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return bits, 1 if agree == 1 else math.ceil(math.log(miss) / math.log1p(-agree))


def band_keys(u: np.ndarray, bits: int, bands: int) -> np.ndarray:
    """n x bands: a name for the signs of each band, in which the vectors' length and the band play a part."""
    d = u.shape[1]
    out = np.empty((len(u), bands), np.uint64)
    for k in range(bands):
        h = np.full(len(u), (d << 16) + k, np.uint64)
        if bits:
            signs = u @ np.random.default_rng((d, k)).standard_normal((d, bits)) > 0
            h = C.fold(h, signs.astype(np.uint64) @ (np.uint64(1) << np.arange(bits, dtype=np.uint64)))
        out[:, k] = C.mix(h)
    return out.view(np.int64)


def encode(batches, bits: int, bands: int):
    """Codes, factors and buckets for batches of (rep, copies, e); vectors of several lengths are encoded by length."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        n = np.diff(batch.column("e").offsets.to_numpy())
        for d in np.unique(n):
            part = table.filter(pa.array(n == d))
            u = units(part["e"])
            y = u @ rotation(int(d))
            keys = band_keys(u, bits, bands)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands), pa.int32()), pa.array(keys.ravel()))
            factor = np.abs(y).sum(1) / np.sqrt(d)
            signs = np.packbits(y > 0, axis=1)
            part = part.append_column("code", pa.array([x.tobytes() for x in signs], pa.binary())).append_column("factor", pa.array(factor)).append_column("keys", lists)
            yield from part.to_batches()


def linked(left: pa.Table, right: pa.Table | None, threshold: float, widths: float, strip: int = 1024):
    """Pairs of rows with cosine of at least threshold; right None: within left, each pair once."""
    same = right is None
    right = left if same else right
    if not left.num_rows or not right.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    u, v = units(left["e"]), units(right["e"])
    d = u.shape[1]
    y = (v @ rotation(d)).astype(np.float32)
    bits = np.unpackbits(np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(len(u), -1), axis=1)[:, :d]
    signs = bits.astype(np.float32) * 2 - 1
    f = np.clip(left["factor"].to_numpy(), 1e-9, 1)
    error = widths * np.sqrt((1 - f**2) / (f**2 * max(d - 1, 1)))
    need = ((threshold - error - 1e-4) * np.sqrt(d) * f).astype(np.float32)
    out_i, out_j = [], []
    for a in range(0, len(u), strip):
        first = a if same else 0  # within one block only later rows
        hit = np.flatnonzero(signs[a : a + strip] @ y[first:].T >= need[a : a + strip, None])
        i, j = hit // (len(y) - first) + a, hit % (len(y) - first) + first
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        for s in range(0, len(i), 1 << 16):
            p, q = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
            ok = np.einsum("ij,ij->i", u[p], v[q]) >= threshold
            out_i.append(p[ok])
            out_j.append(q[ok])
    return np.concatenate([*out_i, np.zeros(0, np.int64)]), np.concatenate([*out_j, np.zeros(0, np.int64)])


def cell(table: pa.Table, i: int, j: int, threshold: float, widths: float) -> pa.Table:
    """Rows (a, null, n): so many vectors are linked to a here; rows (a, b, 0): b is a's component in this cell."""
    reps, counts, edges_a, edges_b = [], [], [], []
    n = np.diff(table["e"].combine_chunks().offsets.to_numpy())
    block = table["block"].to_numpy()
    for d in np.unique(n):
        parts = [table.filter(pa.array((n == d) & (block == b))) for b in dict.fromkeys((i, j))]
        whole = pa.concat_tables(parts)
        ids, copies = whole["rep"].to_numpy(), whole["copies"].to_numpy()
        if len(parts) == 1:
            p, q = linked(parts[0], None, threshold, widths)
        else:
            p, q = linked(parts[0], parts[1], threshold, widths)
            q = q + parts[0].num_rows
        earlier = whole["earlier"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        new = ~(earlier[p] == earlier[q]).any(1)
        p, q = p[new], q[new]
        links = np.bincount(p, copies[q], len(ids)) + np.bincount(q, copies[p], len(ids)) if len(p) else np.zeros(len(ids))
        label = ids.copy()
        while len(p):
            before = label.copy()
            least = np.minimum(label[p], label[q])
            np.minimum.at(label, p, least)
            np.minimum.at(label, q, least)
            if (before == label).all():
                break
        some = links > 0
        reps.append(ids[some])
        counts.append(links[some].astype(np.int64))
        moved = some & (label != ids)
        edges_a.append(ids[moved])
        edges_b.append(label[moved])
    a, n, ea, eb = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64) for x in (reps, counts, edges_a, edges_b))
    return pa.table({"a": np.concatenate([a, ea]), "b": pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(eb)]), "n": np.concatenate([n, np.zeros(len(ea), np.int64)])})


def near_vectors(vectors: DataFrame, threshold: float = 0.95, widths: float = 5.0, block_rows: int = 4096) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable), kept (is its own).

    One row for each row of vectors (vec_id, embedding).  Vectors that are null, empty, zero or hold null or
    non-finite components link with nothing, nor do vectors of different lengths; copies link.  Rows of one vec_id
    and vector are one vector; a null vec_id links with nothing and has a null component.  Labels and other columns
    play no part; an empty table gives none.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    fine = F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0)
    # two hashes of 64 bits stand for the vector wherever equal vectors must meet
    keyed = rows.withColumn("fine", F.coalesce(fine, F.lit(False))).withColumn("e", F.when(F.col("fine"), F.transform("e", lambda x: x + 0.0)))
    keyed = keyed.withColumns({"h1": F.xxhash64("e"), "h2": F.xxhash64(F.reverse("e"), F.lit(5))})
    once = keyed.where("fine").groupBy("h1", "h2", "vec_id").agg(F.first("e").alias("e"))
    groups = once.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("e").alias("e"))
    index = C.save(groups, "vectors")
    bits, bands = banding(index.count(), threshold)
    codes = C.save(index.select("rep", "copies", "e").mapInArrow(lambda x: encode(x, bits, bands), INDEX), "codes")
    large = codes.select(F.explode("keys").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    large = C.save(large.select("key", F.ceil(F.col("n") / block_rows).cast("long").alias("blocks")), "buckets")
    met = codes.select("*", F.posexplode("keys").alias("band", "key")).withColumn("earlier", F.slice("keys", F.lit(1), F.col("band"))).drop("keys", "band").join(large, "key")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    met = met.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("other", other).select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).drop("other", "blocks")
    found = C.save(met.groupBy("key", "i", "j").applyInArrow(lambda key, t: cell(t, key[1].as_py(), key[2].as_py(), threshold, widths), LINKS), "links")
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    parts = C.connected_components(found.where("b is not null").select("a", "b"), "vector-components")
    told = index.select("h1", "h2", "rep", "copies").join(links, "rep", "left").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    told = told.select("h1", "h2", "copies", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("component", "rep").alias("component"))
    known = keyed.where("fine").select("vec_id", "h1", "h2").join(told, ["h1", "h2"]).select("vec_id", (F.col("n") + F.col("copies") - 1).cast("long").alias("n_links"), F.col("component").alias("component_id"))
    alone = keyed.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
