"""Exact top-k search by inner product with MaxScore.

A vector's dimensions are its terms.  Candidates are dealt to shards by the nearest of some of them; within a shard
every term has a posting list (the values of all documents) and bounds (its smallest and largest value).  For a
query, terms are ordered by the largest contribution they can make.  Against the score theta of the k-th best so far,
the last terms whose bounds together stay below theta are non-essential: no document competes by them alone.
Postings of the essential terms are traversed; the others are probed only for documents that can still reach theta.

There are two waves.  In the first a query meets the shard that it would be dealt to, which gives it a theta to start
from; in the second it is sent only to shards whose bounds together reach that theta.  Shards' best are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

FOUND = "query_id long, vec_id long, score long"
STRIP = 1024  # postings are traversed in strips, so that theta rises on the way


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of numbers, the shorter ones filled up with zeros."""
    flat = column.combine_chunks()
    n = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(n) and (n == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(n), dims))
    out[np.arange(dims)[None, :] < n[:, None]] = values
    return out


class Shard:
    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")  # so that earlier places win ties
        self.ids, rows = ids[order], rows[order]
        self.strips = [np.ascontiguousarray(rows[i : i + STRIP].T) for i in range(0, len(rows), STRIP)]
        self.low, self.high = rows.min(0), rows.max(0)

    def best(self, own: int, query: np.ndarray, k: int, theta: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best that reach theta, ties to smaller ids."""
        bound = np.maximum(query * self.low, query * self.high)
        terms = np.argsort(-bound, kind="stable")
        rest = np.cumsum(bound[terms][::-1])[::-1]  # what the terms from the j-th on can add
        rest = np.append(rest, 0.0)
        places, scores = np.zeros(0, np.int64), np.zeros(0)
        for s, lists in enumerate(self.strips):
            essential = int(np.argmax(rest < theta)) if rest[-1] < theta else len(terms)
            total = np.zeros(lists.shape[1])
            for t in terms[:essential]:
                if query[t]:
                    total += query[t] * lists[t]
            live = np.flatnonzero(total + rest[essential] >= theta)
            total = total[live]
            for j in range(essential, len(terms), 4):
                for t in terms[j : j + 4]:
                    total += query[t] * lists[t][live]
                can = total + rest[min(j + 4, len(terms))] >= theta
                live, total = live[can], total[can]
            live = live + s * STRIP
            other = self.ids[live] != own
            places, scores = np.concatenate([places, live[other]]), np.concatenate([scores, total[other]])
            if len(scores) > k:
                order = np.lexsort((places, -scores))[:k]
                places, scores = places[order], scores[order]
            if len(scores) == k:
                theta = max(theta, scores.min())
        return places, scores


def search_cell(candidates: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best candidates of one shard for each query of one block."""
    if not candidates.num_rows or not queries.num_rows:
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
    longest = lambda t: int(np.diff(t["terms"].combine_chunks().offsets.to_numpy()).max())
    dims = max(longest(candidates), longest(queries))
    rows, asks = matrix(candidates["terms"], dims), matrix(queries["terms"], dims)
    ids, own = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
    if np.abs(rows).max(initial=0) * np.abs(asks).max(initial=0) * max(dims, 1) >= 2.0**53:
        return huge(ids, rows, own, asks, k)
    shard, thetas = Shard(ids, rows), queries["theta"].to_numpy()
    q, c, s = [], [], []
    for i in range(len(own)):
        places, scores = shard.best(own[i], asks[i], k, thetas[i])
        q.append(np.full(len(places), own[i]))
        c.append(shard.ids[places])
        s.append(scores.astype(np.int64))
    return pa.table({"query_id": np.concatenate(q), "vec_id": np.concatenate(c), "score": np.concatenate(s)})


def huge(ids, rows, own, asks, k) -> pa.Table:
    """Components too large for exact doubles: whole numbers of any size; scores beyond 64 bits stand at their limit."""
    out = []
    ints = [[int(x) for x in r] for r in rows]
    for o, a in zip(own.tolist(), asks, strict=True):
        a = [int(x) for x in a]
        scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, r, strict=True)))), i) for i, r in zip(ids.tolist(), ints, strict=True) if i != o)
        out += [(o, i, -s) for s, i in scored[:k]]
    q, c, s = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(c, pa.int64()), "score": pa.array(s, pa.int64())})


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.maximum(np.abs(rows).max(1, initial=0, keepdims=True), 1e-300)
    return rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-300)


def dealt(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows with the number of the pivot at the smallest angle."""
    directions = unit(pivots).T

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            near = (unit(matrix(table["terms"], len(directions))) @ directions).argmax(1)
            yield from table.append_column("pivot", pa.array(near, pa.int64())).to_batches()

    return rows.mapInArrow(run, "vec_id long, terms array<double>, pivot long")


def bounds(table: pa.Table, dims: int) -> pa.Table:
    rows = matrix(table["terms"], dims)
    return pa.table({"shard": table["shard"].slice(0, 1), "low": pa.array([rows.min(0)]), "high": pa.array([rows.max(0)])})


def rivals(asked: DataFrame, shards: np.ndarray, low: np.ndarray, high: np.ndarray) -> DataFrame:
    """asked once for each shard but its own whose bounds together reach theta."""

    def run(batches):
        rows = max(1, (1 << 20) // len(shards))  # of bounds by shard that are held at once
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                table = pa.Table.from_batches([batch.slice(at, rows)])
                q, theta, home = matrix(table["terms"], low.shape[1]), table["theta"].to_numpy(), table["shard"].to_numpy()
                most = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
                of, to = np.nonzero((most + np.abs(most) * 1e-9 >= theta[:, None]) & (shards[None] != home[:, None]))
                for i in range(0, len(of), 1 << 14):
                    part = table.take(pa.array(of[i : i + (1 << 14)]))
                    yield from part.set_column(part.column_names.index("shard"), "shard", pa.array(shards[to[i : i + (1 << 14)]])).to_batches()

    return asked.mapInArrow(run, asked.schema)


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, shard_rows: int = 8192, block_rows: int = 2048, most: int = 4096, table_bytes: int = 16 << 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k highest inner products, ties to smaller vec_id.

    queries, candidates: vec_id long, terms array<double> of whole numbers; shorter arrays count as filled up with
    zeros.  A candidate of a query's own vec_id is left out; rows without vec_id or terms take no part; repeated
    rows count once; without queries or candidates there is no result.  A task holds a shard and a block of queries.
    There are about `most` shards and 256 blocks at most (larger ones instead), and fewer shards if their bounds, which
    the driver and all tasks hold, were to take more than table_bytes.
    """
    clean = lambda df: df.where("vec_id is not null and terms is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("terms").cast("array<double>").alias("terms")).distinct()
    queries, candidates = clean(queries), C.save(clean(candidates), "candidates")
    n_c, longest = candidates.agg(F.count("*"), F.max(F.size("terms"))).first()
    n_q, longest_q = queries.agg(F.count("*"), F.max(F.size("terms"))).first()
    dims = max(longest or 0, longest_q or 0, 1)
    most = max(1, min(most, table_bytes // (16 * dims)))
    size = max(shard_rows, -(-n_c // most))
    first = candidates.orderBy(F.xxhash64("vec_id"), "vec_id", "terms").limit(max(1, -(-n_c // size))).select("terms").collect()
    pivots = np.zeros((max(1, len(first)), dims))
    for i, r in enumerate(first):
        pivots[i, : len(r["terms"])] = r["terms"]
    placed = C.save(dealt(candidates, pivots), "placed")
    spark = candidates.sparkSession
    base, shards = 0, []
    for r in placed.groupBy("pivot").agg(F.count("*").alias("n")).orderBy("pivot").collect():  # a row a pivot
        shards.append((r["pivot"], base, -(-r["n"] // size)))
        base += shards[-1][2]
    shards = F.broadcast(spark.createDataFrame(shards, "pivot long, base long, parts long"))
    sharded = lambda df: df.join(shards, "pivot").withColumn("shard", F.col("base") + F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts"))).select("vec_id", "terms", "shard")
    left = sharded(placed)
    asked = C.save(sharded(dealt(queries, pivots)), "asked")
    blocks = max(1, min(256, -(-n_q // block_rows)))

    def search(asked: DataFrame) -> DataFrame:
        right = asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)))
        cells = right.select(F.col("shard").alias("s"), F.col("part").alias("p")).distinct()
        met = left.join(cells, F.col("shard") == F.col("s")).select("vec_id", "terms", F.col("s").alias("shard"), F.col("p").alias("part"))
        return met.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInArrow(lambda c, q: search_cell(c, q, k), FOUND)

    found = C.save(search(asked.withColumn("theta", F.lit(float("-inf")))), "first-found")
    theta = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").cast("double").alias("s")).where(F.col("n") >= k)
    asked = asked.join(theta, "vec_id", "left").select("vec_id", "terms", "shard", F.coalesce("s", F.lit(float("-inf"))).alias("theta"))
    table = left.groupBy("shard").applyInArrow(lambda t: bounds(t, dims), "shard long, low array<double>, high array<double>").collect()
    if len(table) > 1:
        low, high = (np.array([r[x] for r in table], float) for x in ("low", "high"))
        again = C.save(rivals(asked, np.array([r["shard"] for r in table]), low, high), "rivals")
        found = found.unionByName(search(again))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def scaled(embeddings: DataFrame, by: int = 64) -> DataFrame:
    """vec_id, terms = floor(by * x); rows whose vector is null or holds a null or non-finite component are left out."""
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    e = e.where(F.col("e").isNotNull() & F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return e.select("vec_id", F.transform("e", lambda x: F.when(F.abs(x * by) < 2.0**53, F.floor(x * by).cast("double")).otherwise(x * by)).alias("terms"))


def op1_maxscore_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(terms.where(F.col("vec_id") % 20 == 0), terms)


SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS t FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum([q.t[i] * c.t[i] FOR i IN range(1, len(q.t) + 1)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
