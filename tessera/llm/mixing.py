"""Mixing sources to target weights, with DataFrame functions only.

Sizes are summed by source, targets follow by water filling over the sources (a table of one row each), and every
document is emitted floor(rate) times plus once more with a probability equal to the fraction, drawn from a hash of
its id, where rate is the target over the size of its source.  Each source draws with that seed of a fixed list whose
draw comes nearest to its target; one aggregation tries them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (5, 2, 1)
SEEDS = 64  # draws that each source chooses from
BROADCAST_ROWS = 10_000  # sources up to this number go to all executors, at some 100 bytes each


def words(column: str = "text"):
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; of a null none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size -> with target: weights repeat over the sources in code point order, null last.

    All sources share `share` times the whole size by weight; none gets more than `most` times its own, and what it
    can't take is shared again by weight among the others.  With the sources in order of the level at which they
    fill up, the common level is the largest that any prefix of filled sources leaves to the rest.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    level = Window.orderBy("fills_at", F.asc_nulls_last("source"))
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).cast("double"))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("fills_at", F.col("cap") / F.col("weight"))
    total = F.sum("source_size").over(everything)
    s = s.withColumn("level", (total * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("target", F.least("cap", F.greatest(F.max("level").over(everything), F.lit(0.0)) * F.col("weight")))
    return s.select("source", "source_size", "target")


def number():
    """A whole number below 2^32 that follows from doc_id."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 8), 16, 10).cast("long")


def drawn(number, seed, rate):
    """Whether a document gets a copy beyond floor(rate): the number, scrambled by the seed, as a share of 2^32."""
    return (number * (seed * 2 + 1) + seed * F.lit(0x9E3779B9)) % F.lit(1 << 32) < (rate - F.floor(rate)) * F.lit(2.0**32)


def goals(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, seeds: int = SEEDS) -> tuple[DataFrame, DataFrame]:
    """The sizes of docs, and of_source, source_size, target, rate, seed for each source."""
    sized = C.save(docs.select("doc_id", F.col("source").cast("string").alias("source"), words().alias("size")), "sizes")
    sources = C.save(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = C.save(targets(sources, weights, share, most).withColumn("rate", rate).withColumnRenamed("source", "of_source"), "targets")
    tried = joined(sized.withColumn("number", number()), goal).groupBy("of_source").agg(
        F.max("target").alias("target"),
        F.sum(F.col("size") * F.floor("rate")).alias("sure"),
        *(F.sum(F.when(drawn(F.col("number"), F.lit(s).cast("long"), F.col("rate")), F.col("size")).otherwise(0)).alias(f"by_{s}") for s in range(seeds)),
    )
    gaps = F.array(*(F.struct(F.abs(F.col("sure") + F.col(f"by_{s}") - F.col("target")).alias("gap"), F.lit(s).cast("long").alias("seed")) for s in range(seeds)))
    chosen = C.save(tried.select(F.col("of_source").alias("s"), F.array_min(gaps)["seed"].alias("seed")), "seeds")
    return sized, C.save(goal.join(chosen, F.col("of_source").eqNullSafe(F.col("s"))).drop("s"), "goals")


def joined(rows: DataFrame, goal: DataFrame) -> DataFrame:
    if goal.count() <= BROADCAST_ROWS:
        goal = F.broadcast(goal)
    return rows.join(goal, rows["source"].eqNullSafe(F.col("of_source")))


def copies():
    return F.floor("rate").cast("long") + F.when(drawn(number(), F.col("seed"), F.col("rate")), 1).otherwise(0).cast("long")


def rates(docs: DataFrame, **how) -> DataFrame:
    """One row for each row of docs: doc_id, size, source_size, target, copies, taken = size * copies.

    A null text has size 0; null is a source of its own; sources of size 0 have target 0 and their documents no
    copies; documents of one doc_id are drawn alike; other columns are ignored; an empty table gives none.  The
    sources, a row each, are sorted in one task, which spills: some ten million are a GB.
    """
    sized, goal = goals(docs, **how)
    out = joined(sized, goal).withColumn("copies", copies())
    return out.select("doc_id", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: the rows of docs with their columns, repeated as `rates` says."""
    whole = docs.select(F.struct(*docs.columns).alias("whole"), "doc_id", F.col("source").cast("string").alias("source"))
    out = joined(whole, goals(docs, **how)[1]).withColumn("copies", copies()).where("copies > 0")
    return out.select(F.explode(F.expr("sequence(1L, copies)")).alias("copy"), "whole").select("whole.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates(C.documents(spark, sf_dir))


SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s
), l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w
), t AS (
  SELECT source, source_size, least(cap, greatest(max(lev) OVER (), 0) * weight) AS target FROM l
), r AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS number
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), g AS (
  SELECT source, seed, abs(sum(size * floor(rate)::BIGINT + CASE WHEN (number * (2 * seed + 1) + seed * 2654435769) % 4294967296 < (rate - floor(rate)) * 4294967296.0::DOUBLE THEN size ELSE 0 END) - max(target)) AS gap
  FROM r, range(64) AS s(seed) GROUP BY source, seed
), b AS (
  SELECT source, seed FROM g QUALIFY row_number() OVER (PARTITION BY source ORDER BY gap, seed) = 1
), c AS (
  SELECT r.*, floor(rate)::BIGINT + CASE WHEN (number * (2 * seed + 1) + seed * 2654435769) % 4294967296 < (rate - floor(rate)) * 4294967296.0::DOUBLE THEN 1 ELSE 0 END AS copies
  FROM r JOIN b ON r.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target, copies::BIGINT AS copies, (size * copies)::BIGINT AS taken FROM c
"""
