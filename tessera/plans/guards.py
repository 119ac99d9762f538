"""Saved pipelines, inspected plans and repaired folders over the driver tables."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ..operators import stages
from ..sources import repair, scans
from ..sources.tables import shared_dir, table
from . import research  # noqa: F401  whose SQL is used here
from .market import SQL, query


def place(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("d20_saved_pipeline", SQL["d20_winsor_zscore"])
def _(spark, sf):
    """Fitted on training rows as a stage of a pipeline, saved, loaded by another, applied to all rows."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    at = place(spark, "pipeline")
    Pipeline(stages=[stages.Winsor(inputCols=["o_totalprice"])]).fit(o.where(F.to_date("o_orderdate") < F.lit("1999-01-01").cast("date"))).save(at)
    return PipelineModel.load(at).transform(o).select("o_orderkey", F.round("o_totalprice", 4).alias("o_totalprice"))


@query("qa25_forbidden_scans", "SELECT 'all years' AS plan, 'refused' AS state, NULL::BIGINT AS n UNION ALL SELECT 'two years', 'ran', count(*) FROM orders WHERE year(o_orderdate) IN (1997, 1998) UNION ALL SELECT 'raw table', 'refused', NULL")
def _(spark, sf):
    """Plans are read before they run: without a filter on its partitions a source isn't scanned, nor is a forbidden folder."""
    at = place(spark, "orders-by-year")
    table(spark, sf, "orders").withColumn("y", F.year("o_orderdate")).write.partitionBy("y").parquet(at)
    years = spark.read.parquet(at)
    raw = scans.scans(table(spark, sf, "orders"))[0].paths
    plans = {"all years": years.where("o_totalprice > 0"), "two years": years.where("y in (1997, 1998)"), "raw table": table(spark, sf, "orders").where("o_orderkey = 1")}
    out = None
    for name, df in plans.items():
        try:
            n, state = scans.guarded(df, forbidden=raw).agg(F.count("*").alias("n")), "ran"
        except scans.ForbiddenScan:
            n, state = spark.range(1).select(F.lit(None).cast("long").alias("n")), "refused"
        row = n.select(F.lit(name).alias("plan"), F.lit(state).alias("state"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("snk10_repaired_files", "SELECT o_orderkey, round(o_totalprice)::BIGINT AS v, o_orderstatus FROM orders WHERE year(o_orderdate) <> 1998 UNION ALL SELECT o_orderkey, (o_orderkey % 100)::BIGINT, o_orderstatus FROM orders WHERE year(o_orderdate) = 1998")
def _(spark, sf):
    """A folder of files of which one year's hold a column as double, without loss, and lack none; they are repaired in place."""
    at = place(spark, "mixed")
    o = table(spark, sf, "orders").select("o_orderkey", F.round("o_totalprice").cast("long").alias("v"), "o_orderstatus", F.year("o_orderdate").alias("y"))
    o.where("y <> 1998").drop("y").write.parquet(f"{at}/whole")
    o.where("y = 1998").select("o_orderkey", (F.col("o_orderkey") % 100).cast("double").alias("v"), "o_orderstatus").write.parquet(f"{at}/double")
    contract = {"o_orderkey": "long", "v": "long", "o_orderstatus": "string"}
    repair.repair_files(spark, at, contract, f"{at}-backup")
    return spark.read.schema(", ".join(f"{c} {t}" for c, t in contract.items())).option("recursiveFileLookup", "true").parquet(at)
