"""Sources and sinks: typed Parquet scans, staged writes, partition overwrite."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, or where that is unset, on one machine, one of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file:" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_source(spark: SparkSession, path: str, schema: T.StructType | None = None, partition_filter: str | None = None) -> DataFrame:
    """A hive-partitioned Parquet source; the filter is pruned to partitions by the scan."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.where(partition_filter) if partition_filter else df


def to_contract(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Columns of the contract, cast so that bad values become null; columns that are missing are null."""
    return df.select(*((F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in contract.items()))


def staged_write(df: DataFrame, path: str, stage: str, partition_by: tuple[str, ...] = (), rows: int | None = None) -> None:
    """Written beside first; published only if what was written reads back with the same schema and, if given, number of rows.

    Publishing moves folders: the whole table's, or those of the partitions that were written; rows are written once.
    """
    spark = df.sparkSession
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(stage)
    back = spark.read.schema(df.schema).parquet(stage)
    if rows is not None and back.count() != rows:
        raise ValueError("the number of rows written isn't the one expected")
    have = {f.name: f.dataType for f in spark.read.parquet(stage).schema if f.name not in partition_by}
    if not back.isEmpty() and have != {f.name: f.dataType for f in df.schema if f.name not in partition_by}:
        raise ValueError("the written schema differs from the one asked for")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(stage).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def leaves(at: str, depth: int) -> list[str]:
        if not depth:
            return [at]
        names = [s.getPath().getName() for s in fs.listStatus(hadoop.Path(f"{stage}/{at}" if at else stage))]
        return [x for n in names if "=" in n for x in leaves(f"{at}/{n}" if at else n, depth - 1)]

    for at in leaves("", len(partition_by)):
        source, target, aside = (hadoop.Path(f"{base}/{at}" if at else base) for base in (stage, path, f"{stage}-before"))
        for parent in (target.getParent(), aside.getParent()):
            fs.mkdirs(parent)
        was = fs.exists(target)
        if (was and not fs.rename(target, aside)) or not fs.rename(source, target):
            raise OSError(f"{target} couldn't be replaced; what was there is {aside}")
    fs.delete(hadoop.Path(f"{stage}-before"), True)
    fs.delete(hadoop.Path(stage), True)
