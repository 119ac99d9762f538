"""Schema repair of a folder of Parquet files, file by file: footers are read by Spark, only files that differ are cast."""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import or_

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOOTER = "path string, length long, rows long, columns map<string,string>"


def _kind(t: pa.DataType) -> str:
    """An Arrow type as Spark's name."""
    names = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint", "float": "float", "double": "double", "bool": "boolean", "string": "string", "large_string": "string", "binary": "binary", "date32[day]": "date"}
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    if pa.types.is_timestamp(t):
        return "timestamp" if t.tz else "timestamp_ntz"
    return names.get(str(t), str(t))


def _footers(batches):
    for batch in batches:
        rows = []
        for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
            fs, at = pyarrow.fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
            with fs.open_input_file(at) as f:
                meta = pq.ParquetFile(f)
                rows.append({"path": path, "length": length, "rows": meta.metadata.num_rows, "columns": [(c.name, _kind(c.type)) for c in meta.schema_arrow]})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("length", pa.int64()), ("rows", pa.int64()), ("columns", pa.map_(pa.string(), pa.string()))]))


def footers(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, rows, columns (name: type) of every Parquet file of a folder; of a file only its footer is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder).select("path", "length")
    return files.repartition(max(1, min(64, spark.sparkContext.defaultParallelism))).mapInArrow(_footers, FOOTER)


def differing(found: DataFrame, contract: dict[str, str]) -> DataFrame:
    """path, rows, columns, column, expected, actual: a row for each column of a file that isn't as the contract says, or is missing."""
    norm = {c: T._parse_datatype_string(t).simpleString() for c, t in contract.items()}
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("expected"), F.element_at("columns", c).alias("actual")) for c, t in norm.items())))
    return found.select("path", "rows", "columns", each.alias("x")).select("path", "rows", "columns", "x.*").where(~F.col("expected").eqNullSafe(F.col("actual")))


def repair_files(spark: SparkSession, folder: str, contract: dict[str, str], backup: str) -> DataFrame:
    """path, rows, state (ok, repaired, lossy, or empty: differs, but has no rows) of every file of a folder.

    Files whose columns differ from the contract are read with their own schema, cast, and written to a staging folder,
    in their order of rows; a file of which a cast would lose a value stays as it is.  Only when all are staged and
    their rows counted, each original is moved to `backup` and the staged file to its place, after a manifest of the
    moves has been written there.  Files that are as they should be aren't touched.  Files are gone through by kind, of
    which there are few; the names of those to be repaired pass through the driver.
    """
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    stage = f"{backup}/stage-{uuid.uuid4().hex}"
    footers(spark, folder).write.parquet(f"{stage}/footers")
    found = spark.read.parquet(f"{stage}/footers")
    kinds = differing(found, contract).select("path", F.to_json("columns").alias("columns")).distinct()
    moves, lossy, differ = [], [], []
    for kind in kinds.groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect():
        made, bad = _staged(spark, kind.paths, json.loads(kind["columns"]), contract, f"{stage}/{uuid.uuid4().hex}")
        moves += made
        lossy += bad
        differ += kind.paths
    rows = {r.path: r.rows for r in found.where(F.col("path").isin([p for _, p in moves])).collect()} if moves else {}
    for staged, path in moves:
        if spark.read.parquet(staged).count() != rows[path]:
            raise ValueError(f"{path}: staged rows aren't as many")
    kept = [(staged, path, f"{backup}/{uuid.uuid4().hex}-{path.rsplit('/', 1)[1]}") for staged, path in moves]
    if kept:
        spark.createDataFrame(kept, "staged string, path string, kept string").coalesce(1).write.json(f"{stage}/moves")
    for staged, path, old in kept:
        fs = hadoop.Path(path).getFileSystem(conf)
        if not (fs.rename(hadoop.Path(path), hadoop.Path(old)) and fs.rename(hadoop.Path(staged), hadoop.Path(path))):
            raise OSError(f"{path} couldn't be replaced; its original is {old}")
    state = F.when(F.col("path").isin([p for _, p in moves]), "repaired").when(F.col("path").isin(lossy), "lossy").when(F.col("path").isin(differ), "empty").otherwise("ok")
    return found.select("path", "rows", state.alias("state"))


def _staged(spark: SparkSession, paths: list[str], have: dict[str, str], contract: dict[str, str], at: str) -> tuple[list[tuple[str, str]], list[str]]:
    """Writes files of one kind as the contract says, one file each: (staged, original) of them, and those that would lose values."""
    own = spark.read.schema(", ".join(f"`{c}` {t}" for c, t in have.items())).parquet(*paths)
    own = own.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    casts = [c for c, t in contract.items() if c in have and have[c] != T._parse_datatype_string(t).simpleString()]
    lost = [F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(c).try_cast(contract[c]).try_cast(have[c])) for c in casts]
    lossy = sorted(r[0] for r in own.where(reduce(or_, lost)).select("_file").distinct().collect()) if lost else []
    fixed = own.where(~F.col("_file").isin(lossy)) if lossy else own
    cols = [(F.col(c).try_cast(t) if c in have else F.lit(None).cast(t)).alias(c) for c, t in contract.items()]
    cols += [F.col(c) for c in have if c not in contract]
    named = fixed.select(F.sha2("_file", 256).alias("_name"), "_row", *cols)
    named.repartition("_name").sortWithinPartitions("_name", "_row").drop("_row").write.partitionBy("_name").parquet(at)
    fs = spark._jvm.org.apache.hadoop.fs.Path(at).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = []
    for r in fixed.select("_file", F.sha2("_file", 256).alias("_name")).distinct().collect():
        (one,) = (s.getPath().toString() for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_name={r['_name']}")) if s.getPath().getName().endswith(".parquet"))
        made.append((one, r["_file"]))
    return made, lossy
