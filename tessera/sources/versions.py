"""Tables published together: new partitions are written beside the old ones, and one small record, committed last, says
which count.

    root/<table>/v=<write>/<partition>=<value>/part-...     written once, never changed
    root/commits/<number>.json                              for each table its schema and, per partition, the write that counts

A reader takes the record of the highest number, or of the one it names, and reads the folders that it lists, so it
sees all tables before a change or all after it, whatever fails in between.  A writer starts from one record and commits
the next number by a rename that doesn't replace; if another has taken the number, it is refused and nothing is seen of
what it wrote.  A record holds an entry a partition.  HDFS renames at once; on a local disk the check and the rename are
two steps.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has committed on the same base."""


@dataclass(frozen=True)
class Version:
    """A committed record: its number, its tables, and a note of whoever wrote it."""

    number: int = 0
    tables: dict[str, dict] = field(default_factory=dict)
    note: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Refresh:
    """The rows of a table from start to end by a date column are to be those of rows in that window."""

    table: str
    rows: DataFrame
    date: str
    start: object
    end: object
    partition: str


@dataclass(frozen=True)
class Upsert:
    """Rows that take the place of those of equal keys (nulls equal), or are added; keys are unique in them."""

    table: str
    rows: DataFrame
    keys: tuple[str, ...]
    partition: str


class Store:
    """Versioned tables in a folder of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ------------------------------------------------------------ files

    def _path(self, at: str):
        return self.hadoop.Path(at)

    def _names(self, at: str) -> list[str]:
        path = self._path(at)
        fs = path.getFileSystem(self.conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _rename_new(self, source: str, target: str) -> None:
        """Raises where the target exists."""
        context = self.hadoop.FileContext.getFileContext(self._path(self.root).getFileSystem(self.conf).getUri(), self.conf)
        kind = getattr(self.hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        context.rename(self._path(source), self._path(target), how)

    # ------------------------------------------------------------ records

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.root}/commits") if n.endswith(".json") and n[:-5].isdigit()]

    def version(self, number: int | None = None) -> Version:
        """The record of a number, or the last; number 0 has no tables."""
        number = max(self.numbers(), default=0) if number is None else number
        if not number:
            return Version()
        return Version(number, **json.loads(self.spark.read.text(f"{self.root}/commits/{number:012d}.json", wholetext=True).first()[0]))

    def _commit(self, base: Version, tables: dict, note: dict) -> Version:
        new = Version(base.number + 1, tables, note)
        stage, target = f"{self.root}/commits/.stage-{uuid.uuid4().hex}", f"{self.root}/commits/{new.number:012d}.json"
        out = self._path(stage).getFileSystem(self.conf).create(self._path(stage))
        out.write(bytearray(json.dumps({"tables": tables, "note": note}, sort_keys=True).encode()))
        out.close()
        try:
            self._rename_new(stage, target)
        except Exception as e:
            self._path(stage).getFileSystem(self.conf).delete(self._path(stage), False)
            if new.number in self.numbers():
                raise Conflict(f"version {new.number} of {self.root} was committed by another writer") from e
            raise
        return new

    # ------------------------------------------------------------ tables

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        """The table as of a version, or the last."""
        entry = (version or self.version()).tables[table]
        schema = T.StructType.fromJson(entry["schema"])
        if not entry["parts"]:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        full = T.StructType([*schema.fields, T.StructField("_write", T.StringType())])
        dirs = [f"{base}/_write={write}/{part}" for part, write in sorted(entry["parts"].items())]
        return self.spark.read.schema(full).option("basePath", base).parquet(*dirs).select(*schema.names)

    def _write(self, table: str, rows: DataFrame, partition: str) -> dict[str, str]:
        """Writes partitions, large ones by several tasks, small ones by one; their folders and the write's name."""
        write = uuid.uuid4().hex
        at = f"{self.root}/{table}/_write={write}"
        rows.hint("rebalance", partition).write.partitionBy(partition).parquet(at)
        return {n: write for n in self._names(at) if n.startswith(f"{partition}=")}

    def _entry(self, rows: DataFrame, partition: str, parts: dict) -> dict:
        return {"schema": json.loads(rows.schema.json()), "partition": partition, "parts": parts}

    def create(self, tables: dict[str, tuple[DataFrame, str]], note: dict | None = None) -> Version:
        """Tables, each rows and partition column, as one version; those of equal names are replaced."""
        base = self.version()
        made = {t: self._entry(rows, p, self._write(t, rows, p)) for t, (rows, p) in tables.items()}
        return self._commit(base, base.tables | made, note or {})

    def refresh(self, changes: list[Refresh | Upsert], base: Version | None = None, note: dict | None = None) -> Version:
        """Replaces windows or rows of some tables, all in one version or none.

        Only partitions that a change touches, in the old rows or the new, are written; one that is left without rows is
        in the record no more.  Rows of a null date are outside every window.
        """
        base = base or self.version()
        tables = dict(base.tables)
        for c in changes:
            entry, old = tables[c.table], self.read(c.table, Version(base.number, tables))
            schema = T.StructType.fromJson(entry["schema"])
            fresh = c.rows.select(*(F.col(f.name).cast(f.dataType) for f in schema))
            where = fresh.select(c.partition)
            if isinstance(c, Refresh):
                inside = F.coalesce(F.col(c.date).between(F.lit(c.start), F.lit(c.end)), F.lit(False))
                fresh = fresh.where(inside)
                where = old.where(inside).select(c.partition).union(fresh.select(c.partition))
            touched = [r[0] for r in where.distinct().collect()]  # a row a partition
            if not touched:
                continue
            p = F.col(c.partition)
            there = old.where(p.isin([v for v in touched if v is not None]) | (p.isNull() if None in touched else F.lit(False)))
            folder = F.url_decode(F.replace(F.element_at(F.split("_metadata.file_path", "/"), -2), F.lit("+"), F.lit("%2B")))  # a file's path is that of a URI
            gone = {r[0] for r in there.select(folder).distinct().collect()} if entry["parts"] else set()
            if isinstance(c, Refresh):
                stay = there.where(~inside)
            else:
                names = {k: f"_new_{k}" for k in c.keys}
                same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()))
                stay = there.join(fresh.select(*(F.col(k).alias(n) for k, n in names.items())), same, "left_anti")
            parts = {n: w for n, w in entry["parts"].items() if n not in gone}
            tables[c.table] = entry | {"parts": parts | self._write(c.table, stay.unionByName(fresh), c.partition)}
        return self._commit(base, tables, note or {})

    def unreferenced(self, keep: int = 1) -> list[str]:
        """Folders that none of the last `keep` versions reads: of failed or refused writers, or replaced since."""
        used: dict[tuple[str, str], set[str]] = {}
        for n in sorted(self.numbers())[-keep:]:
            for t, e in self.version(n).tables.items():
                for part, w in e["parts"].items():
                    used.setdefault((t, f"_write={w}"), set()).add(part)
        found = []
        for t in self._names(self.root):
            for w in self._names(f"{self.root}/{t}"):
                if w.startswith("_write="):
                    at = f"{self.root}/{t}/{w}"
                    found += [at] if (t, w) not in used else [f"{at}/{p}" for p in self._names(at) if "=" in p and p not in used[t, w]]
        return found

    def vacuum(self, keep: int = 1) -> int:
        """Deletes them, and says how many; not while writers are at work, whose folders no version reads yet."""
        found = self.unreferenced(keep)
        for at in found:
            self._path(at).getFileSystem(self.conf).delete(self._path(at), True)
        return len(found)
