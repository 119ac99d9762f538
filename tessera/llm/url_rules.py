"""URL filters by a sorted array of digests.

Rules (host, path, verdict) fit a host and all its subdomains where the url's path starts with the rule's path; of
several that fit, the longest wins (of equal lengths, that of the longer host).  Spark gives each rule string (host and
path) its 64-bit xxhash and sorts by it; digests, offsets and full strings become one file that every executor fetches
once and maps into memory.  A task hashes the suffixes of its different hosts, finds them by one vectorised binary
search, then hashes and finds suffix + path prefix for the path lengths that the list has under those hosts.  Equal
digests are only candidates: the stored string decides.  What no rule fits isn't in the list, so it is allowed.

The file is made while the list stays below `limit_bytes`.  A longer list is joined by digest and string instead, with
equal results: both sides are shuffled then, and Spark splits suffixes that very many urls share.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SEED = 42  # that of Spark's xxhash64
AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
VERDICTS = ("allow", "block")
DEFAULT = "allow"

#: The rules of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; both empty for null, or where there is no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, AZ, AZ.lower()), path


def listed(rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict, key: one row a rule; rules that fit no url, or have no verdict, are left out; block beats allow."""
    r = rules.select(F.translate(F.col("host").cast("string"), AZ, AZ.lower()).alias("host"), F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), "verdict")
    possible = F.col("host").rlike(r"^[^/?#]+$") & F.col("path").rlike(r"^(/[^?#]*)?$")  # so that host and path can be told apart in one string
    r = r.where(F.coalesce(possible, F.lit(False)) & F.col("verdict").isin(*VERDICTS)).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    return r.withColumn("rule", F.concat("host", "path")).withColumn("key", F.xxhash64("rule"))


# ---------------------------------------------------------------- the file


def _section(rows: pa.Table, key: str, text: str) -> list[np.ndarray]:
    """Digests in order, offsets of the strings, and the strings, of rows that come sorted by digest."""
    off, data = C.text_buffers(rows[text])
    return [rows[key].to_numpy().astype("<i8"), (off - off[0]).astype("<i8"), data[off[0] : off[-1]].copy()]


def write_file(rules: pa.Table, hosts: pa.Table, path: str) -> None:
    """rules (key, rule, verdict, host_chars, chars) and hosts (key, host, lengths), both sorted by key."""
    lengths = hosts["lengths"].combine_chunks()
    parts = _section(rules, "key", "rule") + [pc.equal(rules["verdict"], "block").to_numpy().astype(np.uint8), rules["host_chars"].to_numpy().astype("<i8"), rules["chars"].to_numpy().astype("<i8")]
    parts += _section(hosts, "key", "host") + [np.asarray(lengths.offsets).astype("<i8"), lengths.flatten().to_numpy().astype("<i8")]
    with open(path, "wb") as f:
        np.array([len(parts), *(x.nbytes for x in parts)], "<i8").tofile(f)
        for x in parts:
            f.write(x.tobytes() + b"\0" * (-x.nbytes % 8))


class Index:
    """The file, mapped; `bits` keeps fewer bits of the digests, for tests of collisions."""

    KINDS = ["<i8", "<i8", "u1", "u1", "<i8", "<i8", "<i8", "<i8", "u1", "<i8", "<i8"]

    def __init__(self, path: str, bits: int = 64):
        with open(path, "rb") as f:
            whole = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
        n = int(whole[:8].view("<i8")[0])
        sizes = whole[8 : 8 + 8 * n].view("<i8")
        parts, at = [], 8 + 8 * n
        for size, kind in zip(sizes.tolist(), self.KINDS, strict=True):
            parts.append(whole[at : at + size].view(kind))
            at += size + -size % 8
        self.key, self.off, self.text, self.block, self.host_chars, self.chars, self.host_key, self.host_off, self.host_text, self.len_off, self.lens = parts
        self.host_sizes = set(np.diff(self.host_off).tolist())
        self.bits = bits
        if bits < 64:  # order by what is left of the digests
            self.order = np.argsort(self.cut(self.key), kind="stable")
            self.host_order = np.argsort(self.cut(self.host_key), kind="stable")

    def cut(self, keys: np.ndarray) -> np.ndarray:
        return keys & np.int64((1 << self.bits) - 1) if self.bits < 64 else keys

    def find(self, strings: list[bytes], host: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Which of the strings are stored, and where: positions of strings, and of entries."""
        stored, off, text = (self.host_key, self.host_off, self.host_text) if host else (self.key, self.off, self.text)
        probes = self.cut(np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in strings), np.uint64, len(strings)).view(np.int64))
        order = None
        if self.bits < 64:
            order = self.host_order if host else self.order
            stored = self.cut(stored)[order]
        lo, hi = np.searchsorted(stored, probes, "left"), np.searchsorted(stored, probes, "right")
        of, at = C.expand(lo, hi - 1)
        at = order[at] if order is not None else at
        same = np.fromiter((text[off[j] : off[j + 1]].tobytes() == strings[i] for i, j in zip(of.tolist(), at.tolist(), strict=True)), bool, len(of))
        return of[same], at[same]


def suffixes(host: bytes, sizes: set[int]) -> list[bytes]:
    """The host and what follows each of its dots, of the sizes that the list has."""
    n, out, at = len(host), [], 0
    while True:
        if n - at in sizes:
            out.append(host[at:])
        at = host.find(b".", at) + 1
        if not at:
            return out


def judge(index: Index, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
    """The entry of the rule that decides each url, or -1."""
    once: dict[bytes, int] = {}
    which = [once.setdefault(h, len(once)) for h in hosts]
    named = [(k, s) for h, k in once.items() for s in suffixes(h, index.host_sizes)]
    i, j = index.find([s for _, s in named], host=True)
    under: list[list[tuple[bytes, np.ndarray]]] = [[] for _ in once]
    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        under[named[a][0]].append((named[a][1], index.lens[index.len_off[b] : index.len_off[b + 1]]))
    of, probes = [], []
    for row, (k, path) in enumerate(zip(which, paths, strict=True)):
        for suffix, lens in under[k]:
            for n in lens[: np.searchsorted(lens, len(path), "right")].tolist():
                of.append(row)
                probes.append(suffix + path[:n])
    i, j = index.find(probes)
    best = np.full(len(hosts), -1, np.int64)
    if len(i):
        rows = np.asarray(of, np.int64)[i]
        order = np.lexsort((index.host_chars[j], index.chars[j], rows))
        best[rows[order]] = j[order]  # the last of a row stays
    return best


def verdicts(batches, name: str, bits: int = 64):
    """page_id, host, path, rule, verdict for batches of page_id, host, path."""
    index = Index(SparkFiles.get(name), bits)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = pa.Table.from_batches([batch.slice(at, 4096)])
            best = judge(index, *(part[c].cast(pa.binary()).to_pylist() for c in ("host", "path")))
            hit = best.tolist()
            part = part.append_column("rule", pa.array([index.text[index.off[j] : index.off[j + 1]].tobytes().decode() if j >= 0 else None for j in hit], pa.string()))
            yield from part.append_column("verdict", pa.array([VERDICTS[index.block[j]] if j >= 0 else DEFAULT for j in hit], pa.string())).to_batches()


OUT = "page_id long, host string, path string, rule string, verdict string"


def parsed(urls: DataFrame) -> DataFrame:
    host, path = host_and_path("url")
    return urls.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))


def by_file(urls: DataFrame, rules: DataFrame, bits: int = 64) -> DataFrame:
    """By the mapped file; rules as from `listed`, and of checked size."""
    spark = urls.sparkSession
    hosts = rules.groupBy("host").agg(F.sort_array(F.collect_set(F.octet_length("path"))).alias("lengths")).withColumn("key", F.xxhash64("host"))
    name = f"rules-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-"), name)
    entries = rules.select("key", "rule", "verdict", F.length("host").cast("long").alias("host_chars"), F.length("rule").cast("long").alias("chars")).orderBy("key", "rule")
    write_file(entries.toArrow(), hosts.select("key", "host", "lengths").orderBy("key", "host").toArrow(), path)
    spark.sparkContext.addFile(path)  # executors fetch it from the driver, those that start later too
    return parsed(urls).mapInArrow(lambda batches: verdicts(batches, name, bits), OUT)


def by_join(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The same by joins on digest and string, for lists of any size."""
    u = parsed(urls)
    cuts = F.expr("transform(sequence(1, size(split(host, '[.]'))), k -> substring_index(host, '.', -k))")
    once = u.select("host", "path").distinct()
    hosts = rules.groupBy(F.col("host").alias("suffix")).agg(F.collect_set(F.octet_length("path")).alias("lengths")).withColumn("key", F.xxhash64("suffix"))
    near = once.withColumn("suffix", F.explode(cuts)).withColumn("key", F.xxhash64("suffix")).join(hosts, ["key", "suffix"])
    near = near.withColumn("n", F.explode("lengths")).where("n <= octet_length(path)")
    tried = near.withColumn("rule", F.concat("suffix", F.expr("substring(encode(path, 'utf-8'), 1, n)").cast("string"))).withColumn("key", F.xxhash64("rule"))
    fits = tried.join(rules.select("key", "rule", "verdict", F.length("host").alias("host_chars")), ["key", "rule"]).where("host_chars = length(suffix)")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("chars"), "host_chars", "rule", "verdict")).alias("x")).select("host", "path", "x.rule", "x.verdict")
    return u.join(best, ["host", "path"], "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(DEFAULT)).alias("verdict"))


def filter_urls(urls: DataFrame, rules: DataFrame, limit_bytes: int = 1 << 30) -> DataFrame:
    """page_id, host, path, rule (the string that decides, or null), verdict (allow or block).

    One row for each row of urls (page_id, url); other columns play no part, and equal rows stay.  A null url, or one
    without `://`, has an empty host and path, fits no rule and is allowed; so is everything if there are no rules.
    Hosts are compared as they stand, with ports and the like.  A rule without a host, or without a verdict, is none; a
    rule's null path is empty; of two verdicts on one rule block counts.
    """
    kept = C.save(listed(rules), "url-rules")
    size = kept.agg(F.coalesce(F.sum(F.octet_length("rule") + F.octet_length("host") + 64), F.lit(0))).first()[0]
    return by_file(urls, kept) if size <= limit_bytes else by_join(urls, kept)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)


SQL = """WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
  h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
  p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
  r AS (SELECT * FROM (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES) + """) r(rh, rp, v)),
  f AS (SELECT page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(v, length(rh || rp)) AS v FROM (SELECT DISTINCT page_id, host, path FROM p) JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
  SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.v, 'allow') AS verdict FROM p LEFT JOIN f ON p.page_id IS NOT DISTINCT FROM f.page_id AND p.host = f.host AND p.path = f.path"""
