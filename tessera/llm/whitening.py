"""Whitening of embeddings from exact covariances, by matrix products of digit slices.

Entries become integers x; with n vectors and sums S the centred entries z = n x - S are integers too.  A task cuts
|z| into limbs of LIMB bits, signs kept, and multiplies limb matrices by float64 BLAS in strips of at most STRIP
vectors: a product of two limbs has 2 LIMB bits, a sum over a strip log2(STRIP) more, 53 in all, so every product is
exact.  Sums of strips are recombined as big integers, written in digits of base 2^DIGIT, and merged by Spark in a tree
of at most FAN partial rows at a time.  The whole sum, Z'Z = n^3 V, is turned into V by divisions of integers, each
rounded once, and decomposed.  What tasks send grows with their number and the square of the vectors' length, never
with the vectors; the largest thing that one task holds is the matrix of one length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

LIMB, STRIP = 18, 1 << 17  # 2 * 18 + 17 = 53 bits
DIGIT, FAN = 30, 32
EDGE = 1 << 53  # entries beyond are held there
MODEL_BYTES = 1 << 28  # of sums and components by length, which every task gets

GRAM = "dim int, part long, i int, digits binary"
FITTED = "dim int, component int, e double, trace double, axis array<double>"
OUT = "vec_id long, dim int, n long, deviation string, w array<double>"


def integers(column, scale: int, shift: int) -> np.ndarray:
    """floor(scale * c) + shift for vectors of one length, as long; beyond 2^53 they are held at it."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    c = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(c * scale), -EDGE, EDGE).astype(np.int64) + shift


def by_length(batches):
    """(length, rows) for each batch, in slices of some MB."""
    for batch in batches:
        for at in range(0, batch.num_rows, 8192):
            part = pa.Table.from_batches([batch.slice(at, 8192)])
            n = part["v"].combine_chunks().value_lengths().to_numpy()
            for d in np.unique(n):
                yield int(d), part.filter(pa.array(n == d))


def sums(batches, scale: int, shift: int):
    """dim, i, n, s: sums of a task's entries."""
    held: dict[int, list] = {}
    for d, rows in by_length(batches):
        x = integers(rows["v"], scale, shift)
        n, s = held.get(d, (0, np.zeros(d, object)))
        fits = (int(np.abs(x).max(initial=0)) + 1) * len(x) < 2**62
        held[d] = (n + len(x), s + (x if fits else x.astype(object)).sum(0).astype(object))
    for d, (n, s) in held.items():
        yield pa.RecordBatch.from_pydict({"dim": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()), "n": pa.array([n] * d, pa.int64()), "s": pa.array([str(v) for v in s], pa.string())})


def centred(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """n x - S, as long where that holds it, else as Python's integers."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, s.tolist()), default=0) < 2**62:
        return x * n - s.astype(np.int64)
    return x.astype(object) * n - s


def limbs(z: np.ndarray) -> list[np.ndarray]:
    """z as matrices of float64, least significant first: z = sum of limb k times 2^(LIMB k), all limbs with z's sign."""
    sign = np.where(z < 0, -1, 1).astype(np.float64)
    rest, out = abs(z), []
    while True:
        out.append((rest & ((1 << LIMB) - 1)).astype(np.float64) * sign)
        rest = rest >> LIMB
        if not rest.any():
            return out


class Gram:
    """The exact sum of z z' over vectors of one length."""

    def __init__(self, d: int):
        self.total = np.zeros((d, d), object)
        self.open: dict[int, np.ndarray] = {}  # by the power of 2^LIMB, sums of exact products
        self.held: list[np.ndarray] = []
        self.rows = self.strips = 0

    def add(self, z: np.ndarray) -> None:
        self.held.append(z)
        self.rows += len(z)
        if self.rows * z.shape[1] >= 1 << 20 or self.rows >= STRIP // 2:
            self.close_strip()

    def close_strip(self) -> None:
        if not self.held:
            return
        z = np.concatenate(self.held)
        assert len(z) <= STRIP
        parts = limbs(z)
        for a, left in enumerate(parts):
            for b, right in enumerate(parts[a:], a):
                p = (left.T @ right).astype(np.int64)
                self.open[a + b] = self.open.get(a + b, 0) + (p if a == b else p + p.T)
        self.held, self.rows, self.strips = [], 0, self.strips + 1
        if self.strips == 64:  # 2^53 each, up to some ten pairs of limbs a power: below 2^63
            self.recombine()

    def recombine(self) -> None:
        for power, p in self.open.items():
            self.total = self.total + p.astype(object) * (1 << (LIMB * power))
        self.open, self.strips = {}, 0

    def done(self) -> np.ndarray:
        self.close_strip()
        self.recombine()
        return self.total


def to_digits(values: np.ndarray) -> np.ndarray:
    """Big integers as rows of signed digits of base 2^DIGIT."""
    width = max((int(v).bit_length() for v in values), default=0) // DIGIT + 1
    out, sign = np.zeros((len(values), width), np.int64), np.array([-1 if v < 0 else 1 for v in values], np.int64)
    rest = abs(values)
    for k in range(width):
        out[:, k] = (rest & ((1 << DIGIT) - 1)).astype(np.int64) * sign
        rest = rest >> DIGIT
    return out


def from_digits(raw: bytes, d: int) -> np.ndarray:
    x = np.frombuffer(raw, "<i8").reshape(d, -1)
    out = np.zeros(d, object)
    for k in range(x.shape[1]):
        out = out + x[:, k].astype(object) * (1 << (DIGIT * k))
    return out


def grams(batches, model: dict, scale: int, shift: int):
    """dim, part, i, digits: rows of a task's sums of z z'."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    held: dict[int, Gram] = {}
    for d, rows in by_length(batches):
        n, s = model[d]
        held.setdefault(d, Gram(d)).add(centred(integers(rows["v"], scale, shift), n, s))
    for d in list(held):
        total = held.pop(d).done()
        for at in range(0, d, 64):
            rows = range(at, min(d, at + 64))
            yield pa.RecordBatch.from_pydict({"dim": pa.array([d] * len(rows), pa.int32()), "part": pa.array([part] * len(rows), pa.int64()), "i": pa.array(rows, pa.int32()), "digits": pa.array([to_digits(total[i]).tobytes() for i in rows], pa.binary())})


def added(key, table: pa.Table) -> pa.Table:
    """One row for some rows of a matrix's row i."""
    d, part, i = (k.as_py() for k in key)
    total = sum((from_digits(raw, d) for raw in table["digits"].to_pylist()), np.zeros(d, object))
    return pa.table({"dim": pa.array([d], pa.int32()), "part": pa.array([part], pa.int64()), "i": pa.array([i], pa.int32()), "digits": pa.array([to_digits(total).tobytes()], pa.binary())})


def merged(partial: DataFrame) -> DataFrame:
    """One row for each row of a matrix, whatever the number of parts."""
    parts = (partial.agg(F.max("part")).first()[0] or 0) + 1
    while parts > 1:
        parts = math.ceil(parts / FAN)
        partial = C.save(partial.withColumn("up", F.expr(f"part div {FAN}")).groupBy("dim", "up", "i").applyInArrow(lambda key, t: added(key, t), GRAM), "gram")
    return partial


def decompose(table: pa.Table, model: dict, components: int) -> pa.Table:
    """The leading eigenvectors of V for one length."""
    d = table["dim"][0].as_py()
    n = model[d][0]
    order = np.argsort(table["i"].to_numpy())
    raw, cube = table["digits"].to_pylist(), n**3
    v = np.array([[int(x) / cube for x in from_digits(raw[k], d)] for k in order])
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    k = int((e > max(e[0], 0) * d * 2.0**-50).sum()) if e[0] > 0 else 0
    return pa.table({"dim": pa.array([d] * k, pa.int32()), "component": pa.array(range(1, k + 1), pa.int32()), "e": pa.array(e[:k]), "trace": pa.array([float(np.trace(v))] * k, pa.float64()), "axis": pa.array([axes[:, j].tolist() for j in range(k)], pa.list_(pa.float64()))})


def projected(batches, model: dict, axes: dict, scale: int, shift: int):
    """vec_id, dim, n, deviation, w: the whitened values of each vector."""
    for d, rows in by_length(batches):
        if d not in axes:
            continue
        n, s = model[d]
        z = centred(integers(rows["v"], scale, shift), n, s)
        wide = z.dtype == object or int(np.abs(z).max(initial=0)) ** 2 * d >= 2**62
        deviation = ((z.astype(object) if wide else z) ** 2).sum(1)
        e, axis = axes[d]
        w = (z / n).astype(np.float64) @ axis.T / np.sqrt(e)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, len(e)), pa.int32()), pa.array(w.ravel()))
        yield pa.RecordBatch.from_arrays([rows["vec_id"].combine_chunks(), pa.array([d] * len(w), pa.int32()), pa.array([n] * len(w), pa.int64()), pa.array([str(x) for x in deviation.tolist()], pa.string()), lists], ["vec_id", "dim", "n", "deviation", "w"])


def fine_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, v of rows whose vector isn't null or empty and holds neither null nor non-finite entries."""
    v = F.col("embedding")
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(ok, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def whiten(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """vec_id, component, n, deviation (decimal(38,0), null where it has more digits), whitened, explained, identity_error.

    Every entry c becomes x = floor(scale c) + shift.  Rows of vectors (vec_id, embedding) whose vector is null, empty,
    or holds a null or non-finite entry are dropped; all others, copies and rows of a null vec_id too, are fitted and
    returned with a row for each component.  Vectors of different lengths are fitted by themselves, n counting those of
    their length.  Only components of a positive eigenvalue are numbered, so where all vectors are equal there is no
    row.  Entries beyond 2^53 / scale are held there.  Other columns play no part; an empty table gives none.
    """
    spark, rows = vectors.sparkSession, fine_vectors(vectors)
    total = rows.mapInArrow(lambda b: sums(b, scale, shift), "dim int, i int, n long, s string")
    total = total.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(28,0)")).cast("string").alias("s"))
    total = C.save(total, "sums")
    lengths, entries = total.agg(F.count_distinct("dim"), F.count("*")).first()
    if entries * 8 * (components + 4) > MODEL_BYTES:
        raise ValueError(f"{lengths} different lengths of vectors: what they share exceeds {MODEL_BYTES} bytes")
    model: dict = {}
    for r in total.orderBy("dim", "i").collect():  # a row for each dimension, checked above
        model.setdefault(r.dim, (r.n, []))[1].append(int(r.s))
    model = {d: (n, np.array(s, object)) for d, (n, s) in model.items()}
    gram = merged(C.save(rows.mapInArrow(lambda b: grams(b, model, scale, shift), GRAM), "gram"))
    fitted = C.save(gram.groupBy("dim").applyInArrow(lambda t: decompose(t, model, components), FITTED), "components")
    axes: dict = {}
    for r in fitted.orderBy("dim", "component").collect():  # a row a component
        axes.setdefault(r.dim, ([], []))[0].append(r.e)
        axes[r.dim][1].append(r.axis)
    axes = {d: (np.array(e), np.array(a)) for d, (e, a) in axes.items()}
    out = C.save(rows.mapInArrow(lambda b: projected(b, model, axes, scale, shift), OUT), "whitened")
    at = lambda k: F.get("w", F.lit(k))
    far = [F.abs(F.covar_pop(at(i), at(j)) - (1.0 if i == j else 0.0)) for i in range(components) for j in range(i + 1)]
    error = out.groupBy("dim").agg(F.array_max(F.array(*far)).alias("identity_error"))  # covariances of what a length lacks are null
    told = fitted.select("dim", "component", (F.col("e") / F.col("trace")).alias("explained")).join(error, "dim").groupBy("dim", "identity_error").agg(F.sort_array(F.collect_list(F.struct("component", "explained"))).alias("c"))
    each = out.join(F.broadcast(told), "dim").select("vec_id", "n", F.col("deviation").try_cast("decimal(38,0)").alias("deviation"), "identity_error", F.inline(F.arrays_zip("w", "c")))
    return each.select("vec_id", F.col("c.component").alias("component"), "n", "deviation", F.col("w").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long is null."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumn("deviation", F.col("deviation").try_cast("long"))
