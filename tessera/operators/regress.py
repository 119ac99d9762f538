"""Least squares in every group from sums of products, on any number of regressors and a set of dummies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import small


def solve(products: np.ndarray, targets: np.ndarray, tol: float = 1e-9) -> tuple[np.ndarray, int]:
    """Coefficients and rank of the normal equations, by elimination with the largest pivot left.

    A regressor of which less than tol of its own square is left, after those taken before, depends on them; it gets 0.
    """
    p = len(targets)
    a, b, own = products.astype(float).copy(), targets.astype(float).copy(), np.diag(products).astype(float).copy()
    order: list[int] = []
    while len(order) < p:
        left = [i for i in range(p) if i not in order]
        share = {i: a[i, i] / own[i] if own[i] > 0 else 0.0 for i in left}
        i = max(left, key=lambda j: (share[j], -j))
        if not share[i] > tol:
            break
        order.append(i)
        for j in left:
            if j != i:
                f = a[j, i] / a[i, i]
                a[j] -= f * a[i]
                b[j] -= f * b[i]
    out = np.zeros(p)
    for i in reversed(order):
        out[i] = (b[i] - sum(a[i, j] * out[j] for j in order if out[j] and j != i)) / a[i, i]
    return out, len(order)


def solved(batches, p: int):
    """b0.. and rank for rows of xx0.. (upper triangle by rows) and xy0.. ."""
    upper = np.triu_indices(p)
    for batch in batches:
        xx = np.column_stack([batch.column(f"_xx{k}").to_numpy(zero_copy_only=False) for k in range(len(upper[0]))])
        xy = np.column_stack([batch.column(f"_xy{k}").to_numpy(zero_copy_only=False) for k in range(p)])
        m = np.zeros((len(xx), p, p))
        m[:, upper[0], upper[1]] = xx
        m[:, upper[1], upper[0]] = xx
        found = [solve(a, b) for a, b in zip(m, xy, strict=True)]
        keep = [n for n in batch.schema.names if not n.startswith("_x")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in keep), pa.array([b.tolist() for b, _ in found], pa.list_(pa.float64())), pa.array([r for _, r in found], pa.int32())], [*keep, "coefficients", "rank"])


def usable(df: DataFrame, by: str, y: str, xs: list[str], dummies: str | None) -> DataFrame:
    """Rows of which nothing is null, with _y and _x0.. as deviations from the mean of their group and dummy."""
    cols = {"_y": y, **{f"_x{i}": x for i, x in enumerate(xs)}}
    keys = [by, *([dummies] if dummies else [])]
    x = df.where(" and ".join(f"`{c}` is not null" for c in [*keys, y, *xs]))
    means = x.groupBy(*keys).agg(*(F.avg(F.col(c).cast("double")).alias(f"{n}_mean") for n, c in cols.items()))  # sums by task first, so that a large group is no burden
    return x.join(means, keys).withColumns({n: F.col(c).cast("double") - F.col(f"{n}_mean") for n, c in cols.items()}).drop(*(f"{n}_mean" for n in cols))


def grouped_ols(df: DataFrame, by: str, y: str, xs: list[str], dummies: str | None = None) -> DataFrame:
    """by, n, coefficients (an entry for each of xs, 0 for one that depends on the others), rank: y on xs, within each by.

    The constant, and a dummy for each value of `dummies`, are taken out beforehand by means; rows with a null don't count.
    Only sums of products are sent: an answer's equations are a row.
    """
    x = usable(df, by, y, xs, dummies)
    p = len(xs)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_xx{k}") for k, (i, j) in enumerate(pairs)] + [F.sum(F.col(f"_x{i}") * F.col("_y")).alias(f"_xy{i}") for i in range(p)]
    totals = x.groupBy(by).agg(F.count("*").alias("n"), *sums)
    kind = df.schema[by].dataType.simpleString()
    return totals.mapInArrow(lambda batches: solved(batches, p), f"`{by}` {kind}, n long, coefficients array<double>, rank int")


def residuals(df: DataFrame, by: str, y: str, xs: list[str], out: str, dummies: str | None = None, least: int = 0) -> DataFrame:
    """Rows of which nothing is null, in groups of at least so many, with what xs and dummies leave of y."""
    fits = grouped_ols(df, by, y, xs, dummies).where(F.col("n") >= least)
    x = usable(df, by, y, xs, dummies).join(small(fits.select(by, "coefficients")), by)
    fitted = sum((F.col(f"_x{i}") * F.get("coefficients", F.lit(i)) for i in range(len(xs))), F.lit(0.0))
    return x.withColumn(out, F.col("_y") - fitted).drop("coefficients", "_y", *(f"_x{i}" for i in range(len(xs))))


def standardised(df: DataFrame, by: str, xs: list[str]) -> DataFrame:
    """xs as z-scores within by; null where they don't vary."""
    stats = df.groupBy(by).agg(*(f(c).alias(f"_{k}_{c}") for c in xs for k, f in (("m", F.avg), ("s", F.stddev_pop))))
    return df.join(stats, by).withColumns({c: F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in xs}).drop(*(f"_{k}_{c}" for c in xs for k in "ms"))
