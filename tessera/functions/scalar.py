"""Column helpers with the null rules of the analytics they serve."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_divide(a, b) -> Column:
    """a / b, null where b is 0 or either is null."""
    return F.try_divide(a, b)


def safe_corr(a: str, b: str) -> Column:
    """Correlation, null where either is constant or there are fewer than two rows."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def strict_greatest(*cols) -> Column:
    """The greatest, null if any is null."""
    known = reduce(lambda x, y: x & y, (F.col(c).isNotNull() if isinstance(c, str) else c.isNotNull() for c in cols))
    return F.when(known, F.greatest(*cols))


def strict_least(*cols) -> Column:
    known = reduce(lambda x, y: x & y, (F.col(c).isNotNull() if isinstance(c, str) else c.isNotNull() for c in cols))
    return F.when(known, F.least(*cols))


def parse_yyyymmdd(c) -> Column:
    """A date, null where the text is none."""
    return F.try_to_date(c, F.lit("yyyyMMdd")) if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(c, F.lit("yyyyMMdd")))


def log_positive(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c > 0, F.log(c))


def rounded(df, digits: int = 4):
    """Doubles rounded, so that another engine's order of summation doesn't show."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def required(c, ok) -> Column:
    """True where ok holds; unknown counts as not met."""
    return F.col(c).isNotNull() & F.coalesce(ok, F.lit(False)) if isinstance(c, str) else c.isNotNull() & F.coalesce(ok, F.lit(False))


def gross_from_returns(r) -> Column:
    """An aggregate: the product of 1 + r; null if any factor isn't positive or there is none."""
    factor = 1 + (F.col(r) if isinstance(r, str) else r)
    return F.when(F.min(factor) > 0, F.exp(F.sum(F.log(F.when(factor > 0, factor)))))


def compound_annual(gross, periods, per_year: float = 252.0) -> Column:
    g = F.col(gross) if isinstance(gross, str) else gross
    return F.when(g > 0, F.pow(g, safe_divide(F.lit(per_year), periods)) - 1)


def zero_safe_ratio(a, b) -> Column:
    """a / b; where b is 0, infinity with the sign of a, or null for 0 / 0."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b != 0, safe_divide(a, b)).when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf")))
