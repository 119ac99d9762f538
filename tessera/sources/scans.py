"""What a plan would read, known before it runs: scans with their filters, refused where they are forbidden or unpruned."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


class ForbiddenScan(RuntimeError):
    """A plan reads what it must not, or reads a partitioned source without a filter on its partitions."""


@dataclass(frozen=True)
class Scan:
    """A scan of files: where, the columns read, the columns it is partitioned by, and the filters that reach it."""

    paths: tuple[str, ...]
    columns: tuple[str, ...]
    partitioned_by: tuple[str, ...]
    partition_filters: tuple[str, ...]
    data_filters: tuple[str, ...]


def _seq(x) -> list:
    return [x.apply(i) for i in range(x.size())]


def _nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.initialPlan())
        return
    yield name, plan
    for child in _seq(plan.children()) + _seq(plan.subqueries().toSeq()):
        yield from _nodes(child)
    if name == "InMemoryTableScanExec":
        yield from _nodes(plan.relation().cachedPlan())


def scans(df: DataFrame) -> list[Scan]:
    """The file scans of a plan, those of subqueries and of cached tables too; nothing is run."""
    out = []
    for name, plan in _nodes(df._jdf.queryExecution().executedPlan()):
        if name == "FileSourceScanExec":
            r = plan.relation()
            kept = [f.sql() for f in _seq(plan.partitionFilters())]
            data = [f.sql() for f in _seq(plan.dataFilters())]
            out.append(Scan(tuple(p.toString() for p in _seq(r.location().rootPaths().toSeq())), tuple(plan.requiredSchema().fieldNames()), tuple(r.partitionSchema().fieldNames()), tuple(kept), tuple(data)))
    return out


def _limits(filters: tuple[str, ...], columns: tuple[str, ...]) -> bool:
    """Whether a filter says more of a partition column than that it isn't null."""
    return any(c in f for f in filters for c in columns if not f.strip("()").upper().endswith("IS NOT NULL"))


def guarded(df: DataFrame, forbidden: tuple[str, ...] = (), columns_at_most: int | None = None) -> DataFrame:
    """df, unless its plan reads under a forbidden folder, or a partitioned source without a filter on its partitions, or
    more columns of one source than so many; then it raises before anything is read.
    """
    for s in scans(df):
        for p in s.paths:
            if any(p.rstrip("/") == f.rstrip("/") or p.startswith(f.rstrip("/") + "/") for f in forbidden):
                raise ForbiddenScan(f"{p} must not be read")
        if s.partitioned_by and not _limits(s.partition_filters, s.partitioned_by):
            raise ForbiddenScan(f"{s.paths[:1]} is read without a filter on {s.partitioned_by}")
        if columns_at_most is not None and len(s.columns) > columns_at_most:
            raise ForbiddenScan(f"{len(s.columns)} columns of {s.paths[:1]} are read")
    return df
