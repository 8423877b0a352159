"""Projections, filters, sorting, limits, set operations and deduplication."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def rename_first(df: DataFrame, names: dict[str, Sequence[str]]) -> DataFrame:
    """Each new name is given to the first of its candidates that is there."""
    found = {old: new for new, candidates in names.items() if (old := first_present(df, candidates)) and new not in df.columns}
    return df.withColumnsRenamed(found)


def keep_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    return df.select(*(c for c in wanted if c in df.columns))


def is_one_of(c: Column, values: Iterable[str]) -> Column:
    """Case-insensitive membership; false for null."""
    return F.coalesce(F.lower(c).isin(*values), F.lit(False))


def matches(c: Column, pattern: str) -> Column:
    """Regular expression anywhere in the text, case-insensitive also beyond ASCII; false for null."""
    return F.coalesce(c.rlike(f"(?iu){pattern}"), F.lit(False))


def time_range(df: DataFrame, time: str, start: str, end: str, parts: Sequence[str] = ()) -> DataFrame:
    """Rows with time in [start, end]. parts (of year, month, day, hour): partition columns, which are pruned too."""
    t0, t1 = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    df = df.where(F.col(time).between(t0, t1))
    if parts:
        units = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
        least, most = (F.struct(*(units[p](t).alias(p) for p in parts)) for t in (t0, t1))
        here = F.struct(*(F.col(p).cast("int").alias(p) for p in parts))
        df = df.where(here.between(least, most)).where(F.col(parts[0]).between(units[parts[0]](t0), units[parts[0]](t1)))
    return df


def sort_by(df: DataFrame, *keys: str, nulls_last: bool = True) -> DataFrame:
    return df.orderBy(*(F.col(k).asc_nulls_last() if nulls_last else F.col(k).asc_nulls_first() for k in keys))


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of an order (all rows for n = 0); a heap in each task, not a global sort."""
    return df.orderBy(*order).limit(n) if n else df.orderBy(*order)


def top_per_group(df: DataFrame, groups: Sequence[str], n: int, *order: Column) -> DataFrame:
    """The first n rows of each group. Spark drops what can't be among them before the shuffle."""
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= n).drop("_place")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the largest order of each key, as a partial aggregate: a hot key is no window."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Deduplication that keeps the first row of each key in an order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *(F.col("_row")[c].alias(c) for c in rest)).select(*df.columns)


def latest_group(df: DataFrame, group: str) -> DataFrame:
    """The rows of the largest group."""
    last = df.agg(F.max(group).alias("_last"))  # one row
    return df.join(F.broadcast(last), F.col(group) == F.col("_last"), "left_semi")


def until_n_successes(df: DataFrame, success: Column, order: str, n: int) -> DataFrame:
    """Rows in order up to the n-th success: what a loop would have worked on that stops once it has n.

    order has no ties. The n-th success is found by a top-n, not by a running count over all rows.
    """
    if n <= 0:
        return df.limit(0)
    nth = df.where(success).select(order).orderBy(order).limit(n).agg(F.count("*").alias("_n"), F.max(order).alias("_last"))
    return df.join(F.broadcast(nth), (F.col("_n") < n) | (F.col(order) <= F.col("_last")), "left_semi")


def union_tagged(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL by name, each row with its part's name."""
    return reduce(DataFrame.unionByName, (df.withColumn(tag, F.lit(name)) for name, df in parts.items()))


def or_else(first: DataFrame, second: DataFrame) -> DataFrame:
    """first, or second where first has no row."""
    some = first.select(F.lit(1).alias("_some")).limit(1)
    return first.unionByName(second.join(F.broadcast(some), F.lit(True), "left_anti"))
