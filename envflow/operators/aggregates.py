"""Aggregations, counters and reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from envflow.functions import finite
from envflow.shared import written


def exact_sum(c: Column) -> Column:
    """A sum that doesn't depend on the order of rows."""
    return F.sum(c.cast("decimal(28,6)")).cast("double")


def exact_mean(c: Column) -> Column:
    return F.round(exact_sum(c) / F.count(c), 6)


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Counts of the groups whose keys are all there, largest first."""
    there = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    return there.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.col(name).desc(), *keys)


def summary(df: DataFrame, key: str, time: str) -> DataFrame:
    """One row: rows, distinct keys, first and last time."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def hourly(df: DataFrame, time: str, key: str, value: str) -> DataFrame:
    """Counts, extremes and means by hour and key."""
    t = F.col(time)
    return df.groupBy(F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour"), key).agg(
        F.count("*").alias("n"), F.min(value).alias("min_value"), F.max(value).alias("max_value"), exact_mean(F.col(value)).alias("mean_value")
    )


def file_stats(files: DataFrame) -> DataFrame:
    """Of files (path, length, modificationTime): how many .parquet files, their bytes, and the latest change."""
    data = files.where(F.col("path").endswith(".parquet"))
    return data.agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max("modificationTime").alias("latest"))


def healthy(files: Column, live_nodes: Column) -> Column:
    return (F.coalesce(files, F.lit(0)) > 0) & (F.coalesce(live_nodes, F.lit(0)) > 0)


#: Values of a group that one task puts in order for a percentile, about, and the most buckets of a sketch.
MIDDLE, FINEST = 1_000_000, 1_000_000


def percentile_by(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str = "percentile", buckets: int = 1000) -> DataFrame:
    """(keys, name): the interpolated q-th percentile of each group's valid values, null where there are none; exact.

    A sketch, whose ranks are off by one in buckets at most as a rule, gives a value below the wanted ranks and one above them.
    What lies below is counted, what lies between is put in order, a common value as one row. So of a group of more than
    buckets values only 8 in buckets are in one task, and there are more buckets where the largest group is larger, so that MIDDLE values
    are about the most; smaller groups are there whole. Groups whose ranks a sketch has missed are done again with a finer one.
    """
    rows = df.select(*keys, F.when(finite(F.col(value)), F.col(value).cast("double")).alias("_v"))
    most = rows.groupBy(*keys).agg(F.count("_v").alias("_n")).agg(F.max("_n")).first()[0] or 0
    buckets = max(buckets, min(FINEST, 8 * most // MIDDLE))
    margin = 4 / buckets
    ends = F.percentile_approx("_v", F.array(F.lit(max(0.0, q - margin)), F.lit(min(1.0, q + margin))), F.lit(min(buckets, FINEST)))
    cuts = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"), ends.alias("_ends"))
    few, at = F.col("_n") <= buckets, F.when(F.col("_n") > 0, F.lit(q) * (F.col("_n") - 1))
    low = F.when(few | F.lit(q <= margin), F.col("_min")).otherwise(F.col("_ends")[0])
    high = F.when(few | F.lit(q >= 1 - margin), F.col("_max")).otherwise(F.col("_ends")[1])
    cuts = cuts.select(*(F.col(k).alias(f"_r_{k}") for k in keys), low.alias("_low"), high.alias("_high"), at.alias("_at"))
    met = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys), F.lit(True))
    near = rows.join(cuts, met).where(F.col("_v").isNull() | (F.col("_v") <= F.col("_high")))
    counts = near.groupBy(*keys, "_at", F.when(F.col("_v") >= F.col("_low"), F.col("_v")).alias("_v")).agg(F.count(F.col("_v")).alias("_c"))
    start = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first())) - F.col("_c")
    holds = lambda rank: (F.col("_start") <= rank) & (rank < F.col("_start") + F.col("_c"))
    found = lambda rank: F.max(F.when(holds(rank(F.col("_at"))), F.col("_v")))
    out = counts.withColumn("_start", start).groupBy(*keys, "_at").agg(found(F.floor).alias("_lo"), found(F.ceil).alias("_hi"))
    exact = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_at") - F.floor("_at"))
    out = written(out.select(*keys, exact.alias(name), (F.col("_at").isNotNull() & exact.isNull()).alias("_missed")), "percentile")
    missed = out.where("_missed").select(*(F.col(k).alias(f"_m_{k}") for k in keys))
    if not missed.limit(1).count():
        return out.drop("_missed")
    same = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys), F.lit(True))
    again = percentile_by(df.join(missed, same, "left_semi"), keys, value, q, name, buckets * 10 if buckets < FINEST else 2**31 - 1)
    return out.where("NOT _missed").drop("_missed").unionByName(again)


def exact_percentile(df: DataFrame, keys: Sequence[str], value: str, q: float, name: str = "percentile", buckets: int = 1000) -> DataFrame:
    """percentile_by; groups without a valid value have no row."""
    return percentile_by(df, keys, value, q, name, buckets).where(F.col(name).isNotNull())
