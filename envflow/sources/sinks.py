"""Sinks for batches; streams are appended by streaming.pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, parts: Sequence[str] = (), mode: str = "append") -> None:
    """Rows of a partition are brought together first; adaptive execution splits large partitions and joins small ones."""
    out = df.hint("rebalance", *map(F.col, parts)) if parts else df
    out.write.mode(mode).partitionBy(*parts).parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV of exactly these columns, in order; missing ones are empty."""
    df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns)).write.option("header", True).csv(path)


def write_json(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    """JSON lines, text beyond ASCII as it is."""
    df.write.partitionBy(*parts).json(path)


def write_documents(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """A JSON array of each key's rows, as one line of one file below its key's folders. For keys of bounded size, such as a place's day."""
    rest = F.struct(*(c for c in df.columns if c not in keys))
    text = df.groupBy(*keys).agg(F.to_json(F.sort_array(F.collect_list(rest))).alias("value"))
    text.repartition(*keys).write.partitionBy(*keys).text(path)


def write_csv_with_mark(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV of these columns whose files begin with a byte-order mark, for spreadsheets that ask for one."""
    df.select(*(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns)).toDF(*(f"\ufeff{c}" if not i else c for i, c in enumerate(columns))).write.option("header", True).option("encoding", "UTF-8").csv(path)


def write_features(df: DataFrame, path: str, geometry: str) -> None:
    """GeoJSON features, one a line; geometry is JSON text and all other columns are properties."""
    rest = F.to_json(F.struct(*(c for c in df.columns if c != geometry)))
    text = F.concat(F.lit('{"type":"Feature","properties":'), rest, F.lit(',"geometry":'), F.coalesce(F.col(geometry), F.lit("null")), F.lit("}"))
    df.select(text.alias("value")).write.text(path)


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all", "kafka.retries": "3"}


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Messages (key, value), acknowledged by all replicas. Needs the Kafka connector on the class path."""
    df.select("key", "value").write.format("kafka").options(**kafka_options(servers, topic)).save()
