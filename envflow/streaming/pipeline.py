"""Streams: source -> normalise -> partitioned append sink, with the same functions as in batch."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

Step = Callable[[DataFrame], DataFrame]


def file_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None, **options: str) -> DataFrame:
    """A stream of the files of a folder, so many in a micro-batch at most."""
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
    return reader.load(path)


def kafka_options(servers: str, topic: str, offsets_per_batch: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false"}
    return options | ({"maxOffsetsPerTrigger": str(offsets_per_batch)} if offsets_per_batch else {})


def kafka_source(spark: SparkSession, servers: str, topic: str, offsets_per_batch: int | None = None) -> DataFrame:
    """A topic from its beginning; lost offsets don't end the stream. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, offsets_per_batch)).load()


def parse_messages(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages (key, value in bytes) as columns of schema. Malformed ones stay, as nulls and in _corrupt_record."""
    with_bad = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.select(F.col("key").cast("string").alias("message_key"), parsed.alias("data")).select("message_key", "data.*")


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """(key, value) for a topic: the key's text and all columns as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def time_parts(time: str, *parts: str) -> Step:
    """Adds the partition columns (of year, month, day, hour) of a time, and when it was processed."""
    units = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}
    return lambda df: df.withColumns({p: units[p](F.col(time)) for p in parts} | {"spark_processed_at": F.current_timestamp()})


def unique_within(key: str, time: str, delay: str) -> Step:
    """Drops events whose key has been seen within delay. Rows without a time are kept: set them aside before."""
    return lambda df: df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def unique(key: str) -> Step:
    """Drops events whose key has been seen, however late they come: for backfills, whose files are in no order of time.

    Nothing is dropped for its time. The state holds every key, so run it with a state store that is on disk.
    """
    return lambda df: df.dropDuplicates([key])


def split_bad(df: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad rows have no time or could not be parsed; they go to a folder of their own, not among the good."""
    bad = F.col(time).isNull()
    bad = bad | F.col("_corrupt_record").isNotNull() if "_corrupt_record" in df.columns else bad
    good = df.where(~bad)
    return (good.drop("_corrupt_record") if "_corrupt_record" in df.columns else good), df.where(bad)


def append(df: DataFrame, path: str, checkpoint: str, parts: Sequence[str], name: str | None = None, seconds: int | None = None) -> StreamingQuery:
    """Starts appending df to a partitioned Parquet table: every so many seconds, or once over what is there now."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy(*parts) if parts else writer
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def run(source: DataFrame, steps: Sequence[Step], path: str, checkpoint: str, parts: Sequence[str], **options) -> StreamingQuery:
    for step in steps:
        source = step(source)
    return append(source, path, checkpoint, parts, **options)


def batch_folders(root: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each micro-batch's rows in a folder of their own, below root. A batch that runs again writes its folder again; others stay."""
    return lambda rows, batch: rows.write.mode("overwrite").parquet(f"{root}/batch={batch}")


def complete_windows(spark: SparkSession, windows: DataFrame, root: str) -> DataFrame:
    """All windows of an aggregate over what there is of a stream, those that are still open too; none is held by the driver.

    Each batch writes all windows to its own folder, and the last one is read: a failure while it is written leaves the one before. For results that
    end, see closed_windows.
    """
    query = windows.writeStream.foreachBatch(batch_folders(f"{root}/data")).outputMode("complete").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    last = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=None)
    return spark.read.schema(windows.schema).parquet(f"{root}/data/batch={last}") if last is not None else spark.createDataFrame([], windows.schema)


def closed_windows(stream: DataFrame, time: str, delay: str, window: Column, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates by window and keys, in append mode: each window once, when the newest time is delay past its end. Then its state goes.

    Rows later than that are not in any window: set them aside with set_late_aside before. window is F.window or F.session_window on the time.
    """
    return stream.withWatermark(time, delay).groupBy(window.alias("window"), *keys).agg(*aggregates)


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time_left: str, time_right: str, before: str, delay: str) -> DataFrame:
    """Pairs of rows of two streams with equal keys whose right time is at most before earlier than the left one, or equal to it.

    Both sides have a watermark of delay, so a row is kept only as long as a row of the other side can still meet it. Columns other than
    keys have different names; before and delay are intervals such as 6 hours.
    """
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys}).withWatermark(time_right, delay)
    met = F.expr(f"`{time_right}` >= `{time_left}` - INTERVAL {before} AND `{time_right}` <= `{time_left}`")
    for k in keys:
        met = met & (F.col(k) == F.col(f"__{k}"))
    return left.withWatermark(time_left, delay).join(right, met).drop(*(f"__{k}" for k in keys))


def set_late_aside(stream: DataFrame, time: str, delay: timedelta, root: str) -> StreamingQuery:
    """Starts to write a stream's rows to root/on_time or root/late, each batch to a folder of its own, over what is there now.

    A row is late if it is more than delay older than the newest row of earlier batches, which is when a watermark of that delay has passed it and Spark would
    drop it without a word. Each batch's newest time is kept beside its rows, so a batch that runs again decides as it did. Rows without a time are late.
    """
    spark = stream.sparkSession

    def one(rows: DataFrame, batch: int) -> None:
        newest = spark.read.schema("batch BIGINT, newest BIGINT").parquet(f"{root}/newest").where(F.col("batch") < batch).agg(F.max("newest")).first()[0] if batch else None
        at = F.unix_micros(F.col(time).cast("timestamp"))
        on_time = at.isNotNull() if newest is None else at.isNotNull() & (at >= newest - delay // timedelta(microseconds=1))
        rows = rows.persist()
        try:
            batch_folders(f"{root}/on_time")(rows.where(on_time), batch)
            batch_folders(f"{root}/late")(rows.where(~on_time), batch)
            rows.agg(F.lit(batch).cast("bigint").alias("batch"), F.max(at).alias("newest")).write.mode("overwrite").parquet(f"{root}/newest/of={batch}")
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()


def compact(spark: SparkSession, path: str, to: str, parts: Sequence[str], mb: int = 256) -> None:
    """Rewrites a partitioned table of many small files: each partition's rows together, in files of about mb megabytes.

    How many rows that is follows from the table itself: its files' bytes over its rows.
    """
    table = spark.read.parquet(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    width = max(1.0, (files.agg(F.sum("length")).first()[0] or 0) / max(1, table.count()))
    rows = max(1, int(mb * 2**20 / width))
    table.hint("rebalance", *map(F.col, parts)).sortWithinPartitions(*parts).write.option("maxRecordsPerFile", rows).partitionBy(*parts).parquet(to)


def end_offsets(progress: dict | None) -> int:
    """The messages up to the end offsets of all topics and partitions that a query's progress tells."""
    total = 0
    for source in (progress or {}).get("sources", []):
        end = source.get("endOffset")
        end = json.loads(end) if isinstance(end, str) else end
        if isinstance(end, dict):
            total += sum(n for parts in end.values() if isinstance(parts, dict) for n in parts.values())
    return total
