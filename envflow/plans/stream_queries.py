"""Queries that run as streams over the events table and read what they wrote."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow.operators.aggregates import exact_sum
from envflow.operators.ordered import running_count, stream_counter_rate
from envflow.registry import query, table
from envflow.shared import work_dir
from envflow.streaming import pipeline as P


#: Files of the events table in a micro-batch.
FILES_PER_BATCH = 1000
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream; its time is a zoned one, which watermarks ask for."""
    schema = table(spark, sf_dir, "events").schema
    stream = P.file_source(spark, f"{sf_dir}/events.parquet*", schema, files_per_batch=FILES_PER_BATCH, recursiveFileLookup="true")
    return stream.withColumn("event_time", F.col("ts").cast("timestamp"))


_PARTS = "CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month"


@query(f"SELECT event_id, user_id, event_type, value, ts, {_PARTS} FROM events")
def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream to Parquet by year and month, read back."""
    out = work_dir(spark)
    steps = [P.time_parts("event_time", "year", "month")]
    P.run(_events(spark, sf_dir), steps, f"{out}/data", f"{out}/checkpoint", ["year", "month"]).awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id", "user_id", "event_type", "value", "ts", "year", "month")


@query(f"SELECT event_id, value, {_PARTS}, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events WHERE ts >= TIMESTAMP '2024-01-03 00:00:00' AND ts <= TIMESTAMP '2024-01-04 11:59:59'")
def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by year, month, day and hour; a time range reads its partitions only."""
    from envflow.operators.tables import time_range

    out, parts = work_dir(spark), ["year", "month", "day", "hour"]
    rows = P.time_parts("ts", *parts)(table(spark, sf_dir, "events"))
    rows.repartition("year", "month", "day").write.partitionBy(*parts).parquet(out)
    return time_range(spark.read.parquet(out), "ts", "2024-01-03 00:00:00", "2024-01-04 11:59:59", parts).select("event_id", "value", *parts)


@query("SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is sent twice; one of each key is stored, whatever the order of the files."""
    out, stream = work_dir(spark), _events(spark, sf_dir)
    twice = stream.select("event_id", "user_id", "event_type", "event_time", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    store = spark.conf.get(_STORE)
    spark.conf.set(_STORE, _ON_DISK)
    try:
        run = P.run(twice, [P.unique("event_id")], f"{out}/data", f"{out}/checkpoint", [])
    finally:
        spark.conf.set(_STORE, store)
    run.awaitTermination()
    return spark.read.parquet(f"{out}/data").select("event_id", "user_id", "event_type")


def _complete(spark: SparkSession, windows: DataFrame) -> DataFrame:
    return P.complete_windows(spark, windows, work_dir(spark))


_TOTAL = "CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) AS total"


@query(f"""SELECT date_trunc('hour', ts) AS hour_start, event_type, count(*) AS n, {_TOTAL} FROM events GROUP BY ALL""")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows in complete mode."""
    windows = _events(spark, sf_dir).groupBy(F.window("event_time", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))
    return _complete(spark, windows.select(F.col("w.start").cast("timestamp_ntz").alias("hour_start"), "event_type", "n", "total"))


@query(f"""SELECT s AS window_start, event_type, count(*) AS n, {_TOTAL}
FROM (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM events) GROUP BY ALL""")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of an hour that begin every half hour."""
    windows = _events(spark, sf_dir).groupBy(F.window("event_time", "1 hour", "30 minutes").alias("w"), "event_type").agg(F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))
    return _complete(spark, windows.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total"))


@query("""WITH o AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER w > INTERVAL 2 HOUR, TRUE) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, sum(CAST(new AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each user: events no more than two hours apart."""
    windows = _events(spark, sf_dir).groupBy(F.session_window("event_time", "2 hours").alias("w"), "user_id").agg(F.count("*").alias("n"))
    return _complete(spark, windows.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), "n"))


@query("SELECT CAST(day(ts) AS INTEGER) AS day, CAST(1 AS BIGINT) AS files, TRUE AS has_bytes FROM events GROUP BY 1")
def table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a table that is written by day, a file for each: found by a listing, counted by folder and with their bytes."""
    from envflow.sources.files import list_files

    out = work_dir(spark)
    P.time_parts("ts", "day")(table(spark, sf_dir, "events")).repartition("day").write.partitionBy("day").parquet(out)
    files = list_files(spark, out, "*.parquet").withColumn("day", F.regexp_extract("path", "/day=([0-9]+)/", 1).cast("int"))
    return files.groupBy("day").agg(F.count("*").alias("files"), (F.sum("length") > 0).alias("has_bytes"))


def _chunks(events: DataFrame, n: int) -> list[DataFrame]:
    """events in n parts in order of time, of about as many rows each: what n runs of an hourly job would find."""
    at = F.unix_micros("event_time")
    cuts = events.agg(F.percentile_approx(at, [i / n for i in range(1, n)], 1000)).first()[0] or []
    bounds = [None, *sorted(set(cuts)), None]
    return [events.where(" AND ".join([f"unix_micros(event_time) >= {a}"] * (a is not None) + [f"unix_micros(event_time) < {b}"] * (b is not None)) or "true") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _replayed(spark: SparkSession, parts: list[DataFrame], start) -> None:
    """Each part is added to a folder, and a run of the stream start(folder) takes it; a run goes on where the last one ended."""
    folder = work_dir(spark)
    for part in parts:
        part.write.mode("append").parquet(folder)
        start(P.file_source(spark, folder, part.schema)).awaitTermination()


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("event_time", F.col("ts").cast("timestamp"))


#: Runs in which the events come, and how late a row may be.
RUNS, DELAY = 3, "1 hour"
_PASSED = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events)"


@query(f"""SELECT date_trunc('hour', ts) AS hour_start, event_type, count(*) AS n, {_TOTAL} FROM events GROUP BY date_trunc('hour', ts), event_type HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_PASSED}""")
def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows in append mode over events in order: each is written once, when the newest event is an hour past its end."""
    out = work_dir(spark)

    def start(stream: DataFrame):
        closed = P.closed_windows(stream, "event_time", DELAY, F.window("event_time", "1 hour"), ["event_type"], F.count("*").alias("n"), exact_sum(F.col("value")).alias("total"))
        return P.append(closed.select(F.col("window.start").cast("timestamp_ntz").alias("hour_start"), "event_type", "n", "total"), f"{out}/data", f"{out}/checkpoint", [])

    _replayed(spark, _chunks(_timed(spark, sf_dir), RUNS), start)
    return spark.read.parquet(f"{out}/data")


@query(f"""WITH o AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER w > INTERVAL 2 HOUR, TRUE) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, sum(CAST(new AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM o)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 2 HOUR <= {_PASSED}""")
def stream_closed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions in append mode: each is written once, when no event can prolong it any more."""
    out = work_dir(spark)

    def start(stream: DataFrame):
        closed = P.closed_windows(stream, "event_time", DELAY, F.session_window("event_time", "2 hours"), ["user_id"], F.count("*").alias("n"))
        return P.append(closed.select("user_id", F.col("window.start").cast("timestamp_ntz").alias("session_start"), F.col("window.end").cast("timestamp_ntz").alias("session_end"), "n"), f"{out}/data", f"{out}/checkpoint", [])

    _replayed(spark, _chunks(_timed(spark, sf_dir), RUNS), start)
    return spark.read.parquet(f"{out}/data")


@query("""SELECT p.event_id, v.event_id AS view_id, p.user_id FROM events p JOIN events v ON p.user_id = v.user_id AND v.ts BETWEEN p.ts - INTERVAL 6 HOUR AND p.ts WHERE p.event_type = 'purchase' AND v.event_type = 'view'""")
def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the user's views of the six hours before, as a join of two streams that forget what can't meet any more."""
    out = work_dir(spark)

    def start(stream: DataFrame):
        bought = stream.where("event_type = 'purchase'").select("event_id", "user_id", "event_time")
        seen = stream.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("event_time").alias("view_time"))
        pairs = P.interval_join(bought, seen, ["user_id"], "event_time", "view_time", "6 hours", DELAY)
        return P.append(pairs.select("event_id", "view_id", "user_id"), f"{out}/data", f"{out}/checkpoint", [])

    _replayed(spark, _chunks(_timed(spark, sf_dir), RUNS), start)
    return spark.read.parquet(f"{out}/data")


@query("""WITH c AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM events),
d AS (SELECT *, lag(total) OVER w AS pt, lag(ts) OVER w AS pts FROM c WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, round(coalesce(greatest((total - pt) / greatest(epoch_us(ts) / 1e6 - epoch_us(pts) / 1e6, 1e-6), 0.0), 0.0), 3) AS rate FROM d""")
def stream_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of a counter by user over events in order, in several runs: a user's last sample is carried from run to run as state."""
    out = work_dir(spark)
    events = running_count(_timed(spark, sf_dir).select("event_id", "user_id", "ts", "event_time"), ["user_id"], ["ts", "event_id"], "total")

    def start(stream: DataFrame):
        rates = stream_counter_rate(stream, "user_id", "event_time", "total", "event_id", DELAY, keep_hours=24 * 365)
        return P.append(rates.select("event_id", "user_id", "rate"), f"{out}/data", f"{out}/checkpoint", [])

    _replayed(spark, _chunks(events, RUNS), start)
    return spark.read.parquet(f"{out}/data")


@query("""WITH b AS (SELECT r, max(m) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 DAY AS bound FROM (SELECT event_id % 3 AS r, max(ts) AS m FROM events GROUP BY 1))
SELECT event_id, coalesce(ts < bound, FALSE) AS late FROM events JOIN b ON event_id % 3 = r""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that come in three runs, in no order of time: those more than ten days older than what came in earlier runs are set aside."""
    out, events = work_dir(spark), _timed(spark, sf_dir)
    _replayed(spark, [events.where(F.col("event_id") % 3 == i) for i in range(3)], lambda stream: P.set_late_aside(stream, "event_time", timedelta(days=10), out))
    parts = [spark.read.schema(events.schema).parquet(f"{out}/{name}").select("event_id", F.lit(name == "late").alias("late")) for name in ("on_time", "late")]
    return parts[0].unionByName(parts[1])
