"""Streams equal batches; restarts and bad rows."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from envflow.plans import stream_queries as Q
from envflow.streaming import pipeline as P

SCHEMA = "id BIGINT, time STRING, value DOUBLE"


def messages(spark, path, rows):
    spark.createDataFrame([(bytearray(str(i), "utf8"), bytearray(v, "utf8")) for i, v in enumerate(rows)], "key binary, value binary").write.mode("append").parquet(path)


def test_messages_to_table_and_restart(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(SCHEMA)
    source, out, bad_out, mark = (f"{tmp_path}/{x}" for x in ("in", "out", "bad", "mark"))
    kind = T.StructType.fromDDL("key BINARY, value BINARY")

    def start():
        events = P.parse_messages(P.file_source(spark, source, kind), schema).withColumn("event_time", F.try_to_timestamp("time"))
        good, bad = P.split_bad(events, "event_time")
        P.run(good, [P.time_parts("event_time", "year", "month")], out, f"{mark}/good", ["year", "month"]).awaitTermination()
        P.append(bad, bad_out, f"{mark}/bad", []).awaitTermination()

    messages(spark, source, [json.dumps({"id": 1, "time": "2025-01-02 00:00:00", "value": 3}), "{bad", json.dumps({"id": 2, "time": "nan"})])
    start()
    assert [tuple(r) for r in spark.read.parquet(out).select("id", "value", "year", "month").collect()] == [(1, 3.0, 2025, 1)]
    assert spark.read.parquet(bad_out).count() == 2
    messages(spark, source, [json.dumps({"id": 3, "time": "2025-02-02T00:00:00+00:00"})])
    start()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 3]
    assert spark.read.parquet(bad_out).count() == 2
    P.compact(spark, out, f"{tmp_path}/compact", ["year", "month"])
    assert spark.read.parquet(f"{tmp_path}/compact").count() == 2


def test_to_messages(spark):
    got = P.to_messages(spark.createDataFrame([(1, "Hà Nội")], "id int, place string"), "id").first()
    assert (got.key, json.loads(got.value)) == ("1", {"id": 1, "place": "Hà Nội"})


def test_end_offsets():
    assert P.end_offsets({"sources": [{"endOffset": '{"a":{"0":5,"1":7}}'}, {"endOffset": {"b": {"0": 1}}}, {"endOffset": None}]}) == 13
    assert P.end_offsets(None) == 0


def test_late_files_of_a_backfill_are_kept(spark, tmp_path, monkeypatch):
    """Several batches, the latest events first."""
    monkeypatch.setattr(Q, "FILES_PER_BATCH", 1)
    path = f"{tmp_path}/events.parquet"
    for i, day in enumerate((9, 5, 1)):
        rows = [(10 * day + j, j, "view", 1.0 * j, dt.datetime(2024, 1, day, j)) for j in range(4)] + [(90, 0, "view", 0.0, dt.datetime(2024, 1, 9, 0))]
        spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
        for f in tmp_path.glob("events.parquet/*.parquet"):
            if f.stat().st_mtime > 1_600_000_100:
                os.utime(f, (1_600_000_000 + i, 1_600_000_000 + i))
    got = sorted(r.event_id for r in Q.stream_dedup(spark, str(tmp_path)).collect())
    assert got == sorted(10 * day + j for day in (9, 5, 1) for j in range(4))


def test_windows_are_not_held_by_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Q, "FILES_PER_BATCH", 1)
    path = f"{tmp_path}/events.parquet"
    for hour in (5, 3, 5):
        rows = [(j, j, "view", 1.5, dt.datetime(2024, 1, 1, hour, j)) for j in range(4)]
        spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double, ts timestamp_ntz").coalesce(1).write.mode("append").parquet(path)
    got = Q.stream_tumbling(spark, str(tmp_path))
    assert all(f.endswith(".parquet") for f in got.inputFiles()) and got.inputFiles()
    assert sorted((r.hour_start.hour, r.n, r.total) for r in got.collect()) == [(3, 4, 6.0), (5, 8, 12.0)]


def events_of(spark, rows):
    return spark.createDataFrame([(i, u, k, 1.0, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)) for i, u, k, m in rows], "event_id bigint, user_id bigint, event_type string, value double, ts timestamp_ntz").withColumn("event_time", F.col("ts").cast("timestamp"))


def replay(spark, tmp_path, batches, start):
    """Runs of a stream over batches that come one after the other; the state rows and late rows that each run reports last."""
    told = []
    for batch in batches:
        events_of(spark, batch).write.mode("append").parquet(f"{tmp_path}/in")
        query = start(P.file_source(spark, f"{tmp_path}/in", events_of(spark, batch).schema))
        query.awaitTermination()
        operators = [o for p in query.recentProgress for o in p["stateOperators"]]
        told.append((operators[-1]["numRowsTotal"], sum(o["numRowsDroppedByWatermark"] for o in operators)) if operators else None)
    return told


def test_windows_end_and_their_state_goes(spark, tmp_path):
    batches = [[(100 * h + i, i, "view", 60 * h + i) for i in range(30)] for h in range(0, 12, 4)]
    batches.append([(9000, 1, "view", 60 * 30)])

    def start(stream):
        closed = P.closed_windows(stream, "event_time", "1 hour", F.window("event_time", "10 minutes"), ["user_id"], F.count("*").alias("n"))
        return P.append(closed.select("window.start", "user_id", "n"), f"{tmp_path}/out", f"{tmp_path}/check", [])

    told = replay(spark, tmp_path, batches, start)
    assert [n for n, _ in told] == [30, 30, 30, 1] and all(late == 0 for _, late in told)  # of each run only the open windows are left
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == 90 and got.dropDuplicates(["start", "user_id"]).count() == 90


def test_an_interval_join_forgets_what_cannot_meet(spark, tmp_path):
    batches = [[(1000 * h + i, i % 5, "view" if i % 2 else "purchase", 60 * h + i) for i in range(40)] for h in (0, 5, 10)] + [[(9000, 99, "view", 6000), (9001, 99, "purchase", 6000)]]

    def start(stream):
        left = stream.where("event_type = 'purchase'").select("event_id", "user_id", "event_time")
        right = stream.where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", F.col("event_time").alias("view_time"))
        return P.append(P.interval_join(left, right, ["user_id"], "event_time", "view_time", "20 minutes", "30 minutes").select("event_id", "view_id"), f"{tmp_path}/out", f"{tmp_path}/check", [])

    told = replay(spark, tmp_path, batches, start)
    rows = [r for b in batches for r in b]
    want = {(p[0], v[0]) for p in rows for v in rows if p[2] == "purchase" and v[2] == "view" and p[1] == v[1] and p[3] - 20 <= v[3] <= p[3]}
    got = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert len(got) == len(want) and set(got) == want and len(want) > 50
    assert told[0][0] <= 40 and told[-1][0] <= 4


def test_late_rows_are_set_aside(spark, tmp_path):
    """What a watermark would drop is in the table of late rows; a batch that runs again decides as it did."""
    batches = [[(1, 1, "v", 600), (2, 1, "v", 500)], [(3, 1, "v", 541), (4, 1, "v", 539), (5, 1, "v", 900)], [(6, 1, "v", 841), (7, 1, "v", 839), (8, 1, "v", 100)]]
    start = lambda stream: P.set_late_aside(stream, "event_time", dt.timedelta(hours=1), f"{tmp_path}/out")
    replay(spark, tmp_path, batches, start)
    ids = lambda name: sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out/{name}").collect())
    assert ids("on_time") == [1, 2, 3, 5, 6] and ids("late") == [4, 7, 8]
    for f in (tmp_path / "out/checkpoint/commits").iterdir():
        if f.name.startswith((".2", "2")):
            f.unlink()
    start(P.file_source(spark, f"{tmp_path}/in", events_of(spark, batches[0]).schema)).awaitTermination()
    assert ids("on_time") == [1, 2, 3, 5, 6] and ids("late") == [4, 7, 8]


def test_a_failed_batch_leaves_the_windows_of_the_one_before(spark, tmp_path):
    write = P.batch_folders(f"{tmp_path}/data")
    write(spark.range(3), 0)
    try:
        write(spark.range(5).select(F.raise_error(F.lit("fails")).alias("id")), 1)
    except Exception as e:  # noqa: BLE001
        assert "fails" in str(e)
    assert spark.read.parquet(f"{tmp_path}/data/batch=0").count() == 3


def test_compact_cuts_files_by_bytes(spark, tmp_path):
    wide = spark.range(400).select(F.lit(1).alias("k"), F.concat(*(F.sha2(F.concat(F.col("id"), F.lit(str(i))), 512) for i in range(64))).alias("v"))
    wide.repartition(20).write.partitionBy("k").parquet(f"{tmp_path}/many")
    P.compact(spark, f"{tmp_path}/many", f"{tmp_path}/few", ["k"], mb=1)
    sizes = [f.stat().st_size for f in tmp_path.glob("few/k=1/*.parquet")]
    assert spark.read.parquet(f"{tmp_path}/few").count() == 400 and 2 <= len(sizes) <= 6 and max(sizes) < 2 * 2**20


def test_rates_over_runs_and_state_that_goes(spark, tmp_path):
    """A counter's growth over runs; an old sample changes nothing; a key that is silent for long begins anew."""
    from envflow.operators import ordered as O

    batches = [[(1, 1, "v", 0), (2, 1, "v", 10), (3, 2, "v", 5)], [(4, 1, "v", 30), (5, 1, "v", 20), (6, 2, "v", 3)], [(7, 3, "v", 60 * 40)], [(8, 2, "v", 60 * 41), (9, 1, "v", 60 * 41)]]

    def start(stream):
        rates = O.stream_counter_rate(stream.withColumn("total", F.col("event_id") * 60.0), "user_id", "event_time", "total", "event_id", "1 hour", keep_hours=24)
        return P.append(rates.select("event_id", "rate"), f"{tmp_path}/out", f"{tmp_path}/check", [])

    told = replay(spark, tmp_path, batches, start)
    got = {r.event_id: r.rate for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: 0.0, 2: 0.1, 3: 0.0, 4: 0.0, 5: 0.3, 6: 0.0, 7: 0.0, 8: 0.0, 9: 0.0}  # 4 comes after 5 and counts less
    assert told[1][0] == 2 and told[2][0] <= 3 and told[3][0] <= 3


def test_rates_of_samples_without_a_time_and_in_any_order(spark, tmp_path):
    """A sample without a time has rate 0 and is no state, also where its key has no other; samples of one moment go by their tie."""
    from envflow.operators import ordered as O

    kind = "id bigint, k bigint, t timestamp, total double, tie string"
    at = lambda minute: dt.datetime(2024, 1, 1, 0, minute)
    rows = [(1, 1, None, 5.0, "a"), (2, 2, at(2), 300.0, "b"), (3, 2, at(1), 60.0, "a"), (4, 2, None, 1.0, "c"), (5, 2, at(2), 180.0, "a"), (6, 3, at(1), None, "a"), (7, 3, at(2), 60.0, "a"), (8, 3, at(3), 180.0, "a")]
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/in")
    rates = O.stream_counter_rate(P.file_source(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema), "k", "t", "total", "tie")
    P.append(rates, f"{tmp_path}/out", f"{tmp_path}/check", []).awaitTermination()
    got = {r.id: r.rate for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: 0.0, 2: 120000000.0, 3: 0.0, 4: 0.0, 5: 2.0, 6: 0.0, 7: 0.0, 8: 2.0}
