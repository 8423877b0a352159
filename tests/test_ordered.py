"""What came before a row of its key: against brute force, with keys that span ranges, and how they are dealt out."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from envflow.operators import ordered as O

START = datetime(2024, 1, 1)


def conf(spark, **settings):
    before = {k.replace("__", "."): spark.conf.get(k.replace("__", ".")) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k.replace("__", "."), v)
    return before


@pytest.fixture(params=[("1", "10000"), ("3", "7"), ("24", "5")])
def dealt(spark, request):
    """So many ranges, and Arrow batches of so many rows."""
    parts, batch = request.param
    before = conf(spark, spark__sql__shuffle__partitions=parts, spark__sql__execution__arrow__maxRecordsPerBatch=batch, spark__sql__adaptive__coalescePartitions__enabled="false")
    yield int(parts)
    for k, v in before.items():
        spark.conf.set(k, v)


def events(seed, n=400):
    """A third of the rows has one key; keys and times may be null, times may be equal."""
    rng = random.Random(seed)
    return [(i, rng.choice([7] * 3 + [1, 2, 3, None, *range(100, 130)]), None if rng.random() < 0.03 else START + timedelta(seconds=rng.randrange(300)), rng.choice("abc"), rng.choice([None, 1.5, 2.0])) for i in range(n)]


SCHEMA = "id bigint, k int, ts timestamp, kind string, v double"


def order(e):
    return (e[2] is not None, e[2] or START, e[0])


@pytest.mark.parametrize("inclusive", [False, True])
def test_look_back(spark, dealt, inclusive):
    rows = events(1)
    got = {r.id: (r.before_id, r.before_v, r.before_ts) for r in O.look_back(spark.createDataFrame(rows, SCHEMA).repartition(3), ["k"], ["ts", "id"], ["id", "v", "ts"], F.col("kind") == "a", inclusive).collect()}
    for e in rows:
        earlier = [x for x in rows if x[1] == e[1] and x[3] == "a" and (order(x) < order(e) or inclusive and x is e)]
        best = max(earlier, key=order, default=None)
        assert got[e[0]] == ((best[0], best[4], best[2]) if best else (None, None, None))
    assert len(got) == len(rows)


def test_asof_join(spark, dealt):
    rows = events(2)
    left = spark.createDataFrame([e for e in rows if e[3] != "a"], SCHEMA).select("id", "k", "ts")
    right = spark.createDataFrame([e for e in rows if e[3] == "a"], SCHEMA).select("k", F.col("id").alias("a_id"), F.col("ts").alias("a_ts"), F.col("v").alias("a_v"))
    for equal in (True, False):
        got = {r.id: (r.a_id, r.a_ts, r.a_v) for r in O.asof_join(left, right, ["k"], "ts", "a_ts", None, "a_id", allow_equal=equal).collect()}
        for e in (e for e in rows if e[3] != "a"):
            earlier = [x for x in rows if x[1] == e[1] and x[3] == "a" and x[2] is not None and e[2] is not None and (x[2] < e[2] or equal and x[2] == e[2])]
            best = max(earlier, key=order, default=None)
            assert got[e[0]] == ((best[0], best[2], best[4]) if best else (None, None, None))
    tied = {r.id: r.a_id for r in O.asof_join(left, right, ["k"], "ts", "a_ts", "id", "a_id", allow_equal=False).collect()}
    for e in (e for e in rows if e[3] != "a" and e[2] is not None):
        best = max((x for x in rows if x[1] == e[1] and x[3] == "a" and x[2] is not None and (x[2], x[0]) < (e[2], e[0])), key=order, default=(None,))
        assert tied[e[0]] == best[0]


def test_running_count_and_rate(spark, dealt):
    rows = events(3)
    df = O.running_count(spark.createDataFrame(rows, SCHEMA), ["k"], ["ts", "id"], "n")
    got = {r.id: r.n for r in df.collect()}
    assert got == {e[0]: sum(x[1] == e[1] and order(x) <= order(e) for x in rows) for e in rows}
    rates = {r.id: r.rate for r in O.counter_rate(spark.createDataFrame([e for e in rows if e[2]], SCHEMA), ["k"], "ts", "v", "id").collect()}
    timed = [e for e in rows if e[2]]
    for e in timed:
        best = max((x for x in timed if x[1] == e[1] and order(x) < order(e)), key=order, default=None)
        grown = (e[4] - best[4]) / max((e[2] - best[2]).total_seconds(), 1e-6) if best and None not in (e[4], best[4]) else 0.0
        assert abs(rates[e[0]] - round(max(grown, 0.0), 3)) < 2e-3


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert O.look_back(none, ["k"], ["ts"], ["v"]).collect() == [] and O.running_count(none, ["k"], ["ts"]).collect() == []
    one = spark.createDataFrame(events(4, 5), SCHEMA).select("id", "k", "ts")
    right = none.select("k", F.col("ts").alias("r_ts"), F.col("v").alias("r_v"))
    assert [r.r_v for r in O.asof_join(one, right, ["k"], "ts", "r_ts").collect()] == [None] * 5
    assert O.asof_join(one.limit(0), right, ["k"], "ts", "r_ts").collect() == []


def test_a_hot_key_is_spread(spark, monkeypatch):
    """A key with nearly all rows, and rows that are alike in key and time, are on many ranges."""
    before = conf(spark, spark__sql__shuffle__partitions="12", spark__sql__adaptive__coalescePartitions__enabled="false")
    try:
        sizes, original = [], O.written

        def written(df, name):
            out = original(df, name)
            sizes.append([r["count"] for r in out.groupBy("__part").count().collect()])
            return out

        monkeypatch.setattr(O, "written", written)
        df = spark.range(6000).select("id", F.lit(1).alias("k"), F.when(F.col("id") < 3000, F.lit(0)).otherwise(F.col("id")).alias("ts"), F.lit(1.0).alias("v"))
        got = O.running_count(df, ["k"], ["ts"], "n")
        assert sorted(r.n for r in got.collect()) == list(range(1, 6001))
        assert O.look_back(df, ["k"], ["ts"], ["v"]).where("before_v IS NULL").count() == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert all(len(s) >= 10 and max(s) < 3 * 6000 / 12 for s in sizes) and len(sizes) >= 2
