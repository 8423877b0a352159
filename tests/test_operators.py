"""Operators against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from envflow.operators import aggregates as A
from envflow.operators import geo
from envflow.operators import ordered as O
from envflow.operators import raster as R
from envflow.operators import tables as T


def test_boxes_of_any_size_have_few_cells(spark):
    """A box around the world among villages: the same pairs as a nested loop, and four cells a level at most."""
    rng = random.Random(4)

    def box():
        size = rng.choice((0.001, 0.5, 30.0, 360.0))
        x, y = rng.uniform(-180, 180), rng.uniform(-90, 90)
        return x, y, x + size * rng.random(), y + size * rng.random()

    a, b = [(i, *box()) for i in range(150)] + [(900, -180.0, -90.0, 180.0, 90.0), (901, float("nan"), 0.0, 1.0, 1.0), (902, 0.0, 0.0, float("inf"), 1.0)], [(i, *box()) for i in range(160)] + [(900, -180.0, -90.0, 180.0, 90.0)]
    want = sorted((p[0], q[0]) for p in a if p[0] < 901 for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    left, right = spark.createDataFrame(a, "i int, ax0 double, ay0 double, ax1 double, ay1 double"), spark.createDataFrame(b, "j int, bx0 double, by0 double, bx1 double, by1 double")
    for cell in (0.001, 0.1, 50.0):
        got = geo.overlap_join(left, right, ("ax0", "ay0", "ax1", "ay1"), ("bx0", "by0", "bx1", "by1"), cell)
        assert rows(got.select("i", "j"), "i", "j") == want and got.columns == left.columns + right.columns


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_overlap_join_equals_nested_loop(spark):
    rng = random.Random(1)
    box = lambda: (x := rng.randint(-50, 50), y := rng.randint(-50, 50), x + rng.randint(0, 9), y + rng.randint(0, 9))
    a, b = [(i, *box()) for i in range(80)], [(i, *box()) for i in range(90)]
    want = sorted((p[0], q[0]) for p in a for q in b if p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4])
    left = spark.createDataFrame([*a, (99, None, 1, 2, 3)], "i int, ax0 int, ay0 int, ax1 int, ay1 int")
    right = spark.createDataFrame(b, "j int, bx0 int, by0 int, bx1 int, by1 int")
    got = geo.overlap_join(left, right, ("ax0", "ay0", "ax1", "ay1"), ("bx0", "by0", "bx1", "by1"), 5.0).select("i", "j")
    assert rows(got, "i", "j") == want


def test_equal_boxes_are_joined_once_and_dealt_out(spark):
    """Many rows of one box are lists in the join; heavy pairs of lists are dealt out before they are unpacked."""
    a, b = spark.range(300).selectExpr("id AS i", "0 AS ax0", "0 AS ay0", "1 AS ax1", "1 AS ay1", "map('k', id) AS m"), spark.range(400).selectExpr("id AS j", "1 AS bx0", "1 AS by0", "2 AS bx1", "2 AS by1")
    got = geo.overlap_join(a, b, ("ax0", "ay0", "ax1", "ay1"), ("bx0", "by0", "bx1", "by1"), 4.0)
    assert got.columns == a.columns + b.columns and got.select("i", "j").distinct().count() == got.count() == 300 * 400
    sizes = [r[0] for r in got.groupBy(F.spark_partition_id()).count().select("count").collect()]
    plan = got._jdf.queryExecution().toString()
    assert "explode(_arows" in plan and "RepartitionByExpression" not in plan and "Repartition " in plan and sum(sizes) == 120000


def test_until_n_successes(spark):
    df = spark.createDataFrame([(i, i % 3 == 0) for i in range(20)], "id int, ok boolean")
    for n, last in ((0, None), (1, 0), (3, 6), (99, 19)):
        got = [r.id for r in T.until_n_successes(df, F.col("ok"), "id", n).orderBy("id").collect()]
        assert got == ([] if last is None else list(range(last + 1)))


def test_or_else(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2,), (3,)], "x int")
    assert rows(T.or_else(a, b)) == [(1,)]
    assert rows(T.or_else(a.where("x > 9"), b), "x") == [(2,), (3,)]


def test_first_and_latest_keep_whole_rows(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), ("b", 5, "z"), (None, 3, "n")], "k string, t int, v string")
    assert sorted(rows(T.latest_per_key(df, ["k"], ["t"])), key=str) == sorted([("a", 2, "y"), ("b", 5, "z"), (None, 3, "n")], key=str)
    assert ("a", 1, None) in rows(T.first_per_key(df, ["k"], ["t"]))


def test_latest_group_of_nothing(spark):
    assert rows(T.latest_group(spark.createDataFrame([], "d int"), "d")) == []


def test_masked_stats_without_valid_cells(spark):
    df = spark.createDataFrame([("p", None), ("p", float("nan"))], "product string, value double")
    assert rows(R.masked_stats(df, ["product"], F.col("value"))) == [("p", None, None, None, 0.0)]


def test_mosaic_takes_the_first_valid(spark):
    df = spark.createDataFrame([(0, 0, 1, None), (0, 0, 2, 5.0), (0, 0, 3, 6.0), (1, 1, 1, float("nan"))], "row int, col int, tile int, value double")
    assert rows(R.mosaic(df, "tile")) == [(0, 0, 5.0)]


def test_strict_or_relaxed(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("v"), (F.col("id") % 4).alias("qa"))
    few = R.strict_or_relaxed(df, "v", F.col("qa") == 0, least=5)
    assert few.where("kept IS NOT NULL").count() == 10
    enough = R.strict_or_relaxed(df, "v", F.col("qa") == 0, least=2)
    assert enough.where("kept IS NOT NULL").count() == 3


def test_counter_rate(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 0, 10), ("a", t + dt.timedelta(seconds=5), 1, 20), ("a", t + dt.timedelta(seconds=6), 2, 3)], "k string, ts timestamp, id int, total bigint")
    assert [r.rate for r in O.counter_rate(df, ["k"], "ts", "total", "id").orderBy("id").collect()] == [0.0, 2.0, 0.0]


def test_vertices(spark):
    shapes = [
        '{"type":"Point","coordinates":[1,2]}',
        '{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1]]],[[[5,5],[6,5],[6,6]]]]}',
        '{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[7,8]},{"type":"GeometryCollection","geometries":[{"type":"LineString","coordinates":[[9,9],[3,3]]}]}]}',
        "bad",
        None,
    ]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in shapes], "g string").select(geo.vertices(F.col("g"))).collect()]
    assert got == [[[1.0, 2.0]], [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [5.0, 5.0], [6.0, 5.0], [6.0, 6.0]], [[7.0, 8.0], [9.0, 9.0], [3.0, 3.0]], None, None]


def test_file_stats_and_health(spark):
    files = spark.createDataFrame([("a.parquet", 10, 5), ("b.crc", 99, 9), ("c.parquet", 20, 7)], "path string, length bigint, modificationTime bigint")
    assert rows(A.file_stats(files)) == [(2, 30, 7)]
    assert rows(A.file_stats(files.where("length > 1000"))) == [(0, 0, None)]
    assert rows(files.limit(1).select(A.healthy(F.lit(2), F.lit(1)), A.healthy(F.lit(None).cast("int"), F.lit(1)))) == [(True, False)]


def test_exact_percentile(spark):
    rng = random.Random(8)
    data = [(rng.choice(("a", "b", None)), rng.choice((1.5, rng.random() * 100))) for _ in range(3000)] + [("one", 7.0), ("bad", float("nan")), ("bad", None)]
    df = spark.createDataFrame(data, "k string, v double")
    want = {r.k: r.p for r in df.where("NOT isnan(v)").groupBy("k").agg(F.percentile("v", F.lit(0.98)).alias("p")).where("p IS NOT NULL").collect()}
    got = {r.k: r.p for r in A.exact_percentile(df, ["k"], "v", 0.98, "p", buckets=20).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    for q, buckets in ((0.0, 20), (0.5, 50), (0.5, 1000), (1.0, 20)):
        want = {r.k: r.p for r in df.where("NOT isnan(v)").groupBy("k").agg(F.percentile("v", F.lit(q)).alias("p")).collect()}
        got = {r.k: r.p for r in A.percentile_by(df, ["k"], "v", q, "p", buckets).collect()}
        assert got.keys() == want.keys() and got["bad"] is None and all(got[k] == want[k] or abs(got[k] - want[k]) < 1e-9 for k in want)


def test_time_range_prunes_partitions(spark, tmp_path):
    df = spark.range(96).select("id", F.timestamp_seconds(1735689600 + F.col("id") * 3600).cast("timestamp_ntz").alias("t"))
    df.withColumns({"year": F.year("t"), "month": F.month("t"), "day": F.dayofmonth("t")}).write.partitionBy("year", "month", "day").parquet(f"{tmp_path}/t")
    found = T.time_range(spark.read.parquet(f"{tmp_path}/t"), "t", "2025-01-02 05:00:00", "2025-01-03 00:00:00", ["year", "month", "day"])
    assert sorted(r.id for r in found.collect()) == list(range(29, 49))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [" in plan and "named_struct" in plan
    assert len(found.inputFiles()) and "PushedFilters: [IsNotNull(t)" in plan


def test_spatial_join(spark):
    rng = random.Random(4)

    def triangle():
        x, y = rng.randint(0, 40), rng.randint(0, 40)
        return [[float(x + rng.randint(0, 12)), float(y + rng.randint(0, 12))] for _ in range(3)]

    def area(t):
        return (t[1][0] - t[0][0]) * (t[2][1] - t[0][1]) - (t[1][1] - t[0][1]) * (t[2][0] - t[0][0])

    def apart(s, t):
        """Convex shapes are apart if an edge's normal separates them."""
        for ring in (s, t):
            for i in range(3):
                (x0, y0), (x1, y1) = ring[i], ring[(i + 1) % 3]
                nx, ny = y1 - y0, x0 - x1
                one, two = [nx * x + ny * y for x, y in s], [nx * x + ny * y for x, y in t]
                if max(one) < min(two) or max(two) < min(one):
                    return True
        return False

    shapes = [t for t in (triangle() for _ in range(160)) if area(t)]
    a, b = list(enumerate(shapes[:70])), list(enumerate(shapes[70:]))
    want = sorted((i, j) for i, s in a for j, t in b if not apart(s, t))
    schema = "id int, ring array<array<double>>"
    got = geo.spatial_join(spark.createDataFrame([*a, (900, None), (901, [])], schema), spark.createDataFrame(b, schema), "ring", "ring", 12.0)
    assert got.columns == ["id_left", "ring_left", "id_right", "ring_right"]
    assert sorted((r.id_left, r.id_right) for r in got.collect()) == want and want


def test_resample_tells_rasters_apart(spark):
    cells = spark.createDataFrame([(k, r, c, 100.0 * k + 10 * r + c) for k in (1, 2) for r in range(2) for c in range(2)], "k int, row int, col int, value double")
    targets = spark.createDataFrame([(k, x, y) for k in (1, 2, 3) for x in range(5) for y in range(4)], "k int, x int, y int")
    got = {(r.k, r.x, r.y): r.value for r in R.resample(cells, targets, F.col("y") * 0.5, F.col("x") * 0.5, ("k",)).collect()}
    assert got == {(k, x, y): 100.0 * k + 10 * (y // 2) + x // 2 if k < 3 and x < 4 else None for k in (1, 2, 3) for x in range(5) for y in range(4)}


def test_percentile_after_a_sketch_that_missed(spark, monkeypatch):
    """A sketch far coarser than it says misses ranks; those groups are done again, and the result is exact."""
    rng = random.Random(6)
    values = [(k, rng.gauss(0, 1) ** 3) for k in ("a", "b", None) for _ in range(4000)] + [("c", 1.0), ("d", None)]
    df = spark.createDataFrame(values, "k string, v double").repartition(6)
    asked, original = [], F.percentile_approx

    def coarse(c, ends, accuracy):
        asked.append(accuracy)
        return original(c, ends, F.lit(3)) if len(asked) == 1 else original(c, ends, accuracy)

    monkeypatch.setattr(A.F, "percentile_approx", coarse)
    got = {r.k: r.p for r in A.percentile_by(df, ["k"], "v", 0.98, "p").collect()}
    for k in ("a", "b", None, "c", "d"):
        own = sorted(v for key, v in values if key == k and v is not None)
        at = 0.98 * (len(own) - 1)
        want = own[int(at)] + (own[min(int(at) + 1, len(own) - 1)] - own[int(at)]) * (at - int(at)) if own else None
        assert got[k] is None if want is None else abs(got[k] - want) < 1e-12
    assert len(asked) >= 2 and len(got) == 5
