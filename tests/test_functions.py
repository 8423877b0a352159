"""Column functions on spelled-out examples and on generated values."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envflow import functions as X

ONCE = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def of(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_numbers(spark):
    rows = [("3.7",), (" 24.0 ",), ("nan",), ("",), ("x",), (None,), ("1e3",)]
    got = of(spark, rows, "x string", X.safe_bigint(F.col("x")), X.safe_double(F.col("x")))
    assert got == [(3, 3.7), (24, 24.0), (None, None), (None, None), (None, None), (None, None), (1000, 1000.0)]


def test_stock_spellings(spark):
    got = of(spark, [("23,95", "-0,6(-2,44 %)", "02/03/2026")], "a string, b string, c string", X.decimal_comma(F.col("a")), X.change_parts(F.col("b")), X.parse_date(F.col("c"), "dd/MM/yyyy"))
    assert got == [(23.95, (-0.6, -2.44), dt.date(2026, 3, 2))]


def test_times(spark):
    rows = [("2026-03-28T10:00:00+00:00",), ("2026-03-28 10:00:00+07:00",), ("nan",), (None,)]
    got = of(spark, rows, "x string", X.parse_time(F.col("x")).cast("timestamp_ntz"))
    assert got == [(dt.datetime(2026, 3, 28, 10),), (dt.datetime(2026, 3, 28, 3),), (None,), (None,)]


def test_text(spark):
    got = of(spark, [("\t a_b \r\n", "/data/Ha_Noi/2025-01-02.json", " a,, b ,")], "a string, p string, l string", X.clean(F.col("a")), X.parent_folder(F.col("p")), X.stem(F.col("p")), X.list_items(F.col("l")), X.sanitized(F.lit("Hà Nội/1.nc")))
    assert got == [("a_b", "Ha Noi", "2025-01-02", ["a", "b"], "Hà_Nội_1.nc")]


def test_keys_are_null_where_a_part_is(spark):
    got = of(spark, [(1, None, "pm25", "t")], "a int, b int, c string, d string", X.air_key(*map(F.col, "abcd")), X.weather_key(F.col("c"), F.col("d")))
    assert got == [(None, "pm25_t")]


def test_masks(spark):
    rows = [(5.0, 0.4), (5.0, 0.5), (5.0, None), (-9999.0, 1.0), (math.nan, 1.0), (-1e31, 1.0), (None, 1.0)]
    got = of(spark, rows, "v double, q double", X.masked(F.col("v"), -9999.0, F.col("q")))
    assert [g[0] for g in got] == [None, 5.0, 5.0, None, None, None, None]


def test_human_bytes(spark):
    got = of(spark, [(0,), (512,), (1536,), (2 * 1024**2,), (5 * 1024**5,), (None,)], "b bigint", X.human_bytes(F.col("b")))
    assert [g[0] for g in got] == ["0 B", "512 B", "1.5 KB", "2.0 MB", "5120.0 TB", None]


def test_polygon(spark):
    ring = F.array(*(F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (4, 0), (4, 4), (2, 2), (0, 4))))
    got = of(spark, [(1.0, 1.0), (2.0, 3.0), (3.9, 3.5), (5.0, 1.0)], "x double, y double", X.polygon_holds(ring, F.col("x"), F.col("y")))
    assert [g[0] for g in got] == [True, False, True, False]


def test_sinusoidal(spark):
    r = 6371007.181
    lon, lat = math.radians(105.8), math.radians(21.0)
    got = of(spark, [(r * lon * math.cos(lat), r * lat)], "x double, y double", X.sinusoidal_to_lonlat(F.col("x"), F.col("y")))[0][0]
    assert abs(got[0] - 105.8) < 1e-9 and abs(got[1] - 21.0) < 1e-9


@ONCE
@given(st.lists(st.tuples(st.integers(0, 500), st.integers(0, 60)), min_size=1, max_size=30))
def test_coverage(spark, rows):
    got = of(spark, rows, "o bigint, e bigint", X.coverage_pct(F.col("o"), F.col("e")))
    for (o, e), (pct,) in zip(rows, got, strict=True):
        assert abs(pct - o / max(e, 1) * 100) <= 0.05 + 1e-9


@ONCE
@given(st.lists(st.decimals(-10_000, 10_000, places=2), min_size=1, max_size=30))
def test_decimal_comma(spark, values):
    got = of(spark, [(str(v).replace(".", ","),) for v in values], "x string", X.decimal_comma(F.col("x")))
    assert [g[0] for g in got] == [float(v) for v in values]
