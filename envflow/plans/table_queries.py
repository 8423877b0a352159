"""Queries of filters, aggregates, joins, sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow.operators import aggregates as A
from envflow.operators import geo
from envflow.operators import ordered as O
from envflow.operators import tables as T
from envflow.registry import query, table

PARAMETERS = ("view", "click", "purchase")
_MEAN = "round(CAST(sum(CAST(value AS DECIMAL(28,6))) AS DOUBLE) / count(value), 6)"


@query(f"""SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, event_type,
count(*) AS n, min(value) AS min_value, max(value) AS max_value, {_MEAN} AS mean_value FROM events WHERE lower(event_type) IN {PARAMETERS} GROUP BY ALL""")
def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: readings of the known parameters by hour and parameter."""
    events = table(spark, sf_dir, "events").where(T.is_one_of(F.col("event_type"), PARAMETERS))
    return A.hourly(events, "ts", "event_type", "value")


@query("SELECT event_id, event_type FROM events WHERE lower(event_type) IN ('view', 'error')")
def filter_in_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(T.is_one_of(F.upper("event_type"), ("view", "error"))).select("event_id", "event_type")


@query("SELECT count(*) FILTER (lower(event_type) NOT IN ('view', 'error')) AS rejected, count(*) AS seen FROM events")
def count_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.count_if(~T.is_one_of(F.col("event_type"), ("view", "error"))).alias("rejected"), F.count("*").alias("seen"))


@query("SELECT p_partkey, p_name FROM part WHERE coalesce(regexp_matches(p_name, 'RING|Wid', 'i'), false)")
def filter_regex_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where(T.matches(F.col("p_name"), "RING|Wid")).select("p_partkey", "p_name")


@query("SELECT page_id, url FROM pages WHERE ends_with(url, '.html')")
def filter_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where(F.col("url").endswith(".html")).select("page_id", "url")


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-12 12:30:00'")
def filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.time_range(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "2024-01-05 00:00:00", "2024-01-12 12:30:00")


@query("""SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND contains(o_orderpriority, 'LOW')
AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1997-12-31' ORDER BY o_orderdate DESC, o_orderkey LIMIT 50""")
def catalogue_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue's search: collection, part of a name, period, newest first, the first 50."""
    found = table(spark, sf_dir, "orders").where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").contains("LOW"))
    found = T.time_range(found, "o_orderdate", "1996-01-01 00:00:00", "1997-12-31 00:00:00")
    return T.top_n(found.select("o_orderkey", "o_orderdate", "o_orderpriority"), 50, F.col("o_orderdate").desc(), F.col("o_orderkey"))


def _status() -> Column:
    """Missing id, then offline, then already there, then failed or downloaded; a null flag is offline."""
    k = F.col("o_orderkey")
    online = F.when(k % 11 != 0, k % 7 != 0)
    return F.when(F.nullif(k % 13, F.lit(0)).isNull(), "skipped_missing_id").when(~F.coalesce(online, F.lit(False)), "skipped_offline").when(F.col("o_orderstatus") == "O", "skipped_exists").when(F.col("o_totalprice") > 400000, "failed").otherwise("downloaded")


_STATUS_SQL = """CASE WHEN o_orderkey % 13 = 0 THEN 'skipped_missing_id' WHEN o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 THEN 'skipped_offline'
WHEN o_orderstatus = 'O' THEN 'skipped_exists' WHEN o_totalprice > 400000 THEN 'failed' ELSE 'downloaded' END"""


@query(f"SELECT o_orderkey, {_STATUS_SQL} AS status FROM orders")
def status_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", _status().alias("status"))


@query(f"SELECT {_STATUS_SQL} AS status, count(*) AS n FROM orders GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(_status().alias("status")).agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem ORDER BY l_suppkey, l_partkey, l_orderkey, l_linenumber")
def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return T.sort_by(rows, "l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")


@query("SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def sort_null_as_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keys descending; null sorts as the empty text."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"))
    return rows.orderBy(F.coalesce("segment", F.lit("")).desc(), F.col("c_custkey").desc())


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_name LIMIT 100")
def ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 100 by name: what a cap on stations or files means."""
    return T.top_n(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), 100, F.col("c_name"))


@query("""SELECT coalesce(nullif(CASE WHEN user_id % 9 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END, ''), '(none)') AS city, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, city LIMIT 10""")
def top10_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    city = F.when(F.col("user_id") % 9 == 0, "").otherwise(F.col("user_id").cast("string"))
    named = table(spark, sf_dir, "events").select(F.coalesce(F.nullif(city, F.lit("")), F.lit("(none)")).alias("city"))
    return T.top_n(named.groupBy("city").agg(F.count("*").alias("n")), 10, F.col("n").desc(), F.col("city"))


@query("SELECT event_id, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
def latest_group_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.latest_group(table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day")), "day")


@query(f"""WITH s AS (SELECT o_orderkey, {_STATUS_SQL} AS status FROM orders), w AS (SELECT *, coalesce(sum(CASE WHEN status = 'downloaded' THEN 1 ELSE 0 END) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM s)
SELECT o_orderkey, status FROM w WHERE before < 500""")
def capped_successes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cap on successes alone: rows after the 500th are not worked on."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", _status().alias("status"))
    return T.until_n_successes(rows, F.col("status") == "downloaded", "o_orderkey", 500)


@query("""SELECT event_id, user_id, event_type AS product_type FROM events WHERE event_type IN ('view', 'click', 'error')""")
def union_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return T.union_tagged({k: events.where(F.col("event_type") == k).select("event_id", "user_id") for k in ("view", "click", "error")}, "product_type")


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type").dropDuplicates()


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return T.first_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_mktsegment = 'NONE')""")
def fallback_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second source, as the first gives nothing."""
    first = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "NONE").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return T.or_else(first, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1")
def count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.count_by(table(spark, sf_dir, "events"), "event_type")


@query("SELECT count(DISTINCT user_id) AS users, count(DISTINCT event_type) AS types FROM events")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_type").alias("types"))


@query("SELECT min(ts) AS first_time, max(ts) AS last_time, count(*) AS n FROM events")
def global_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(F.min("ts").alias("first_time"), F.max("ts").alias("last_time"), F.count("*").alias("n"))


@query("SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_keys, min(ts) AS first_time, max(ts) AS last_time FROM events")
def summary_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.summary(table(spark, sf_dir, "events"), "user_id", "ts")


@query("SELECT CAST(ts AS DATE) AS day, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS files FROM events WHERE event_type = 'signup' GROUP BY 1")
def collect_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of each day, in order; as text, so that all engines compare it alike."""
    files = table(spark, sf_dir, "events").where(F.col("event_type") == "signup").groupBy(F.col("ts").cast("date").alias("day")).agg(F.sort_array(F.collect_list("event_id")).alias("files"))
    return files.withColumn("files", F.array_join("files", ","))


@query("""SELECT day, CAST((r - 1) // 100 AS BIGINT) AS part, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS files
FROM (SELECT event_id, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS r FROM events) GROUP BY ALL""")
def collect_by_day_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of each day, in order and in lists of a hundred at most, so that no row grows with a day and no day is one task's."""
    files = O.running_count(table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"), "event_id"), ["day"], ["event_id"], "n")
    lists = files.groupBy("day", F.floor((F.col("n") - 1) / 100).alias("part")).agg(F.sort_array(F.collect_list("event_id")).alias("files"))
    return lists.withColumn("files", F.array_join("files", ","))


@query("SELECT event_type AS topic, CAST(sum(last) AS BIGINT) AS total FROM (SELECT event_type, user_id % 3 AS p, max(event_id) AS last FROM events GROUP BY ALL) GROUP BY 1")
def offsets_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End offsets summed over partitions."""
    ends = table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 3).alias("p")).agg(F.max("event_id").alias("last"))
    return ends.groupBy(F.col("event_type").alias("topic")).agg(F.sum("last").alias("total"))


@query("""WITH c AS (SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM events),
d AS (SELECT *, lag(total) OVER w AS pt, lag(ts) OVER w AS pts FROM c WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, round(coalesce(greatest((total - pt) / greatest(epoch_us(ts) / 1e6 - epoch_us(pts) / 1e6, 1e-6), 0.0), 0.0), 3) AS rate FROM d""")
def counter_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of a cumulative counter by user; the counter here is the number of the user's events so far."""
    events = O.running_count(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], "total")
    return O.counter_rate(events, ["user_id"], "ts", "total", "event_id").select("event_id", "user_id", "rate")


@query("""WITH e AS (SELECT *, CAST(epoch_us(ts) AS HUGEINT) * 4294967296 + event_id AS o FROM events)
SELECT l.event_id, l.user_id, l.ts, r.event_id AS view_id, r.ts AS view_ts, r.value AS view_value FROM (SELECT * FROM e WHERE event_type = 'purchase') l ASOF LEFT JOIN (SELECT * FROM e WHERE event_type = 'view') r ON l.user_id = r.user_id AND l.o > r.o""")
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the user's newest view before it."""
    events = table(spark, sf_dir, "events")
    left = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"), F.col("value").alias("view_value"))
    return O.asof_join(left, right, ["user_id"], "ts", "view_ts", "event_id", "view_id", allow_equal=False)


@query("""SELECT event_type, event_id, user_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.latest_per_key(table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "ts"), ["event_type"], ["ts", "event_id"])


@query("""SELECT event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS r FROM events) WHERE r <= 20""")
def topn_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.top_per_group(table(spark, sf_dir, "events").select("event_type", "event_id", "ts"), ["event_type"], 20, F.col("ts").desc(), F.col("event_id"))


@query("SELECT n_name AS place, CAST(d AS DATE) AS day FROM nation, generate_series(DATE '2025-01-01', DATE '2025-01-31', INTERVAL 1 DAY) t(d)")
def cross_join_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place with every day: the days are exploded in each place's row, so nothing is joined."""
    days = F.sequence(F.lit("2025-01-01").cast("date"), F.lit("2025-01-31").cast("date"))
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("place"), F.explode(days).alias("day"))


@query("SELECT c_custkey, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def broadcast_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups in dimensions of fixed size."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    dim = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select("n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    return table(spark, sf_dir, "customer").join(F.broadcast(dim), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "nation", "region")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, s_name, p_brand FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey""")
def star_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurement, station, sensor: dependent look-ups as equi-joins; the optimiser picks the way by size."""
    item = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    supplier, part = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = item.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "s_name", "p_brand")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey IN (1, 3))")
def semi_join_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with an unknown key are skipped."""
    known = table(spark, sf_dir, "nation").where(F.col("n_regionkey").isin(1, 3))
    return table(spark, sf_dir, "customer").join(F.broadcast(known), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_nationkey")


_BOXES = """WITH a AS (SELECT s_suppkey, s_nationkey * 4 AS ax0, s_suppkey % 50 AS ay0, s_nationkey * 4 + 3 AS ax1, s_suppkey % 50 + 2 AS ay1 FROM supplier),
b AS (SELECT c_custkey, c_custkey % 97 AS bx0, c_custkey % 47 AS by0, c_custkey % 97 + 2 AS bx1, c_custkey % 47 + 4 AS by1 FROM customer)"""


@query(f"{_BOXES} SELECT s_suppkey, c_custkey FROM a JOIN b ON ax0 <= bx1 AND bx0 <= ax1 AND ay0 <= by1 AND by0 <= ay1")
def bbox_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes that overlap, by an equi-join on grid cells."""
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    a = table(spark, sf_dir, "supplier").select("s_suppkey", (n * 4).alias("ax0"), (s % 50).alias("ay0"), (n * 4 + 3).alias("ax1"), (s % 50 + 2).alias("ay1"))
    c = F.col("c_custkey")
    b = table(spark, sf_dir, "customer").select("c_custkey", (c % 97).alias("bx0"), (c % 47).alias("by0"), (c % 97 + 2).alias("bx1"), (c % 47 + 4).alias("by1"))
    return geo.overlap_join(a, b, ("ax0", "ay0", "ax1", "ay1"), ("bx0", "by0", "bx1", "by1"), 4.0).select("s_suppkey", "c_custkey")
