"""Queries of projections and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow import functions as X
from envflow.registry import query, table


@query("""SELECT event_id, CAST(CAST(event_id AS VARCHAR) AS VARCHAR) AS key_text, CAST(user_id AS INTEGER) AS sensor, CAST(value AS VARCHAR) IS NOT NULL AS has_value FROM events""")
def cast_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes to text, as of a message's key, and typed casts."""
    raw = table(spark, sf_dir, "events").select(F.col("event_id"), F.encode(F.col("event_id").cast("string"), "UTF-8").alias("key"), "user_id", "value")
    return raw.select("event_id", F.col("key").cast("string").alias("key_text"), F.col("user_id").cast("int").alias("sensor"), F.col("value").cast("string").isNotNull().alias("has_value"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def from_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads parsed by a fixed schema and expanded; malformed ones stay, with nulls."""
    parsed = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k BIGINT").alias("data"))
    return parsed.select("event_id", "data.*")


@query("""SELECT event_id, CAST(ts AS DATE) AS day_date, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd")
    return events.select("event_id", X.parse_date(text).alias("day_date"), F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"))


@query("""SELECT event_id, date_trunc('minute', ts) AS local_minute, date_trunc('second', ts) AS iso_second, CAST(NULL AS TIMESTAMP) AS bad FROM events""")
def parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of three spellings; what can't be parsed is null."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        X.parse_time(F.date_format(ts, "yyyy-MM-dd HH:mm"), "yyyy-MM-dd HH:mm").cast("timestamp_ntz").alias("local_minute"),
        X.parse_time(F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "Z").otherwise("+00:00"))).cast("timestamp_ntz").alias("iso_second"),
        X.parse_time(F.concat(F.lit("nan"), F.col("event_id").cast("string"))).cast("timestamp_ntz").alias("bad"),
    )


@query("""SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') || printf('%03d', CAST(date_part('milliseconds', ts) AS BIGINT) % 1000) || 'Z' AS iso, strftime(ts, '%Y-%m-%d') AS day_text FROM events""")
def format_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", X.iso_utc(F.col("ts")).alias("iso"), F.date_format("ts", "yyyy-MM-dd").alias("day_text"))


@query("""SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS DATE) AS day FROM events""")
def date_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = table(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b"))
    return ends.select(F.explode(X.date_range(F.col("a"), F.col("b"))).alias("day"))


@query("""SELECT event_id, CAST(ts - INTERVAL 7 DAY AS DATE) AS week_before, ts - INTERVAL 24 HOUR AS day_before FROM events""")
def relative_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.date_sub(F.col("ts").cast("date"), 7).alias("week_before"), (F.col("ts") - F.expr("INTERVAL 24 HOURS")).alias("day_before"))


@query("""SELECT event_id, make_timestamp(CAST(event_id * 86400123 AS BIGINT) * 1000) AS from_millis, make_timestamp(CAST(event_id * 3600 AS BIGINT) * 1000000) AS from_seconds FROM events""")
def epoch_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_ = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", F.timestamp_millis(id_ * 86400123).cast("timestamp_ntz").alias("from_millis"), F.timestamp_seconds(id_ * 3600).cast("timestamp_ntz").alias("from_seconds"))


@query("""SELECT event_id, CAST(strptime(strftime(ts, '%Y%j'), '%Y%j') AS DATE) AS file_day FROM events""")
def regex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day of year out of a file name."""
    name = F.concat(F.lit("MCD19A2.A"), F.date_format("ts", "yyyyDDD"), F.lit(".h27v06.hdf"))
    return table(spark, sf_dir, "events").select("event_id", X.parse_date(F.regexp_extract(name, r"\.A(\d{7})\.", 1), "yyyyDDD").alias("file_day"))


@query("""SELECT event_id, replace(upper(CASE WHEN event_type = 'view' THEN 'pm25' ELSE event_type END), 'PM25', 'PM2.5') AS shown, lower(event_type) AS low FROM events""")
def display_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_type") == "view", "pm25").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", X.display_parameter(name).alias("shown"), F.lower("event_type").alias("low"))


@query("""SELECT c_custkey, c_name AS name FROM customer""")
def trim_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White space of every kind goes from both ends."""
    return table(spark, sf_dir, "customer").select("c_custkey", X.clean(F.concat(F.lit(" \t\n"), F.col("c_name"), F.lit("\r\n  ").substr(1, 2))).alias("name"))


@query("""SELECT event_id, 'Province ' || user_id || '_' || strftime(ts, '%Y-%m-%d %H:%M') AS weather_id,
'openaq_' || user_id || '_' || event_id || '_' || event_type || '_' || strftime(ts, '%Y-%m-%d %H:%M:%S') AS air_id,
's5p_' || event_type || '_' || event_id || '_' || strftime(ts, '%Y-%m-%dT%H:%M') || '_' || strftime(ts, '%Y-%m-%d') AS product_id FROM events""")
def event_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable keys of events; null where a part is."""
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf_dir, "events").select(
        "event_id",
        X.weather_key(F.concat(F.lit("Province "), F.col("user_id").cast("string")), F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("weather_id"),
        X.air_key(F.col("user_id"), F.col("event_id"), F.col("event_type"), time).alias("air_id"),
        X.product_key(F.col("event_type"), F.concat(F.lit(" "), F.col("event_id").cast("string")), F.date_format("ts", "yyyy-MM-dd'T'HH:mm"), F.date_format("ts", "yyyy-MM-dd")).alias("product_id"),
    )


@query("""SELECT p_partkey, item FROM (SELECT p_partkey, trim(unnest(string_split(replace(p_name, ' ', ' , ,'), ','))) AS item FROM part) WHERE item <> ''""")
def split_trim_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.col("p_name"), F.lit(" "), F.lit(" , ,"))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(X.list_items(text)).alias("item"))


@query("""SELECT page_id, regexp_replace(url, '[^\\p{L}\\p{N}\\-_.]', '_', 'g') AS file_name FROM pages""")
def sanitize_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.sanitized(F.col("url")).alias("file_name"))


@query("""WITH p AS (SELECT c_custkey, '/data/' || replace(c_mktsegment, 'U', '_') || '/2025-01-' || lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0') || '.json' AS path FROM customer)
SELECT c_custkey, replace(string_split(path, '/')[-2], '_', ' ') AS province, regexp_extract(path, '([^/]*)\\.[^./]*$', 1) AS day_text,
CAST(regexp_extract(path, '([^/]*)\\.[^./]*$', 1) AS DATE) AS day, string_split(path, '/')[-1] AS file_name FROM p""")
def path_derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Province and day out of a file's path."""
    day = F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0")
    path = F.concat(F.lit("/data/"), F.replace(F.col("c_mktsegment"), F.lit("U"), F.lit("_")), F.lit("/2025-01-"), day, F.lit(".json"))
    files = table(spark, sf_dir, "customer").select("c_custkey", path.alias("path"))
    path = F.col("path")
    return files.select("c_custkey", X.parent_folder(path).alias("province"), X.stem(path).alias("day_text"), X.parse_date(X.stem(path)).alias("day"), X.basename(path).alias("file_name"))


@query("""SELECT s_suppkey, coalesce(nullif(CASE WHEN s_nationkey % 3 = 0 THEN '' ELSE s_name END, ''), 'unknown') AS name,
CAST(coalesce(nullif(s_nationkey, 0), 1) AS INTEGER) AS expected FROM supplier""")
def coalesce_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty text and 0 count as missing."""
    name = F.when(F.col("s_nationkey") % 3 == 0, "").otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", X.default(name, "unknown").alias("name"), X.default(F.col("s_nationkey"), 1).alias("expected"))


@query("""WITH t AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'nan' WHEN 1 THEN ' ' WHEN 2 THEN 'x1' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS raw, event_id % 5 AS m, value FROM events)
SELECT event_id, CASE WHEN m >= 3 THEN CAST(raw AS DOUBLE) END AS as_double, CASE WHEN m >= 3 THEN CAST(trunc(CAST(raw AS DOUBLE)) AS BIGINT) END AS as_bigint FROM t""")
def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to numbers; blank, nan and bad text are null, and fractions are cut off."""
    m = F.col("event_id") % 5
    raw = F.when(m == 0, "nan").when(m == 1, " ").when(m == 2, "x1").otherwise(F.col("value").cast("decimal(18,2)").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", X.safe_double(raw).alias("as_double"), X.safe_bigint(raw).alias("as_bigint"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(l_quantity AS DOUBLE) / greatest(l_linenumber * 8, 1) * 100, 1) AS pct FROM lineitem""")
def coverage_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", X.coverage_pct(F.col("l_quantity"), F.col("l_linenumber") * 8).alias("pct"))


@query("""SELECT n_nationkey, 'POLYGON((' || n_nationkey || ' ' || n_regionkey || ', ' || n_nationkey + 2 || ' ' || n_regionkey || ', ' || n_nationkey + 2 || ' ' || n_regionkey + 3 || ', ' || n_nationkey || ' ' || n_regionkey + 3 || ', ' || n_nationkey || ' ' || n_regionkey || '))' AS wkt FROM nation""")
def bbox_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("n_nationkey"), F.col("n_regionkey")
    return table(spark, sf_dir, "nation").select("n_nationkey", X.bbox_wkt(x, y, x + 2, y + 3).alias("wkt"))


@query("""SELECT event_id AS key, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '","place":"Hà Nội"}' AS value FROM events""")
def to_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and JSON value of messages; text beyond ASCII stays as it is."""
    body = F.struct("event_id", "user_id", "event_type", F.lit("Hà Nội").alias("place"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("key"), F.to_json(body).alias("value"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'none' AS missing FROM events""")
def nested_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths into documents, null or a default where a step is missing."""
    doc = F.col("props")
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object(doc, "$.k").cast("bigint").alias("k"), F.coalesce(F.get_json_object(doc, "$.a.b.c"), F.lit("none")).alias("missing"))


@query("""SELECT event_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS price FROM events""")
def parse_decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.replace(F.col("value").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    return table(spark, sf_dir, "events").select("event_id", X.decimal_comma(text).alias("price"))


@query("""SELECT event_id, CAST(-CAST(value AS DECIMAL(18,1)) AS DOUBLE) AS change, CAST(-CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS pct FROM events""")
def parse_change_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    comma = lambda digits: F.replace((-F.col("value").cast(f"decimal(18,{digits})")).cast("string"), F.lit("."), F.lit(","))
    text = F.concat(comma(1), F.lit("("), comma(2), F.lit(" %)"))
    return table(spark, sf_dir, "events").select("event_id", X.change_parts(text).alias("c")).select("event_id", "c.change", "c.pct")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS trade_date FROM orders""")
def parse_dmy_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", X.parse_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("trade_date"))


@query("""SELECT user_id AS sensor_id, lower(event_type) AS parameter, value AS reading, event_id AS id FROM events""")
def rename_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names are given to the first candidate that is there; wanted columns that are missing are left out."""
    from envflow.operators.tables import keep_present, rename_first

    events = rename_first(table(spark, sf_dir, "events"), {"sensor_id": ["station", "user_id"], "reading": ["value", "v"], "parameter": ["event_type"], "id": ["event_id"]})
    return keep_present(events, ["sensor_id", "parameter", "reading", "missing", "id"]).withColumn("parameter", F.lower("parameter"))


@query("""SELECT event_id, user_id AS sensor, event_type AS parameter, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'events' AS source, CAST(ts AS DATE) AS query_date FROM events""")
def flatten_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested record flattened, with constants and provenance."""
    nested = table(spark, sf_dir, "events").select(F.struct("event_id", F.struct(F.col("user_id").alias("sensor"), F.col("event_type").alias("parameter")).alias("of"), "value", F.from_json("props", "k BIGINT").alias("p"), "ts").alias("r"))
    return nested.select("r.event_id", "r.of.sensor", "r.of.parameter", "r.value", "r.p.k", F.lit("events").alias("source"), F.col("r.ts").cast("date").alias("query_date"))
