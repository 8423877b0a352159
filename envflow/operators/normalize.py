"""From raw records to typed events, as pure DataFrame functions; the same in batch and in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow import functions as X
from envflow import schemas


def weather(files: DataFrame, source: str = "file") -> DataFrame:
    """Day files as hourly events: days and hours are exploded, so a file without hours gives no row.

    Adds the instant (event_time, from the epoch), the local wall clock (event_time_local), and year and month of the
    provider's local day.
    """
    day = files.select("location", "source_file", F.explode("forecast.forecastday").alias("d"))
    hour = day.select("location", "source_file", F.col("d.date").alias("query_date"), F.explode("d.hour").alias("h"))
    province = X.parent_folder(F.col("source_file"))
    derived: dict[str, Column] = {
        "event_id": X.weather_key(province, F.col("h.time")), "province": province, "location_name": F.col("location.name"), "query_date": F.col("query_date"),
        "condition_text": F.col("h.condition.text"), "condition_code": F.col("h.condition.code"), "condition_icon": F.col("h.condition.icon"),
        "source": F.lit(source), "source_file": X.basename(F.col("source_file")), "ingest_time": X.iso_utc(F.current_timestamp()),
    }
    derived |= {c: F.col(f"location.{c}") for c in ("country", "region", "lat", "lon", "tz_id")}
    columns = [derived.get(f.name, F.col(f"h.{f.name}") if f.name not in derived else None).cast(f.dataType).alias(f.name) for f in schemas.WEATHER_EVENT]
    return weather_times(hour.select(*columns))


def weather_bodies(answers: DataFrame) -> DataFrame:
    """Answers of a weather service (tag, body), the tag being the place asked for, in the shape of day files; errors are left out."""
    return answers.where("body IS NOT NULL").select("tag", F.from_json("body", schemas.WEATHER_FILE).alias("b")).select("b.location", "b.forecast", F.concat("tag", F.lit("/api")).alias("source_file"))


def weather_times(events: DataFrame) -> DataFrame:
    """Typed days and times of weather events, and their partition columns."""
    return events.withColumns(
        {
            "query_date": X.parse_date(F.col("query_date")),
            "event_time": F.timestamp_seconds("time_epoch"),
            "event_time_local": X.parse_time(F.col("time"), "yyyy-MM-dd HH:mm").cast("timestamp_ntz"),
            "ingest_time": X.parse_time(F.col("ingest_time")),
        }
    ).withColumns({"year": F.year("query_date"), "month": F.month("query_date")})


def daily_weather(events: DataFrame) -> DataFrame:
    """What a provider's daily summary says, from the hours."""
    return events.groupBy("province", "query_date").agg(
        F.max("temp_c").alias("maxtemp_c"), F.min("temp_c").alias("mintemp_c"), F.avg("temp_c").alias("avgtemp_c"), F.max("wind_kph").alias("maxwind_kph"),
        F.sum("precip_mm").alias("totalprecip_mm"), F.avg("humidity").alias("avghumidity"), F.count("*").alias("hours"),
    )


def air(rows: DataFrame, source: str = "openaq") -> DataFrame:
    """Text rows of air quality as typed events, with keys, times and partition columns. Blank and nan are null."""
    text = lambda c: X.clean(F.col(c))
    typed = {f.name: (X.safe_bigint(F.col(f.name)) if f.dataType.simpleString() == "bigint" else X.safe_double(F.col(f.name)) if f.dataType.simpleString() == "double" else text(f.name)) for f in schemas.AIR_EVENT if f.name in rows.columns}
    events = rows.select(*(c.alias(n) for n, c in typed.items()))
    events = events.withColumns({"source": F.lit(source), "ingest_time": X.iso_utc(F.current_timestamp()), "event_id": X.air_key(F.col("location_id"), F.col("sensor_id"), F.col("parameter"), X.blank_to_null(F.col("datetime_utc")), source)})
    events = events.withColumn("event_time", X.parse_time(F.col("datetime_utc")))
    return events.withColumns({"year": F.year("event_time"), "month": F.month("event_time"), "day": F.dayofmonth("event_time"), "hour": F.hour("event_time")})


def stations(locations: DataFrame, wanted: list[str]) -> DataFrame:
    """Rows of (location, sensor, measurement) from nested stations, of the wanted parameters, with coverage.

    locations: id, name, city, lat, lon, sensors array<struct<id, parameter, unit, hours array<struct<time, value, observed, expected>>>>.
    """
    sensor = locations.select(F.col("id").alias("location_id"), F.col("name").alias("location_name"), X.default(F.col("city"), "").alias("city"), "lat", "lon", F.explode("sensors").alias("s"))
    sensor = sensor.where(F.lower("s.parameter").isin(*wanted))
    hour = sensor.select("location_id", "location_name", "city", "lat", "lon", F.col("s.id").alias("sensor_id"), X.display_parameter(F.col("s.parameter")).alias("parameter"), F.col("s.unit").alias("unit"), F.explode("s.hours").alias("h"))
    return hour.select(*hour.columns[:-1], F.col("h.time").alias("datetime_utc"), F.col("h.value").alias("value"), X.coverage_pct(F.col("h.observed"), F.col("h.expected")).alias("coverage_pct"))


def catalogue(items: DataFrame) -> DataFrame:
    """Catalogue items with the ten fields of a record."""
    names = {"id": "Id", "name": "Name", "product_type": "ProductType", "start_time_utc": "ContentDate.Start", "end_time_utc": "ContentDate.End", "origin_date": "OriginDate", "publication_date": "PublicationDate", "online": "Online", "s3_path": "S3Path", "geofootprint": "GeoFootprint"}
    return items.select(*(F.col(c).alias(n) for n, c in names.items()))


def download_status(records: DataFrame, exists: Column, failed: Column) -> DataFrame:
    """Adds status: missing id, then offline (a null flag too), then already there, then failed or downloaded."""
    status = F.when(F.coalesce(F.col("id"), F.lit("")) == "", "skipped_missing_id").when(~F.coalesce(F.col("online"), F.lit(False)), "skipped_offline").when(exists, "skipped_exists").when(failed, "failed").otherwise("downloaded")
    return records.withColumn("status", status)


def satellite(stats: DataFrame, products: DataFrame, box: list[float], source: str = "s5p") -> DataFrame:
    """Summary events of product files: stats has product, id, start, stop, file_name and the four statistics."""
    known = stats.join(F.broadcast(products), "product")  # a fixed handful of products; unknown ones are skipped
    return known.select(
        "product", "collection", F.col("start").alias("content_start"), F.col("stop").alias("content_end"), F.array(*map(F.lit, box)).alias("bbox"), "file_name",
        F.struct("min", "max", "mean", "valid_pct").alias("stats"), "unit", X.iso_utc(F.current_timestamp()).alias("ingest_time"),
        X.product_key(F.col("product"), F.col("id"), F.col("start"), F.col("stop"), source).alias("event_id"), F.lit(source).alias("source"),
    )


def stocks(rows: DataFrame, names: dict[str, str], source: str = "file") -> DataFrame:
    """Rows of stock tables: headers renamed by names, numbers with decimal commas, days as dd/MM/yyyy, a change like -0,6(-2,44 %)."""
    rows = rows.withColumnsRenamed(names)
    change = X.change_parts(F.col("change"))
    day = X.parse_date(F.col("trade_date"), "dd/MM/yyyy")
    done = {"symbol": F.col("symbol"), "trade_date": day, "price_change": change["change"], "price_change_pct": change["pct"], "source": F.lit(source), "ingest_time": X.iso_utc(F.current_timestamp()), "event_id": F.concat(F.col("symbol"), F.lit("_"), day.cast("string"))}
    columns = []
    for f in schemas.STOCK_EVENT:
        value = done[f.name] if f.name in done else X.decimal_comma(F.col(f.name)) if f.name in rows.columns else F.lit(None)
        columns.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*columns)
