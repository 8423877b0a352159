"""Fixed schemas of the inputs and events. All fields may be null.

They are written as DDL and parsed when they are first asked for, as parsing needs a session.
"""

from __future__ import annotations

from pyspark.sql import types as T


_DDL: dict[str, str] = {}
_CONDITION = "STRUCT<text: STRING, icon: STRING, code: BIGINT>"
_DAY = f"""STRUCT<maxtemp_c: DOUBLE, maxtemp_f: DOUBLE, mintemp_c: DOUBLE, mintemp_f: DOUBLE, avgtemp_c: DOUBLE, avgtemp_f: DOUBLE,
maxwind_mph: DOUBLE, maxwind_kph: DOUBLE, totalprecip_mm: DOUBLE, totalprecip_in: DOUBLE, totalsnow_cm: DOUBLE, avgvis_km: DOUBLE,
avgvis_miles: DOUBLE, avghumidity: BIGINT, daily_will_it_rain: BIGINT, daily_chance_of_rain: BIGINT, daily_will_it_snow: BIGINT,
daily_chance_of_snow: BIGINT, condition: {_CONDITION}, uv: DOUBLE>"""
_HOUR = f"""STRUCT<time_epoch: BIGINT, time: STRING, temp_c: DOUBLE, temp_f: DOUBLE, is_day: BIGINT, condition: {_CONDITION},
wind_mph: DOUBLE, wind_kph: DOUBLE, wind_degree: BIGINT, wind_dir: STRING, pressure_mb: DOUBLE, pressure_in: DOUBLE,
precip_mm: DOUBLE, precip_in: DOUBLE, snow_cm: DOUBLE, humidity: BIGINT, cloud: BIGINT, feelslike_c: DOUBLE, feelslike_f: DOUBLE,
windchill_c: DOUBLE, windchill_f: DOUBLE, heatindex_c: DOUBLE, heatindex_f: DOUBLE, dewpoint_c: DOUBLE, dewpoint_f: DOUBLE,
will_it_rain: BIGINT, chance_of_rain: BIGINT, will_it_snow: BIGINT, chance_of_snow: BIGINT, vis_km: DOUBLE, vis_miles: DOUBLE,
gust_mph: DOUBLE, gust_kph: DOUBLE, uv: DOUBLE>"""

#: A day of weather as delivered: one location, its forecast days, each with its hours.
_DDL["WEATHER_FILE"] = (f"""location STRUCT<name: STRING, region: STRING, country: STRING, lat: DOUBLE, lon: DOUBLE, tz_id: STRING,
localtime_epoch: BIGINT, localtime: STRING>, forecast STRUCT<forecastday: ARRAY<STRUCT<date: STRING, date_epoch: BIGINT,
day: {_DAY}, hour: ARRAY<{_HOUR}>>>>, _corrupt_record STRING""")

#: An hour of weather, flat: 48 fields.
_DDL["WEATHER_EVENT"] = ("""event_id STRING, province STRING, country STRING, region STRING, location_name STRING, lat DOUBLE, lon DOUBLE,
tz_id STRING, query_date STRING, time STRING, time_epoch BIGINT, is_day INT, temp_c DOUBLE, temp_f DOUBLE, feelslike_c DOUBLE,
feelslike_f DOUBLE, windchill_c DOUBLE, windchill_f DOUBLE, heatindex_c DOUBLE, heatindex_f DOUBLE, dewpoint_c DOUBLE,
dewpoint_f DOUBLE, condition_text STRING, condition_code INT, condition_icon STRING, wind_mph DOUBLE, wind_kph DOUBLE,
wind_degree INT, wind_dir STRING, gust_mph DOUBLE, gust_kph DOUBLE, pressure_mb DOUBLE, pressure_in DOUBLE, precip_mm DOUBLE,
precip_in DOUBLE, snow_cm DOUBLE, humidity INT, cloud INT, vis_km DOUBLE, vis_miles DOUBLE, uv DOUBLE, will_it_rain INT,
chance_of_rain INT, will_it_snow INT, chance_of_snow INT, source STRING, source_file STRING, ingest_time STRING""")

#: A row of an air-quality file, as text: the typed columns come from normalize.
_DDL["AIR_FILE"] = ("""location_id STRING, location_name STRING, city STRING, latitude STRING, longitude STRING, provider STRING,
sensor_id STRING, parameter STRING, unit STRING, datetime_utc STRING, datetime_local STRING, value STRING, min STRING, max STRING,
sd STRING, expected_count STRING, observed_count STRING, coverage_pct STRING""")

_DDL["AIR_EVENT"] = ("""location_id BIGINT, location_name STRING, city STRING, latitude DOUBLE, longitude DOUBLE, provider STRING,
sensor_id BIGINT, parameter STRING, unit STRING, datetime_utc STRING, datetime_local STRING, value DOUBLE, min DOUBLE, max DOUBLE,
sd DOUBLE, expected_count BIGINT, observed_count BIGINT, coverage_pct DOUBLE, source STRING, ingest_time STRING, event_id STRING""")

_DDL["SATELLITE_EVENT"] = ("""product STRING, collection STRING, content_start STRING, content_end STRING, bbox ARRAY<DOUBLE>,
file_name STRING, stats STRUCT<min: DOUBLE, max: DOUBLE, mean: DOUBLE, valid_pct: DOUBLE>, unit STRING, ingest_time STRING,
event_id STRING, source STRING""")

_DDL["CATALOGUE_ITEM"] = ("""Id STRING, Name STRING, ProductType STRING, ContentDate STRUCT<Start: STRING, End: STRING>, OriginDate STRING,
PublicationDate STRING, Online BOOLEAN, S3Path STRING, GeoFootprint STRING""")

_DDL["STOCK_EVENT"] = ("""symbol STRING, trade_date DATE, adjusted_close DOUBLE, close_price DOUBLE, price_change DOUBLE,
price_change_pct DOUBLE, matched_volume BIGINT, matched_value BIGINT, negotiated_volume BIGINT, negotiated_value BIGINT,
open_price DOUBLE, high_price DOUBLE, low_price DOUBLE, source STRING, ingest_time STRING, event_id STRING""")

_DDL["CELLS"] = ("product STRING, row INT, col INT, value DOUBLE, qa DOUBLE")

_DDL["SATELLITE_PRODUCTS"] = "product STRING, collection STRING, type_filter STRING, variable STRING, grp STRING, unit STRING"


def __getattr__(name: str) -> T.StructType:
    if name not in _DDL:
        raise AttributeError(name)
    return T.StructType.fromDDL(" ".join(_DDL[name].split()))
