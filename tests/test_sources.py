"""Files, REST sources with a fake transport, and normalisers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from envflow.operators import normalize as N
from envflow.sources import files, rest, sinks


def hour(epoch, time, temp):
    return {"time_epoch": epoch, "time": time, "temp_c": temp, "is_day": 0, "condition": {"text": "Clear", "icon": "i", "code": 1000}, "wind_kph": 5.0, "humidity": 80, "precip_mm": 0.5}


def weather_folder(path):
    day = {"date": "2025-01-02", "date_epoch": 1735776000, "day": {"maxtemp_c": 21.0}, "hour": [hour(1735750800 + 3600 * i, f"2025-01-02 {i:02d}:00", 20.0 + i % 2) for i in range(24)]}
    (path / "Ha_Noi").mkdir(parents=True)
    good = {"location": {"name": "Hanoi", "lat": 21.0, "lon": 105.8, "tz_id": "Asia/Bangkok", "country": "Vietnam"}, "forecast": {"forecastday": [day, {"date": "2025-01-03", "hour": []}]}}
    (path / "Ha_Noi/2025-01-02.json").write_text(json.dumps(good, indent=1))
    (path / "Ha_Noi/2025-01-04.json").write_text("{broken")
    return str(path)


def test_weather(spark, tmp_path):
    raw = files.read_weather(spark, weather_folder(tmp_path) + "/*/*.json")
    events = N.weather(raw)
    assert events.count() == 24
    first = events.orderBy("time_epoch").first()
    assert first.event_id == "Ha Noi_2025-01-02 00:00" and first.province == "Ha Noi" and first.source_file == "2025-01-02.json"
    assert str(first.event_time) == "2025-01-01 17:00:00" and str(first.event_time_local) == "2025-01-02 00:00:00"
    assert (first.year, first.month, first.condition_code, first.humidity) == (2025, 1, 1000, 80)
    assert [r.source_file[-15:] for r in raw.cache().where("_corrupt_record IS NOT NULL").select("source_file").collect()] == ["2025-01-04.json"]
    day = N.daily_weather(events).first()
    assert (day.maxtemp_c, day.mintemp_c, day.hours, day.totalprecip_mm) == (21.0, 20.0, 24, 12.0)


@pytest.mark.skipif("ENVFLOW_WEATHER_DIR" not in os.environ, reason="no folder of weather files is named")
def test_weather_days_agree_with_their_summaries(spark):
    raw = files.read_weather(spark, os.environ["ENVFLOW_WEATHER_DIR"] + "/*/*.json").cache()
    events = N.weather(raw)
    assert events.count() == 792
    given = raw.select(F.regexp_replace(F.element_at(F.split("source_file", "/"), -2), "_", " ").alias("province"), F.explode("forecast.forecastday").alias("d")).select("province", F.to_date("d.date").alias("query_date"), "d.day.*")
    both = N.daily_weather(events).alias("a").join(given.alias("b"), ["province", "query_date"])
    wrong = both.where("a.maxtemp_c <> b.maxtemp_c OR a.mintemp_c <> b.mintemp_c OR abs(a.avgtemp_c - b.avgtemp_c) > 0.06 OR a.maxwind_kph <> b.maxwind_kph")
    assert (both.count(), wrong.count()) == (33, 0)


def test_air(spark, tmp_path):
    head = "location_id,location_name,city,latitude,longitude,provider,sensor_id,parameter,unit,datetime_utc,datetime_local,value,min,max,sd,expected_count,observed_count,coverage_pct"
    lines = [head, "1,A,,21.0,105.8,p,7,PM2.5,ug,2026-03-28T10:00:00+00:00,x,12.5,nan,13,,24.0,20,83.3", "2,B,Hue,nan,1,p,8,CO,ppm,nan,x,bad,1,2,3,,,", "3,C,Hue,1,1,p,9,CO,ppm,2026-03-28 23:30:00+00:00,x,1,1,2,3,0,0,0"]
    (tmp_path / "a.csv").write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    got = {r.location_id: r for r in N.air(files.read_air(spark, str(tmp_path))).collect()}
    assert got[1].event_id == "openaq_1_7_PM2.5_2026-03-28T10:00:00+00:00" and (got[1].expected_count, got[1].min, got[1].hour) == (24, None, 10)
    assert got[2].event_id is None and got[2].event_time is None and got[2].value is None and got[2].latitude is None
    assert (got[3].day, got[3].hour) == (28, 23)


def test_stations(spark):
    rows = [(1, "A", None, 1.0, 2.0, [(5, "PM25", "ug", [("t", 3.0, 20, 24), ("u", 4.0, 1, 0)]), (6, "temperature", "c", [("t", 1.0, 1, 1)])])]
    schema = "id int, name string, city string, lat double, lon double, sensors array<struct<id int, parameter string, unit string, hours array<struct<time string, value double, observed int, expected int>>>>"
    got = N.stations(spark.createDataFrame(rows, schema), ["pm25"]).select("city", "parameter", "value", "coverage_pct").orderBy("value").collect()
    assert [tuple(r) for r in got] == [("", "PM2.5", 3.0, 83.3), ("", "PM2.5", 4.0, 100.0)]


def test_catalogue_and_status(spark):
    items = spark.read.json(spark.sparkContext.parallelize(['{"Id":"1","Name":"n","ContentDate":{"Start":"s","End":"e"},"Online":true}', '{"Id":"","Online":true}', '{"Id":"3","Online":null}']), schema="Id STRING, Name STRING, ProductType STRING, ContentDate STRUCT<Start: STRING, End: STRING>, OriginDate STRING, PublicationDate STRING, Online BOOLEAN, S3Path STRING, GeoFootprint STRING")
    got = N.download_status(N.catalogue(items), F.lit(False), F.lit(False)).orderBy("id").select("id", "start_time_utc", "status").collect()
    assert [tuple(r) for r in got] == [("", None, "skipped_missing_id"), ("1", "s", "downloaded"), ("3", None, "skipped_offline")]


def test_stocks(spark):
    got = N.stocks(spark.createDataFrame([("VCB", "02/03/2026", "23,95", "-0,6(-2,44 %)")], "ma string, ngay string, gia string, thay string"), {"ma": "symbol", "ngay": "trade_date", "gia": "close_price", "thay": "change"}).first()
    assert (got.event_id, got.close_price, got.price_change, got.price_change_pct, got.open_price) == ("VCB_2026-03-02", 23.95, -0.6, -2.44, None)


def test_rest_pages_in_spark(spark):
    def fake(url, params):
        page = params.get("page", 1)
        rows = [{"id": f"{url}-{i}"} for i in range((page - 1) * 2, min(page * 2, 5))]
        return 200, {}, {"results": rows, "meta": {"found": ">5"}}

    walk = lambda url, params: rest.pages(fake, url, params, size=2)
    got = rest.read_rest(spark, [("a", {}, "x"), ("b", {}, "y")], walk).select("tag", F.get_json_object("body", "$.id").alias("id")).collect()
    assert sorted(map(tuple, got)) == [(t, f"{u}-{i}") for t, u in (("x", "a"), ("y", "b")) for i in range(5)]


def test_weather_by_rest(spark):
    def fake(url, params):
        if params["dt"] == "2025-01-02" and params["q"] == "Hue":
            return 500, {}, None
        return 200, {}, {"location": {"name": params["q"]}, "forecast": {"forecastday": [{"date": params["dt"], "hour": [{"time": params["dt"] + " 00:00", "time_epoch": 1, "temp_c": 20.5}]}]}}

    targets = rest.day_targets("u", ["Ha Noi", "Hue"], "2025-01-01", "2025-01-02", "key")
    assert len(targets) == 4 and len(rest.day_targets("u", ["a"], "2025-01-01", "2025-01-05", "key", 2)) == 2
    answers = rest.read_rest(spark, targets, rest.one_body(fake, rest.Policy(tries=1)))
    assert [(r.tag, r.body, "500" in r.error) for r in answers.where("error IS NOT NULL").collect()] == [("Hue", None, True)]
    got = sorted((r.event_id, r.temp_c) for r in N.weather(N.weather_bodies(answers), "api").collect())
    assert got == [("Ha Noi_2025-01-01 00:00", 20.5), ("Ha Noi_2025-01-02 00:00", 20.5), ("Hue_2025-01-01 00:00", 20.5)]


QUICK = rest.Policy(tries=3, first=0.0, wait=lambda s: None)


def test_download(spark, tmp_path):
    def fetch(base, id_):
        if id_ == "no" or id_ == "other" and base == "first":
            raise PermissionError("403")
        if base == "first" and id_ != "cut" or id_ == "bad":
            raise OSError("timeout")
        if id_ == "cut" and base == "first":
            return (piece for piece in [b"half", None])  # a transfer that breaks off within the content
        return iter([base.encode(), b":", id_.encode()])

    rows = [("1", "a b.nc", "NO2", True), ("2", "c", "NO2", False), ("", "d", "NO2", True), ("no", "e", "CO", True), ("bad", "f", "CO", True), ("3", "g", "CO", None), ("4", "a b.nc", "NO2", True), ("other", "h", "CO", True)]
    records = spark.createDataFrame(rows, "id string, name string, product_type string, online boolean").coalesce(1)
    report = lambda: {r.id: (r.status, r.error) for r in rest.download(records, fetch, ["first", "second"], f"file://{tmp_path}/d", QUICK).collect()}
    want = {"1": ("downloaded", None), "2": ("skipped_offline", None), "": ("skipped_missing_id", None), "no": ("failed", "403"), "bad": ("failed", "timeout"), "3": ("skipped_offline", None), "4": ("downloaded", None), "other": ("downloaded", None)}
    assert report() == want
    # products of one name have files of their own, and nothing is left of what failed
    assert {f.name: f.read_bytes() for f in (tmp_path / "d").iterdir()} == {"1_a_b.nc": b"second:1", "4_a_b.nc": b"second:4", "other_h": b"second:other"}
    assert report()["1"] == ("skipped_exists", None)


def test_a_broken_transfer_leaves_no_file(spark, tmp_path):
    def fetch(base, id_):
        yield b"half"
        if base == "first":
            raise OSError("cut off")
        yield b" and half"

    records = spark.createDataFrame([("1", "a", "NO2", True)], "id string, name string, product_type string, online boolean")
    assert [r.status for r in rest.download(records, fetch, ["first"], str(tmp_path / "x"), QUICK).collect()] == ["failed"]
    assert list((tmp_path / "x").iterdir()) == []
    assert [r.status for r in rest.download(records, fetch, ["first", "second"], str(tmp_path / "x"), QUICK).collect()] == ["downloaded"]
    assert (tmp_path / "x/1_a").read_bytes() == b"half and half"


def test_a_cap_on_downloads_counts_successes(spark, tmp_path):
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetch(base, id_):
        (asked / id_).touch()
        if int(id_) % 3 == 0:
            raise PermissionError("403")
        return b"x"

    rows = [(f"{i:03d}", None, "NO2", i % 10 != 5) for i in range(60)] + [(None, "n", "NO2", True)]
    records = spark.createDataFrame(rows, "id string, name string, product_type string, online boolean").repartition(4)
    (tmp_path / "d").mkdir()
    (tmp_path / "d/001").write_bytes(b"there")
    got = rest.download(records, fetch, ["b"], str(tmp_path / "d"), QUICK, most=8).collect()
    status = {r.id: r.status for r in got}
    assert sum(s == "downloaded" for s in status.values()) == 8 and status["001"] == "skipped_exists" and status[None] == "skipped_missing_id" and status["005"] == "skipped_offline"
    tried = sorted(int(f.name) for f in asked.iterdir())
    want, left = [], 8
    for i in range(60):
        if left and i % 10 != 5 and i != 1:
            want.append(i)
            left -= i % 3 != 0
    assert tried == want and len(got) == len(want) + 6 + 2


def test_answers_that_are_no_json_and_broken_transfers(spark):
    import http.client
    import json

    seen = []

    def odd(url, params):
        seen.append(url)
        turn = len(seen)
        if turn == 1:
            raise http.client.IncompleteRead(b"half")
        if turn == 2:
            json.loads("<html>busy</html>")
        if turn == 3:
            raise ConnectionResetError("reset")
        return 200, {}, {"results": [1]}

    assert rest.ask(odd, "u", {}, rest.Policy(tries=4, wait=lambda s: None)) == {"results": [1]} and len(seen) == 4

    def by_target(url, params):
        if url == "html":
            json.loads("<html>")
        if url == "cut":
            raise http.client.IncompleteRead(b"")
        if url == "odd":
            return 200, {}, ["not", "an", "object"]
        return 200, {}, {"results": [{"v": 1}], "meta": {"found": 1}}

    policy = rest.Policy(tries=2, wait=lambda s: None)
    walk = lambda url, params: rest.pages(by_target, url, params, 10, policy)
    got = {r.tag: (r.body, r.error) for r in rest.read_rest(spark, [(t, {}, t) for t in ("html", "cut", "odd", "good")], walk).collect()}
    assert got["good"] == ('{"v": 1}', None) and all(got[t][0] is None and got[t][1] for t in ("html", "cut", "odd"))
    assert "JSONDecodeError" in got["html"][1] and "IncompleteRead" in got["cut"][1] and "AttributeError" in got["odd"][1]


def test_http_answers(tmp_path):
    """The real transport against a server that answers with JSON, HTML, an error and half a file."""
    import http.server
    import threading

    class Answers(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            status, body, length = {"/json": (200, b'{"a": 1}', 8), "/html": (200, b"<html>", 6), "/none": (404, b"", 0), "/no": (403, b"", 0), "/half": (200, b"x" * 10, 3_000_000), "/file": (200, b"y" * 3_000_000, 3_000_000)}[self.path.split("?")[0]]
            self.send_response(status)
            self.send_header("Content-Length", str(length))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    once = rest.Policy(tries=1)
    try:
        assert rest.ask(rest.http_get, f"{base}/json", {"q": "1"}, once) == {"a": 1} and rest.ask(rest.http_get, f"{base}/none", {}, once) is None
        for path, kind in (("html", OSError), ("no", rest.Refused)):
            with pytest.raises(kind):
                rest.ask(rest.http_get, f"{base}/{path}", {}, once)
        pieces = list(rest.http_pieces(f"{base}/file", {}))
        assert sum(map(len, pieces)) == 3_000_000 and max(map(len, pieces)) <= rest.PIECE
        for path, kind in (("no", PermissionError), ("half", OSError), ("none", OSError)):
            with pytest.raises(kind):
                list(rest.http_pieces(f"{base}/{path}", {}))
    finally:
        server.shutdown()


def test_policy_of_tries():
    waits = []
    policy = rest.Policy(tries=4, first=2.0, longest=5.0, wait=waits.append, clock=lambda: sum(waits), jitter=lambda: 1.0)
    answers = [(429, {"Retry-After": "7"}, None), (503, {}, None), (500, {}, None), (200, {}, {"results": []})]
    assert rest.ask(lambda u, p: answers.pop(0), "u", {}, policy) == {"results": []} and waits == [7.0, 4.0, 5.0]
    assert rest.ask(lambda u, p: (404, {}, None), "u", {}, policy) is None
    tried = []
    with pytest.raises(rest.Refused):
        rest.ask(lambda u, p: tried.append(u) or (403, {}, None), "u", {}, policy)
    assert tried == ["u"]
    waits.clear()
    with pytest.raises(OSError):
        rest.ask(lambda u, p: (503, {}, None), "u", {}, rest.Policy(deadline=5.0, wait=waits.append, clock=lambda: sum(waits), jitter=lambda: 1.0))
    assert waits == [1.0, 2.0]


@pytest.mark.parametrize("found", [0, -1, None, ">5", "5", 5, 50])
def test_pages_end_where_the_results_do(found):
    asked = []

    def fake(url, params):
        asked.append(params["page"])
        return 200, {}, {"results": list(range(5))[(params["page"] - 1) * 2 : params["page"] * 2], "meta": {"found": found}}

    assert list(rest.pages(fake, "u", {}, size=2)) == [0, 1, 2, 3, 4] and asked[:3] == [1, 2, 3] and len(asked) <= 4


def test_dependent_scan(spark, tmp_path):
    """Locations lead to sensors and sensors to hours, each level dealt out anew; a location without sensors gives no row, a failed one an error."""
    from pyspark import TaskContext

    answers = {"locations": [{"id": 1}, {"id": 2}, {"id": 3}, {"id": 4}], "locations/1/sensors": [{"id": 10 + i} for i in range(20)], "locations/3/sensors": [{"id": 30}], "sensors/30/hours": [{"v": 4}]}
    answers |= {f"sensors/{10 + i}/hours": [{"v": 10 * i + j} for j in range(3)] for i in range(20)}

    def fake(url, params):
        if url.startswith("sensors/") and TaskContext.get():
            (tmp_path / f"{TaskContext.get().partitionId()}").touch()
        if url in ("locations/4/sensors", "sensors/12/hours"):
            return 500, {}, None
        rows = answers.get(url)
        return (404, {}, None) if rows is None else (200, {}, {"results": rows[(params["page"] - 1) * 2 : params["page"] * 2]})

    follow = [("sensor", lambda x: [(f"locations/{x['root']['id']}/sensors", {})]), ("hour", lambda x: [(f"sensors/{x['sensor']['id']}/hours", {})])]
    got = rest.read_dependent(spark, [("locations", {}, "t"), ("nothing", {}, "e")], follow, fake, size=2, policy=rest.Policy(tries=1))
    paths = (("l", "$.root.id"), ("s", "$.sensor.id"), ("v", "$.hour.v"))
    rows = got.select("tag", "error", *(F.get_json_object("body", p).cast("int").alias(n) for n, p in paths)).collect()
    want = [(1, 10 + i, 10 * i + j) for i in range(20) if i != 2 for j in range(3)] + [(3, 30, 4)]
    assert sorted((r.l, r.s, r.v) for r in rows if r.error is None) == want
    assert sorted(((r.l, r.s or 0) for r in rows if r.error)) == [(1, 12), (4, 0)]
    assert len(list(tmp_path.iterdir())) >= 3  # sensors of one location were asked by several tasks


def test_no_targets(spark):
    assert rest.read_rest(spark, [], rest.one_body(lambda u, p: (200, {}, {}))).collect() == []
    assert rest.read_dependent(spark, [], [("x", lambda r: [("u", {})])], lambda u, p: (200, {}, {})).collect() == []


def test_token_is_renewed():
    now, asked = [0.0], []
    token = rest.Token(lambda u, f: asked.append(f["username"]) or {"access_token": f"t{len(asked)}", "expires_in": 100}, "u", "c", "me", "pw", clock=lambda: now[0])
    assert [token(), token()] == ["t1", "t1"]
    now[0] = 71.0
    assert token() == "t2" and asked == ["me", "me"]


def test_kafka_options():
    from envflow.streaming import pipeline

    assert pipeline.kafka_options("h:1", "t", 10) == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10"}
    assert "maxOffsetsPerTrigger" not in pipeline.kafka_options("h:1", "t") and sinks.kafka_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "all", "kafka.retries": "3"}


def test_documents_and_marks(spark, tmp_path):
    df = spark.createDataFrame([("Ha Noi", "2025-01-01", 2), ("Ha Noi", "2025-01-01", 1), ("Hue", "2025-01-02", 3)], "province string, day string, v int")
    sinks.write_documents(df, f"{tmp_path}/d", ["province", "day"])
    files_ = {str(f.relative_to(tmp_path / "d").parent): json.loads(f.read_text()) for f in (tmp_path / "d").glob("*/*/*.txt")}
    assert [[x["v"] for x in v] for _, v in sorted(files_.items())] == [[1, 2], [3]]
    sinks.write_csv_with_mark(df.coalesce(1), f"{tmp_path}/c", ["province", "v"])
    assert next((tmp_path / "c").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbfprovince,v")


def test_linked_and_modes():
    pages = {"u": {"value": [1, 2], "@odata.nextLink": "v"}, "v": {"value": [3, 4]}}
    assert list(rest.linked(lambda u, p: (200, {}, pages[u]), "u", {}, 3)) == [1, 2, 3]
    assert rest.resolve_mode("auto", "k", "p", "a", "b") == "api" and rest.resolve_mode("auto", "k", None, "a", "b") == "local"
    with pytest.raises(ValueError):
        rest.check_period("2025-01-02", "2025-01-01")
    assert "contains(Name,'NO2')" in rest.catalogue_filter("S5P", "NO2", (100, 8, 110, 24), "a", "b")


def test_files_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "Hà", '{"type":"Point","coordinates":[1,2]}'), (2, None, None)], "k int, name string, geometry string")
    sinks.write_parquet(df, f"{tmp_path}/t", ["k"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    assert files.list_files(spark, f"{tmp_path}/t", "*.parquet").where("length > 0").count() == 2
    sinks.write_csv(df, f"{tmp_path}/c", ["name", "missing", "k"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/c").columns == ["name", "missing", "k"]
    sinks.write_features(df, f"{tmp_path}/g", "geometry")
    assert sorted(json.loads(r.value)["properties"]["k"] for r in spark.read.text(f"{tmp_path}/g").collect()) == [1, 2]
    (tmp_path / "b.geojson").write_text(json.dumps({"features": [{"properties": {"shapeName": "X"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]}))
    assert files.read_features(spark, f"{tmp_path}/b.geojson").first().properties["shapeName"] == "X"


def test_rasters(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"\x01\x02")
    (tmp_path / "b.bin").write_bytes(b"!")

    def decode(name, content):
        import pandas as pd

        if content == b"!":
            raise ValueError("no raster")
        yield pd.DataFrame({"product": "p", "row": 0, "col": range(len(content)), "value": [float(b) for b in content], "qa": 1.0})

    got = files.read_rasters(spark, str(tmp_path), decode, "*.bin").orderBy("col").collect()
    assert [(r.col, r.value) for r in got] == [(0, 1.0), (1, 2.0)]
    report = {r.path[-5:]: (r.cells, r.error) for r in files.raster_report(spark, str(tmp_path), decode, "*.bin").collect()}
    assert report == {"a.bin": (2, None), "b.bin": (0, "ValueError: no raster")}


def test_granules(spark, tmp_path):
    link = {"rel": "http://esipfed.org/ns/fedsearch/1.1/data#", "href": "https://a.org/x/tile-1.hdf"}
    entries = [
        {"id": "G1", "title": "t1", "dataset_id": "D", "time_start": "2025-01-01T00:00:00Z", "time_end": "2025-01-02T00:00:00Z", "links": [{"rel": "browse#", "href": "https://a.org/p.png"}, link]},
        {"id": "G2", "title": "t2", "dataset_id": "D", "links": [{**link, "inherited": True}]},
        {"id": "G3", "title": "t3"},
    ]
    asked = []

    def get(url, params):
        asked.append(params["page_num"])
        at = (params["page_num"] - 1) * params["page_size"]
        return (200, {}, {"feed": {"entry": entries[at : at + params["page_size"]]}}) if params["short_name"] == "MCD19A2" else (404, {}, None)

    params = rest.granule_query("MCD19A2", "061", (102.1, 8.4, 109.5, 23.4), "2025-01-01", "2025-01-08")
    assert params == {"short_name": "MCD19A2", "version": "061", "temporal": "2025-01-01,2025-01-08", "bounding_box": "102.1,8.4,109.5,23.4"}
    found = list(rest.granules(get, 2)("u", params))
    assert [(g["id"], g["name"], g["online"]) for g in found] == [("G1", "tile-1.hdf", True), ("G2", "t2", False), ("G3", "t3", False)] and asked == [1, 2]
    assert list(rest.granules(get, 2)("u", {"short_name": "none"})) == []
    with pytest.raises(ValueError):
        rest.granule_query("c", "1", (0, 0, 1, 1), "2025-01-08", "2025-01-01")
    body = rest.read_rest(spark, [("u", params, "aod")], rest.granules(get, 2))
    records = body.select(F.from_json("body", "id STRING, name STRING, product_type STRING, online BOOLEAN").alias("g")).select("g.*")
    report = rest.download(records, lambda base, key: f"{base}{key}".encode(), ["b:"], str(tmp_path)).collect()
    assert sorted((r.id, r.status) for r in report) == [("G1", "downloaded"), ("G2", "skipped_offline"), ("G3", "skipped_offline")]
    assert (tmp_path / "G1_tile-1.hdf").read_bytes() == b"b:G1"


def test_files_in_order_and_kinds(spark, tmp_path):
    for name in ("b/2.json", "a/9.nc", "a/10.CSV", "c.json.gz", "d"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    every = files.files_in_order(spark, str(tmp_path)).select("path", files.kind_of(F.col("path")).alias("kind")).collect()
    assert [(r.path.removeprefix(f"file:{tmp_path}/"), r.kind) for r in every] == [("a/10.CSV", "csv"), ("a/9.nc", "raster"), ("b/2.json", "json"), ("c.json.gz", "json"), ("d", None)]
    assert [r.path[-4:] for r in files.files_in_order(spark, str(tmp_path), "*.json", 1).collect()] == ["json"]
