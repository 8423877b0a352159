"""The catalogue's filters in its requests, hourly readings as a stream, and the committing sink; with transports that write down what they are asked."""

import datetime as dt
import json
import re
import subprocess
import sys
import uuid

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from envflow.sources import catalogue, hourly, messages, rest

#: The tests' transports run in workers, which can't import this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# catalogue


def item(i):
    start = dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * i)
    x, y = (i * 37) % 300 - 150, (i * 17) % 120 - 60
    ring = [[x, y], [x + 10, y], [x + 10, y + 5], [x, y + 5], [x, y]]
    return {
        "Id": f"id{i:03d}", "Name": f"{'S5P' if i % 7 else 'S2A'} {'NO2' if i % 3 else 'O3'} {i}'s", "Collection": "SENTINEL-5P" if i % 4 else "OTHER", "Online": i % 5 != 0, "ContentLength": 1000 * i,
        "ContentDate": {"Start": start.strftime("%Y-%m-%dT%H:%M:%S.000Z"), "End": (start + dt.timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M:%S.000Z")}, "GeoFootprint": {"type": "Polygon", "coordinates": [ring]},
    }


ITEMS = [item(i) for i in range(120)]


def holds(text, x):
    """Whether an item meets a filter text, by the few forms that the source writes."""
    unquote = lambda q: q[1:-1].replace("''", "'")
    for part in re.split(r" and (?=(?:[^']*'[^']*')*[^']*$)", text):
        if part.startswith("(Collection"):
            ok = any(unquote(p.split(" eq ")[1]) == x["Collection"] for p in part[1:-1].split(" or "))
        elif part.startswith("Collection/Name eq "):
            ok = unquote(part.split(" eq ", 1)[1]) == x["Collection"]
        elif m := re.fullmatch(r"(contains|startswith|endswith)\(Name,('.*')\)", part):
            ok = {"contains": lambda n, v: v in n, "startswith": str.startswith, "endswith": str.endswith}[m[1]](x["Name"], unquote(m[2]))
        elif part.startswith("Name eq "):
            ok = unquote(part[8:]) == x["Name"]
        elif part.startswith("Online eq "):
            ok = str(x["Online"]).lower() == part[10:]
        elif m := re.fullmatch(r"ContentDate/Start (ge|le) (\S+)", part):
            ok = x["ContentDate"]["Start"] >= m[2] if m[1] == "ge" else x["ContentDate"]["Start"] <= m[2]
        elif m := re.search(r"POLYGON\(\((.*)\)\)", part):
            xs, ys = zip(*(map(float, p.split()) for p in m[1].split(", ")), strict=True)
            ring = x["GeoFootprint"]["coordinates"][0]
            ok = min(p[0] for p in ring) <= max(xs) and max(p[0] for p in ring) >= min(xs) and min(p[1] for p in ring) <= max(ys) and max(p[1] for p in ring) >= min(ys)
        else:
            raise AssertionError(part)
        if not ok:
            return False
    return True


def transport(folder):
    """A catalogue in pages, which writes down each request's text, columns and number of results."""
    folder.mkdir(exist_ok=True)

    def get(url, params):
        if "skip=" in url:
            text, skip, top = json.loads(url.split("skip=")[1])
        else:
            text, skip, top = params.get("$filter", ""), 0, params["$top"]
        found = sorted((x for x in ITEMS if not text or holds(text, x)), key=lambda x: (x["ContentDate"]["Start"], x["Id"]))
        page = found[skip : skip + top]
        (folder / uuid.uuid4().hex).write_text(json.dumps([text, params.get("$select"), len(page)]))
        more = {"@odata.nextLink": "u?skip=" + json.dumps([text, skip + top, top])} if skip + top < len(found) else {}
        return 200, {}, {"value": page, **more}

    return get, lambda: [json.loads(f.read_text()) for f in folder.iterdir()]


T0, T1 = "2024-01-05 00:00:00", "2024-01-20 12:00:00"
WHERE = {
    "collection = 'SENTINEL-5P'": "Collection/Name eq 'SENTINEL-5P'",
    "collection IN ('OTHER', 'x''y')": "(Collection/Name eq 'OTHER' or Collection/Name eq 'x''y')",
    "name LIKE '%NO2%'": "contains(Name,'NO2')",
    "name LIKE 'S5P%'": "startswith(Name,'S5P')",
    "name LIKE '%9''s'": "endswith(Name,'9''s')",
    "online = true": "Online eq true",
    f"start >= TIMESTAMP '{T0}' AND start <= TIMESTAMP '{T1}'": "ContentDate/Start ge 2024-01-05T00:00:00.000Z",
    f"start > TIMESTAMP '{T0}' AND start < TIMESTAMP '{T1}'": "ContentDate/Start ge 2024-01-05T00:00:00.000Z",
    "west <= 20 AND east >= -30 AND south <= 40 AND north >= -10": "POLYGON((-30.0 -10.0, 20.0 -10.0, 20.0 40.0, -30.0 40.0, -30.0 -10.0))",
    "west <= 20 AND east >= -30": "",
    "bytes > 50000 OR online": "",
    f"collection = 'SENTINEL-5P' AND name LIKE '%O3%' AND start >= TIMESTAMP '{T0}' AND west <= 0": "Collection/Name eq 'SENTINEL-5P' and contains(Name,'O3')",
}


@pytest.fixture
def pushed(spark):
    spark.conf.set(catalogue.PUSH_DOWN, "true")
    yield
    spark.conf.set(catalogue.PUSH_DOWN, "false")


@pytest.mark.parametrize("where", WHERE)
def test_filters_reach_the_service(spark, tmp_path, pushed, where):
    get, asked = transport(tmp_path / "on")
    every, asked_every = transport(tmp_path / "off")
    got = sorted(map(str, catalogue.read_catalogue(spark, "u", get, page=7, parts=3).where(where).collect()))
    spark.conf.set(catalogue.PUSH_DOWN, "false")
    want = sorted(map(str, catalogue.read_catalogue(spark, "u", every, page=7).where(where).collect()))
    assert got == want and 0 < len(want) < len(ITEMS)
    texts = {text for text, *_ in asked()}
    assert all(WHERE[where] in t for t in texts) if WHERE[where] and "start" not in where else any(WHERE[where] in t for t in texts)
    assert {text for text, *_ in asked_every()} == {""} and sum(n for *_, n in asked_every()) == len(ITEMS)
    if WHERE[where]:
        assert sum(n for *_, n in asked()) < len(ITEMS)


def test_a_period_is_read_in_windows(spark, tmp_path, pushed):
    get, asked = transport(tmp_path / "a")
    df = catalogue.read_catalogue(spark, "u", get, columns=["id", "start"], parts=4).where(f"start >= TIMESTAMP '{T0}' AND start <= TIMESTAMP '{T1}'")
    assert df.rdd.getNumPartitions() == 4
    ids = [r.id for r in df.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {x["Id"] for x in ITEMS if "2024-01-05T00" <= x["ContentDate"]["Start"] <= "2024-01-20T12:00:00.000Z"}
    assert {select for _, select, _ in asked()} == {"ContentDate,Id"} and len({t for t, *_ in asked()}) == 4
    none = catalogue.read_catalogue(spark, "u", get).where(f"start >= TIMESTAMP '{T1}' AND start <= TIMESTAMP '{T0}'")
    assert none.collect() == []


def test_a_search_that_fails_is_told(spark):
    with pytest.raises(Exception, match="status 500"):
        catalogue.read_catalogue(spark, "u", lambda url, params: (500, {}, None), policy=rest.Policy(tries=1)).collect()


# hourly readings


def stream_of(spark, tmp_path, targets, hours, most=3):
    """A stream that writes down the hours it is asked for, with a clock that stands at so many hours after the beginning."""
    asked = tmp_path / "asked"
    asked.mkdir(exist_ok=True)
    begin = hourly.hours_since_1970("2024-01-01")

    def fetch(target, first, last):
        (asked / uuid.uuid4().hex).write_text(json.dumps([target, first - begin, last - begin]))
        for hour in range(first, last + 1):
            if target == "broken" and hour - begin == 4:
                raise OSError("no answer")
            yield hour, {"v": hour - begin}

    stream = hourly.stream_hours(spark, targets, fetch, "2024-01-01", str(tmp_path / "position"), most, clock=lambda: (begin + hours) * 3600.0 + 60)
    return stream, lambda: [json.loads(f.read_text()) for f in asked.iterdir()]


def run_until(spark, stream, tmp_path, hours):
    """Runs until every hour up to hours is there; returns the rows of each batch."""
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "data")).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()


def test_hours_are_asked_for_once_over_restarts(spark, tmp_path):
    stream, asked = stream_of(spark, tmp_path, ["a", "b"], 7)
    first = run_until(spark, stream, tmp_path, 7)
    assert first and max(first) <= 6  # three hours of two targets a batch
    for targets, hours in ((["a", "b"], 7), (["a", "b"], 12), (["a", "b", "late"], 14), (["a", "late"], 20)):
        stream, asked = stream_of(spark, tmp_path, targets, hours)
        run_until(spark, stream, tmp_path, hours)
    got = spark.read.parquet(str(tmp_path / "data")).select("target", "hour", F.get_json_object("body", "$.v").cast("int").alias("v"), "error").collect()
    read = {(r.target, r.v) for r in got}
    assert len(read) == len(got) and all(r.error is None for r in got)
    assert {v for t, v in read if t == "a"} == set(range(20)) and {v for t, v in read if t == "late"} == set(range(20)) and {v for t, v in read if t == "b"} == set(range(14))
    hours = [(t, h) for t, a, b in asked() for h in range(a, b + 1)]
    assert len(hours) == len(set(hours))


def test_hours_of_a_failed_batch_are_read_again(spark, tmp_path):
    """The sink fails once: the batch's hours come again and are stored once."""
    stream, asked = stream_of(spark, tmp_path, ["a"], 6)
    flag = tmp_path / "failed"

    def once(rows, batch):
        if batch == 1 and not flag.exists():
            rows.collect()
            flag.touch()
            raise RuntimeError("the sink fails")
        rows.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={batch}"))

    def start():
        return stream.writeStream.foreachBatch(once).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()

    query = start()
    with pytest.raises(Exception, match="the sink fails"):
        query.processAllAvailable()
    stream, asked = stream_of(spark, tmp_path, ["a"], 6)
    query = start()
    query.processAllAvailable()
    query.stop()
    got = [r.v for r in spark.read.parquet(str(tmp_path / "out")).select(F.get_json_object("body", "$.v").cast("int").alias("v")).collect()]
    assert sorted(got) == list(range(6))


def test_hours_that_fail_are_rows_with_an_error(spark, tmp_path):
    stream, _ = stream_of(spark, tmp_path, ["broken", "a"], 6, most=0)
    run_until(spark, stream, tmp_path, 6)
    got = {(r.target, r.hour.hour): r.error for r in spark.read.parquet(str(tmp_path / "data")).collect()}
    assert len(got) == 6 + 5 and [k for k, e in got.items() if e] == [("broken", 4)] and "no answer" in got["broken", 4]


# messages


def folder_at(where):
    """A receiver that keeps each message as a file; values that hold no are not acknowledged, and those that hold die end the task once."""

    class Folder(messages.Producer):
        def send(self, topic, key, value):
            import pathlib
            import uuid as ids

            root = pathlib.Path(where)
            if "die" in value and not (root / "died").exists():
                (root / "died").touch()
                raise RuntimeError("the task dies")
            if "refuse" in value:
                raise OSError("refused")
            (root / f"{topic}-{key}-{ids.uuid4().hex}").write_text(value)
            return lambda: "no" not in value

    return Folder


def receiver(tmp_path, name="received"):
    root = tmp_path / name
    root.mkdir(exist_ok=True)
    return root, folder_at(str(root))


@pytest.mark.parametrize("outstanding", [1, 1000])
def test_acknowledged_messages_are_counted(spark, tmp_path, outstanding):
    root, connect = receiver(tmp_path)
    rows = [(f"k{i}", "no" if i % 10 == 3 else "refuse" if i % 10 == 4 else f"v{i}") for i in range(200)] + [(None, "v")]
    df = spark.createDataFrame(rows, "key string, value string").repartition(5)
    told = messages.send(df, connect, "t", str(tmp_path / "log"), 7, outstanding)
    assert (told["acknowledged"], told["failed"], len(told["tasks"])) == (161, 40, 5) and len(list(root.iterdir())) == 181
    assert messages.send(df, connect, "t", str(tmp_path / "log"), 7) == told and len(list(root.iterdir())) == 181  # a batch is sent once
    empty = messages.send(df.limit(0), connect, "t", str(tmp_path / "log"), 8)
    assert (empty["acknowledged"], empty["failed"]) == (0, 0)


def test_an_aborted_job_counts_nothing(spark, tmp_path):
    root, connect = receiver(tmp_path)
    df = spark.createDataFrame([(f"k{i}", "die" if i == 150 else f"v{i}") for i in range(200)], "key string, value string").repartition(4)
    with pytest.raises(Exception, match="the task dies"):
        messages.send(df, connect, "t", str(tmp_path / "log"), "b")
    assert messages.counts(str(tmp_path / "log"), "b") is None
    again = messages.send(df, connect, "t", str(tmp_path / "log"), "b")
    assert again["acknowledged"] == 200 and len({f.name.split("-")[1] for f in root.iterdir() if f.name != "died"}) == 200


KILLED = """
import pathlib, sys
from pyspark.sql import SparkSession
sys.path[:0] = [{root!r}, {tests!r}]
from test_live_sources import folder_at
from envflow.sources import messages
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
df = spark.createDataFrame([(f"k{{i}}", "die" if i == 30 else f"v{{i}}") for i in range(60)], "key string, value string").repartition(3)
told = messages.send(df, folder_at({received!r}), "t", {log!r}, "b")
print("TOLD", told["acknowledged"], told["failed"], len(told["tasks"]))
"""


def test_a_killed_attempt_is_not_counted(tmp_path):
    """A task dies after it has sent a part of its rows; Spark runs it again, and the counts are those of the rows."""
    import pathlib

    root, _ = receiver(tmp_path)
    here = pathlib.Path(__file__).parent
    script = KILLED.format(root=str(here.parent), tests=str(here), received=str(root), log=str(tmp_path / "log"))
    ran = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=180)
    assert "TOLD 60 0 3" in ran.stdout, ran.stderr[-2000:]
    sent = [f.name.split("-")[1] for f in root.iterdir() if f.name != "died"]
    assert (root / "died").exists() and len(set(sent)) == 60 and len(sent) >= 60


def test_a_stream_of_messages_is_sent_once(spark, tmp_path):
    root, connect = receiver(tmp_path)
    kind = "key string, value string"

    def add(a, b):
        spark.createDataFrame([(f"k{i}", f"v{i}") for i in range(a, b)], kind).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema(kind).parquet(str(tmp_path / "in"))
        messages.send_stream(stream, connect, "t", str(tmp_path / "log"), str(tmp_path / "check")).awaitTermination()

    add(0, 10)
    run()
    add(10, 25)
    run()
    assert [messages.counts(str(tmp_path / "log"), b)["acknowledged"] for b in (0, 1)] == [10, 15] and len(list(root.iterdir())) == 25
    # the driver died after the batch was committed in the log of messages and before Spark's own
    for f in (tmp_path / "check/commits").iterdir():
        if f.name.startswith((".1", "1")):
            f.unlink()
    run()
    assert len(list(root.iterdir())) == 25


def test_the_stream_writer_counts_by_batch(spark, tmp_path):
    root, connect = receiver(tmp_path)
    spark.createDataFrame([(f"k{i}", f"v{i}") for i in range(30)], "key string, value string").write.parquet(str(tmp_path / "in"))
    options = messages._options(spark, connect, "t", str(tmp_path / "log"), 10)
    query = spark.readStream.schema("key string, value string").parquet(str(tmp_path / "in")).writeStream.format("envflow_messages").options(**options).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert messages.counts(str(tmp_path / "log"), 0)["acknowledged"] == 30 == len(list(root.iterdir()))
