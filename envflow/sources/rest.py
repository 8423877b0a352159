"""REST sources as Spark data sources: a partition per request target, pages and retries within it.

The transport is injected: a function (url, params) -> (status, headers, body as Python object). Credentials come from
the caller, who takes them from the environment; nothing here has a default for them.
"""

from __future__ import annotations

import json
import random
import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from http.client import HTTPException
from typing import NamedTuple
from urllib import error, parse, request

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from envflow.shared import written

Transport = Callable[[str, dict], tuple[int, dict, object]]


def http_get(url: str, params: dict, timeout: float = 30.0) -> tuple[int, dict, object]:
    full = f"{url}?{parse.urlencode(params)}" if params else url
    try:
        with request.urlopen(full, timeout=timeout) as answer:
            return answer.status, dict(answer.headers), json.loads(answer.read())
    except error.HTTPError as e:
        return e.code, dict(e.headers or {}), None


class Refused(OSError):
    """An answer that another try would not change."""


@dataclass(frozen=True)
class Policy:
    """How long a request is tried: pauses double up to a bound, with jitter, unless the server names one, until a deadline."""

    tries: int = 5
    first: float = 1.0
    longest: float = 60.0
    deadline: float = 300.0
    wait: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    jitter: Callable[[], float] = random.random

    def pause(self, turn: int, headers: dict) -> float:
        named = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
        return float(named) if str(named).isdigit() else min(self.longest, self.first * 2**turn) * (0.5 + self.jitter() / 2)


#: Answers that tell of a passing trouble, beside those from 500 on; and those that tell that there is nothing.
PASSING, ABSENT = {408, 425, 429}, {404, 410}


def ask(get: Transport, url: str, params: dict, policy: Policy = Policy()) -> object | None:
    """The body of an answer, or None where there is nothing at the address. Raises Refused, or OSError when the policy ends.

    A transfer that breaks off and an answer that is no JSON are passing troubles, as servers under load give both.
    """
    began, last = policy.clock(), "no try"
    for turn in range(policy.tries):
        headers: dict = {}
        try:
            status, headers, body = get(url, params)
        except (OSError, HTTPException, ValueError) as e:
            last = f"{type(e).__name__}: {e}"
        else:
            if 200 <= status < 300:
                return body
            if status in ABSENT:
                return None
            if status not in PASSING and status < 500:
                raise Refused(f"{url}: status {status}")
            last = f"status {status}"
        pause = policy.pause(turn, headers or {})
        if turn + 1 == policy.tries or policy.clock() - began + pause > policy.deadline:
            break
        policy.wait(pause)
    raise OSError(f"{url}: {last}")


class Scan(NamedTuple):
    """The state of a paged scan: the page to ask for and the results seen before it; page None is the end."""

    page: int | None = 1
    seen: int = 0

    def after(self, rows: int, total: object, size: int) -> Scan:
        """The next state. A total that is no positive number is unknown; then a page that isn't full is the last."""
        known = int(total) if str(total).isdigit() and int(total) > 0 else None
        seen = self.seen + rows
        more = rows > 0 and (seen < known if known is not None else rows >= size)
        return Scan(self.page + 1 if more else None, seen)


def pages(get: Transport, url: str, params: dict, size: int = 1000, policy: Policy = Policy()) -> Iterator[dict]:
    """The results of all pages, in order."""
    state = Scan()
    while state.page is not None:
        body = ask(get, url, {**params, "page": state.page, "limit": size}, policy) or {}
        rows = body.get("results") or []
        yield from rows
        state = state.after(len(rows), (body.get("meta") or {}).get("found"), size)


def linked(get: Transport, url: str, params: dict, most: int = 0, policy: Policy = Policy()) -> Iterator[dict]:
    """Results of a catalogue that gives the next page's address, most of them at most, or all for 0."""
    seen = 0
    while url and (not most or seen < most):
        body = ask(get, url, params, policy) or {}
        for row in (body.get("value") or [])[: most - seen if most else None]:
            seen += 1
            yield row
        url, params = body.get("@odata.nextLink"), {}


def granule_query(collection: str, version: str, box: Sequence[float], start: str, end: str) -> dict:
    """The parameters of a search for granules of a collection in a period that meet a box (west, south, east, north)."""
    check_period(start, end)
    return {"short_name": collection, "version": version, "temporal": f"{start},{end}", "bounding_box": ",".join(map(str, box))}


def granules(get: Transport, size: int = 2000, policy: Policy = Policy()) -> Callable[[str, dict], Iterator[dict]]:
    """A walk over all pages of a granule search (answers with feed.entry), as records that download takes, with href.

    href is the address of a granule's data; one that has none is not online. No answer, or one without entries, is no granule.
    """

    def record(entry: dict) -> dict:
        data = [x["href"] for x in entry.get("links") or [] if str(x.get("rel", "")).endswith("/data#") and not x.get("inherited") and x.get("href")]
        name = data[0].rpartition("/")[2] if data else entry.get("title")
        return {"id": entry.get("id"), "name": name, "product_type": entry.get("dataset_id"), "start_time_utc": entry.get("time_start"), "end_time_utc": entry.get("time_end"), "online": bool(data), "href": data[0] if data else None}

    def walk(url: str, params: dict) -> Iterator[dict]:
        state = Scan()
        while state.page is not None:
            body = ask(get, url, {**params, "page_num": state.page, "page_size": size}, policy) or {}
            rows = (body.get("feed") or {}).get("entry") or []
            yield from map(record, rows)
            state = state.after(len(rows), None, size)

    return walk


def catalogue_filter(collection: str, name_part: str | None, box: Sequence[float], start: str, end: str) -> str:
    """The filter text of a catalogue search: collection, part of the name, area and period."""
    x0, y0, x1, y1 = box
    ring = f"POLYGON(({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"
    parts = [f"Collection/Name eq '{collection}'"]
    parts += [f"contains(Name,'{name_part}')"] if name_part else []
    parts += [f"OData.CSC.Intersects(area=geography'SRID=4326;{ring}')", f"ContentDate/Start ge {start}", f"ContentDate/Start le {end}"]
    return " and ".join(parts)


def day_targets(url: str, places: Sequence[str], first: str, last: str, key: str, most: int = 0) -> list[tuple[str, dict, str]]:
    """A request target for every place and day, places first; the first most of them, or all for 0."""
    check_period(first, last)
    days = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    every = [(url, {"key": key, "q": place, "dt": str(date.fromisoformat(first) + timedelta(days=i))}, place) for place in places for i in range(days)]
    return every[:most] if most else every


def one_body(get: Transport, policy: Policy = Policy()) -> Callable[[str, dict], Iterator[dict]]:
    """A walk over a single answer; none where there is nothing at the address."""

    def walk(url: str, params: dict) -> Iterator[dict]:
        body = ask(get, url, params, policy)
        if body:
            yield body

    return walk


class Token:
    """A token by password grant, asked for when it is first needed and again shortly before it ends.

    The caller takes the credentials from the environment.
    """

    def __init__(self, post: Callable[[str, dict], dict], url: str, client: str, user: str, password: str, margin: float = 30.0, clock: Callable[[], float] = time.monotonic):
        self.post, self.url, self.margin, self.clock = post, url, margin, clock
        self.form = {"client_id": client, "grant_type": "password", "username": user, "password": password}
        self.value, self.ends = None, 0.0

    def __call__(self) -> str:
        if self.value is None or self.clock() >= self.ends - self.margin:
            answer = self.post(self.url, self.form)
            self.value, self.ends = answer["access_token"], self.clock() + float(answer.get("expires_in") or 300)
        return self.value


REPORT = "id STRING, name STRING, product_type STRING, status STRING, file_path STRING, error STRING"


#: Bytes of a download that are in memory at a time.
PIECE = 1 << 20


def http_pieces(url: str, headers: dict[str, str], timeout: float = 60.0, size: int = PIECE) -> Iterator[bytes]:
    """The content at an address in pieces. Raises PermissionError for 401 and 403, and OSError for other trouble, a broken transfer too."""
    try:
        with request.urlopen(request.Request(url, headers=headers), timeout=timeout) as answer:
            announced, got = answer.headers.get("Content-Length"), 0
            while piece := answer.read(size):
                got += len(piece)
                yield piece
            if announced and got != int(announced):  # reading by pieces, a transfer that is cut off just ends
                raise OSError(f"{url}: {got} of {announced} bytes")
    except error.HTTPError as e:
        raise (PermissionError if e.code in (401, 403) else OSError)(f"{url}: status {e.code}") from e
    except HTTPException as e:
        raise OSError(f"{url}: {type(e).__name__}") from e


def file_name(id_: str, name: str | None) -> str:
    """A file's name from a product's id and name; products of one name have different files."""
    clean = lambda text: re.sub(r"[^\w\-.]", "_", text)
    return f"{clean(id_)}_{clean(name)}" if name else clean(id_)


def download(records: DataFrame, fetch: Callable[[str, str], bytes | Iterator[bytes]], bases: Sequence[str], folder: str, policy: Policy = Policy(tries=3, first=2.0), most: int = 0) -> DataFrame:
    """A report (REPORT) on records (id, name, product_type, online), whose files are fetched by the tasks that hold them.

    fetch(base, id) gives a file's content, whole or in pieces. Where it raises PermissionError the base refuses, and the next one is
    asked; a base that refused isn't asked again for the file, and when all refuse the file has failed. Where it raises OSError the next base is asked,
    and after a pause all of them again, as policy says. A file that is there is not fetched again, and a file gets its name only when it is
    whole. folder is one that all executors share. With most, no more than so many files are downloaded, those with the smallest ids that succeed:
    records are tried in waves of as many as are still wanted, each wave by many tasks, and records that no wave came to are not in the report.
    """

    def attempt(store, path: str, id_: str) -> str | None:
        """The last trouble, or None when the file is there."""
        left, last, began = list(bases), "no base", policy.clock()
        for turn in range(policy.tries):
            for base in list(left):
                try:
                    store.put(path, fetch(base, id_))
                    return None
                except PermissionError as e:
                    left.remove(base)
                    last = str(e) or "refused"
                except (OSError, HTTPException) as e:
                    last = str(e) or type(e).__name__
            pause = policy.pause(turn, {})
            if not left or turn + 1 == policy.tries or policy.clock() - began + pause > policy.deadline:
                break
            policy.wait(pause)
        return last

    def known(store, row) -> tuple[str | None, str | None]:
        """(status, path) of what needs no request; a status of None needs one."""
        if not row["id"]:
            return "skipped_missing_id", None
        path = f"{folder}/{file_name(row['id'], row['name'])}"
        if not row["online"]:
            return "skipped_offline", None
        return ("skipped_exists" if store.exists(path) else None), path

    def reported(ask_: bool):
        def run(frames):
            import pandas as pd

            store = Store()
            for frame in frames:
                out = []
                for row in frame.to_dict("records"):
                    status, path = known(store, row)
                    trouble = None
                    if status is None and ask_:
                        trouble = attempt(store, path, row["id"])
                        status, path = ("failed", None) if trouble is not None else ("downloaded", path)
                    out.append((row["id"], row["name"], row["product_type"], status, path, trouble))
                yield pd.DataFrame(out, columns=["id", "name", "product_type", "status", "file_path", "error"]).astype(object)

        return run

    wanted = records.select("id", "name", "product_type", "online")
    if not most:
        return wanted.mapInPandas(reported(True), REPORT)
    first = written(wanted.mapInPandas(reported(False), REPORT), "download")
    open_, done, left, last = first.where("status IS NULL").select("id", "name", "product_type", F.lit(True).alias("online")), first.where("status IS NOT NULL"), most, None
    while left > 0:
        wave = (open_ if last is None else open_.where(F.col("id") > last)).orderBy("id").limit(left)
        wave = written(wave.repartition(max(1, min(left, records.sparkSession.sparkContext.defaultParallelism))).mapInPandas(reported(True), REPORT), "download")
        n, got, last = wave.agg(F.count("*"), F.count_if(F.col("status") == "downloaded"), F.max("id")).first()
        if not n:
            break
        done, left = done.unionByName(wave), left - got
    return done


class Store:
    """Files of a shared folder, local or whatever pyarrow's file systems reach."""

    @staticmethod
    def _of(uri: str):
        from pyarrow import fs

        parts = parse.urlsplit(uri)
        if parts.scheme in ("", "file"):
            return fs.LocalFileSystem(), parts.path
        known = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "gcs": "gs"}.get(parts.scheme, parts.scheme)
        return fs.FileSystem.from_uri(uri.replace(f"{parts.scheme}:", f"{known}:", 1))

    def exists(self, uri: str) -> bool:
        from pyarrow import fs

        store, path = self._of(uri)
        return store.get_file_info(path).type == fs.FileType.File

    def put(self, uri: str, content: bytes | Iterator[bytes]) -> None:
        """Writes a file whole or not at all; content may come in pieces, of which one is in memory at a time."""
        store, path = self._of(uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        part = f"{path}.{uuid.uuid4().hex}"
        try:
            with store.open_output_stream(part, compression=None) as out:
                for piece in [content] if isinstance(content, bytes) else content:
                    out.write(piece)
        except BaseException:
            store.delete_file(part)
            raise
        store.move(part, path)

    def get(self, uri: str) -> bytes | None:
        """A small file's content; None where there is none."""
        if not self.exists(uri):
            return None
        store, path = self._of(uri)
        with store.open_input_stream(path, compression=None) as file:
            return file.read()


class Target(InputPartition):
    """One request target: its address, parameters and a tag that its rows carry."""

    def __init__(self, url: str, params: dict, tag: str):
        super().__init__(url)
        self.url, self.params, self.tag = url, params, tag


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.targets, self.walk = cloudpickle.loads(bytes.fromhex(options["plan"]))

    def partitions(self) -> list[Target]:
        return [Target(*t) for t in self.targets]

    def read(self, partition: Target | None) -> Iterator[tuple]:
        if partition is None:  # Spark's stand-in for no targets
            return
        try:
            for row in self.walk(partition.url, partition.params):
                yield partition.tag, json.dumps(row, ensure_ascii=False), None
        except Exception as e:  # whatever it is, it is the target's last row: what is missing can be told from what is empty, and other targets go on
            yield partition.tag, None, f"{type(e).__name__}: {e}"


class RestSource(DataSource):
    """(tag, body, error): each result as JSON text, to be parsed with a schema; a target that failed ends with an error."""

    @classmethod
    def name(cls) -> str:
        return "envflow_rest"

    def schema(self) -> str:
        return "tag STRING, body STRING, error STRING"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def read_rest(spark: SparkSession, targets: Sequence[tuple[str, dict, str]], walk: Callable[[str, dict], Iterator[dict]]) -> DataFrame:
    """Rows of walk(url, params) for every target (url, params, tag), a task for each."""
    spark.dataSource.register(RestSource)
    return spark.read.format("envflow_rest").option("plan", cloudpickle.dumps((list(targets), walk)).hex()).load()


def read_dependent(spark: SparkSession, targets: Sequence[tuple[str, dict, str]], follow: Sequence[tuple[str, Callable[[dict], Iterator[tuple[str, dict]]]]], get: Transport, size: int = 1000, policy: Policy = Policy()) -> DataFrame:
    """(tag, body, error) of a scan whose results lead to further requests: (name, requests) for each level below the targets.

    requests gives the addresses and parameters that a result leads to, from the results so far by their names ("root" is the first). A body
    holds one result of every level; a level without results gives no row. Each level is a stage: its requests are dealt out over all tasks one
    by one, so the sensors of one location don't wait for one another. A request that fails is one row with an error, and the body so far.
    """
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = read_rest(spark, targets, lambda url, params: ({"root": row} for row in pages(get, url, params, size, policy)))
    failed = found.where("error IS NOT NULL")
    found = found.where("error IS NULL").select("tag", "body")

    def asked(requests):
        def run(frames):
            import pandas as pd

            for frame in frames:
                for tag, body in zip(frame["tag"], frame["body"], strict=True):
                    out = [(tag, body, url, json.dumps(params)) for url, params in requests(json.loads(body))]
                    if out:
                        yield pd.DataFrame(out, columns=["tag", "body", "url", "params"])

        return run

    def answered(name):
        def run(frames):
            import pandas as pd

            def frame_of(rows):
                return pd.DataFrame(rows, columns=["tag", "body", "error"]).astype(object)

            for frame in frames:
                for tag, body, url, params in frame[["tag", "body", "url", "params"]].itertuples(index=False):
                    rows, so_far = [], json.loads(body)
                    try:
                        for row in pages(get, url, json.loads(params), size, policy):
                            rows.append((tag, json.dumps({**so_far, name: row}, ensure_ascii=False), None))
                            if len(rows) >= 1000:
                                yield frame_of(rows)
                                rows = []
                    except Exception as e:  # noqa: BLE001  as in _Reader.read
                        rows.append((tag, body, f"{type(e).__name__}: {e}"))
                    if rows:
                        yield frame_of(rows)

        return run

    for name, requests in follow:
        dealt = found.mapInPandas(asked(requests), "tag STRING, body STRING, url STRING, params STRING").repartition(parts, F.xxhash64("url", "params", "body"))
        answers = written(dealt.mapInPandas(answered(name), "tag STRING, body STRING, error STRING"), "dependent")
        failed = failed.unionByName(answers.where("error IS NOT NULL"))
        found = answers.where("error IS NULL").select("tag", "body")
    return found.withColumn("error", F.lit(None).cast("string")).unionByName(failed)


def resolve_mode(mode: str, key: str | None, places: str | None, start: str | None, end: str | None) -> str:
    """local or api; auto is api only where the key, the places and both days are set."""
    if mode not in ("auto", "local", "api"):
        raise ValueError(f"unknown mode {mode}")
    if mode == "auto":
        return "api" if all((key, places, start, end)) else "local"
    return mode


def check_period(start: str, end: str, equal: bool = True) -> None:
    """Raises where the period ends before it starts (or, without equal, when it starts)."""
    if end < start or (end == start and not equal):
        raise ValueError(f"{end} isn't after {start}")
