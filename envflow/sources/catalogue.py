"""A catalogue of products as a Spark source whose filters go into the request.

A where on the columns becomes the service's filter text: collection, name, online, time of start and box. What the text says exactly is not
tested again; the box, of which the service tests the true outline, is. Only the columns asked for are named in the request. A
period with both ends is cut into windows, a partition for each; pages of a window follow one another.

Filters are pushed where ``spark.sql.python.filterPushdown.enabled`` is set. Without it the same rows come, after more requests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D

from envflow.sources.rest import Policy, Transport, linked

PUSH_DOWN = "spark.sql.python.filterPushdown.enabled"
#: Column -> (type, the service's name).
COLUMNS = {
    "id": ("STRING", "Id"), "name": ("STRING", "Name"), "collection": ("STRING", "Collection"), "online": ("BOOLEAN", "Online"), "bytes": ("BIGINT", "ContentLength"),
    "start": ("TIMESTAMP", "ContentDate"), "stop": ("TIMESTAMP", "ContentDate"), "west": ("DOUBLE", "GeoFootprint"), "south": ("DOUBLE", "GeoFootprint"), "east": ("DOUBLE", "GeoFootprint"), "north": ("DOUBLE", "GeoFootprint"),
}
_COMPARED = {D.GreaterThan: "gt", D.GreaterThanOrEqual: "ge", D.LessThan: "lt", D.LessThanOrEqual: "le", D.EqualTo: "eq"}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def iso(time: datetime) -> str:
    """A time as the service writes it, in UTC; a time without a zone is one."""
    time = time.astimezone(timezone.utc) if time.tzinfo else time
    return time.strftime("%Y-%m-%dT%H:%M:%S.") + f"{time.microsecond // 1000:03d}Z"


def _whole(time: datetime) -> bool:
    return time.microsecond % 1000 == 0  # the service's times end with milliseconds


class Search:
    """What a scan asks for: conditions of the service's filter, the period and the box."""

    def __init__(self) -> None:
        self.conditions: list[str] = []
        self.box: dict[str, float] = {}
        self.first: datetime | None = None
        self.last: datetime | None = None

    def take(self, f: D.Filter) -> bool:
        """Whether a filter is in the request from now on; then Spark need not test it. Of the box only the outline is asked for."""
        name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
        kind, value = type(f), getattr(f, "value", None)
        if name == "collection" and kind is D.EqualTo:
            self.conditions.append(f"Collection/Name eq {quoted(value)}")
        elif name == "collection" and kind is D.In and f.value and all(isinstance(v, str) for v in f.value):
            self.conditions.append("(" + " or ".join(f"Collection/Name eq {quoted(v)}" for v in sorted(f.value)) + ")")
        elif name == "name" and kind in (D.StringContains, D.StringStartsWith, D.StringEndsWith):
            self.conditions.append(f"{ {D.StringContains: 'contains', D.StringStartsWith: 'startswith', D.StringEndsWith: 'endswith'}[kind] }(Name,{quoted(value)})")
        elif name == "name" and kind is D.EqualTo:
            self.conditions.append(f"Name eq {quoted(value)}")
        elif name == "online" and kind is D.EqualTo:
            self.conditions.append(f"Online eq {str(value).lower()}")
        elif name == "start" and kind in _COMPARED and isinstance(value, datetime):
            if kind in (D.GreaterThan, D.GreaterThanOrEqual, D.EqualTo):
                self.first = value if self.first is None else max(self.first, value)
            if kind in (D.LessThan, D.LessThanOrEqual, D.EqualTo):
                self.last = value if self.last is None else min(self.last, value)
            return kind in (D.GreaterThanOrEqual, D.LessThanOrEqual) and _whole(value)
        elif (name, kind) in (("west", D.LessThanOrEqual), ("south", D.LessThanOrEqual), ("east", D.GreaterThanOrEqual), ("north", D.GreaterThanOrEqual)):
            tighter = min if kind is D.LessThanOrEqual else max
            self.box[name] = tighter(self.box.get(name, value), value)
            return False
        else:
            return False
        return True

    def windows(self, n: int) -> list[tuple[datetime | None, datetime | None]]:
        """The period in n parts without gaps; each ends a millisecond before the next begins."""
        if self.first is None or self.last is None:
            return [(self.first, self.last)]
        if self.last < self.first:
            return []
        first, last = self.first.replace(microsecond=self.first.microsecond // 1000 * 1000), self.last
        step = max(1, -(-int((last - first) / timedelta(milliseconds=1) + 1) // n))
        starts = [first + timedelta(milliseconds=step * i) for i in range(n)]
        return [(a, min(last, a + timedelta(milliseconds=step - 1))) for a in starts if a <= last]

    def text(self, first: datetime | None, last: datetime | None) -> str:
        parts = list(self.conditions)
        if len(self.box) == 4:
            # east of the area is what west of a product may not pass, and so on
            x0, y0, x1, y1 = self.box["east"], self.box["north"], self.box["west"], self.box["south"]
            ring = f"POLYGON(({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"
            parts.append(f"OData.CSC.Intersects(area=geography'SRID=4326;{ring}')")
        parts += [f"ContentDate/Start ge {iso(first)}"] if first else []
        parts += [f"ContentDate/Start le {iso(last)}"] if last else []
        return " and ".join(parts)


class Window(D.InputPartition):
    def __init__(self, text: str):
        super().__init__(text)
        self.text = text


def record(item: dict, collection: str | None = None) -> dict:
    """An item of an answer by the names of COLUMNS."""
    time = lambda text: datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None
    dates = item.get("ContentDate") or {}
    rings = ((item.get("GeoFootprint") or {}).get("coordinates")) or []
    flat: list = rings
    while flat and isinstance(flat[0], list) and flat[0] and isinstance(flat[0][0], list):
        flat = [p for part in flat for p in part]
    xs, ys = [p[0] for p in flat], [p[1] for p in flat]
    box = (min(xs), min(ys), max(xs), max(ys)) if flat else (None,) * 4
    named = item.get("Collection")
    return {
        "id": item.get("Id"), "name": item.get("Name"), "collection": named.get("Name") if isinstance(named, dict) else named or collection, "online": item.get("Online"), "bytes": item.get("ContentLength"),
        "start": time(dates.get("Start")), "stop": time(dates.get("End")), **dict(zip(("west", "south", "east", "north"), box, strict=True)),
    }


class _Reader(D.DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.columns, self.get, self.policy, self.page, self.parts = cloudpickle.loads(bytes.fromhex(options["plan"]))
        self.search = Search()

    def partitions(self) -> Sequence[Window]:
        return [Window(self.search.text(*w)) for w in self.search.windows(self.parts)]

    def read(self, partition: Window | None) -> Iterator[tuple]:
        if partition is None:  # Spark's stand-in for no partitions: the period is empty
            return
        params = {"$top": self.page, "$orderby": "ContentDate/Start asc,Id asc", "$select": ",".join(sorted({COLUMNS[c][1] for c in self.columns}))}
        params |= {"$filter": partition.text} if partition.text else {}
        for item in linked(self.get, self.url, params, 0, self.policy):
            row = record(item)
            yield tuple(row[c] for c in self.columns)


class _PushingReader(_Reader):
    """Spark takes no reader that has pushFilters where pushing is off."""

    def pushFilters(self, filters: list[D.Filter]) -> Iterable[D.Filter]:
        return [f for f in filters if not self.search.take(f)]


class CatalogueSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "envflow_catalogue"

    def schema(self) -> str:
        columns = cloudpickle.loads(bytes.fromhex(self.options["plan"]))[1]
        return ", ".join(f"{c} {COLUMNS[c][0]}" for c in columns)

    def reader(self, schema) -> D.DataSourceReader:
        return (_PushingReader if self.options.get("push") == "true" else _Reader)(self.options)


def read_catalogue(spark: SparkSession, url: str, get: Transport, columns: Sequence[str] = tuple(COLUMNS), policy: Policy = Policy(), page: int = 1000, parts: int = 8) -> DataFrame:
    """The products of a catalogue, lazily: what is asked of the service follows from the where that is put on it.

    A period with both ends is read in so many parts, each by a task. A request that fails for good fails the query, as a search
    of which a part is missing would look like one that found less. Times without a zone in filters are those of the session's zone, UTC.
    """
    spark.dataSource.register(CatalogueSource)
    plan: tuple[str, list[str], Callable, Policy, int, int] = (url, list(columns), get, policy, page, parts)
    push = spark.conf.get(PUSH_DOWN, "false").lower()
    return spark.read.format("envflow_catalogue").option("plan", cloudpickle.dumps(plan).hex()).option("push", push).load()
