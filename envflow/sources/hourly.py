"""Hourly readings of a service as a stream: a Python data source whose offset is the last hour read of each target.

An hour is complete when the clock has passed it by a lag. A micro-batch takes no more than so many hours of each target, so a backfill of
years is read in steps; each target and step is a task. Spark logs a batch's offsets before it is read, so after a failure the
batch is read again as it was, and a restart from the checkpoint begins where the log ends: no hour is asked for twice by a stream that
goes on, and none is missed. An hour that can't be read is one row with an error, which a later batch source can ask for again.

Spark doesn't tell a restarted reader where it is before it asks how far to go. So the end of each planned batch is kept in a small file in a
shared folder; it is never behind the log.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D

from envflow.sources.rest import Store

HOUR = 3600
#: Hours that a task asks for at a time.
STEP = 24


class Hours(D.InputPartition):
    """The hours first..last of a target, in hours since 1970."""

    def __init__(self, target: str, first: int, last: int):
        super().__init__((target, first, last))
        self.target, self.first, self.last = target, first, last


class _Reader(D.DataSourceStreamReader):
    def __init__(self, options: dict):
        self.targets, self.fetch, self.first, self.clock, self.lag, self.most = cloudpickle.loads(bytes.fromhex(options["plan"]))
        self.position, self.store, self.at = f"{options['folder']}/position.json", Store(), None

    def initialOffset(self) -> dict:
        self.at = {t: self.first - 1 for t in self.targets}
        return self.at

    def latestOffset(self) -> dict:
        """For each target the last complete hour, or the last that a batch may take."""
        if self.at is None:
            kept = self.store.get(self.position)
            self.at = json.loads(kept) if kept else {}
        complete = int((self.clock() - self.lag) // HOUR) - 1
        known = self.at if self.at else {}
        now = {}
        for t in self.targets:
            before = known.get(t, self.first - 1)
            now[t] = max(before, min(complete, before + self.most) if self.most else complete)
        return {**known, **now}  # a target that is no longer asked for keeps its place

    def partitions(self, start: dict, end: dict) -> Sequence[Hours]:
        self.at = {t: max(end.get(t, 0), (self.at or {}).get(t, 0)) for t in {*end, *(self.at or {})}}
        self.store.put(self.position, json.dumps(self.at).encode())
        out = []
        for t, last in sorted(end.items()):
            first = start.get(t, self.first - 1) + 1
            out += [Hours(t, at, min(last, at + STEP - 1)) for at in range(first, last + 1, STEP)]
        return out

    def read(self, partition: Hours | None) -> Iterator[tuple]:
        if partition is None:
            return
        done = partition.first - 1
        try:
            for hour, body in self.fetch(partition.target, partition.first, partition.last):
                done = max(done, hour)
                yield partition.target, datetime.fromtimestamp(hour * HOUR, timezone.utc), json.dumps(body, ensure_ascii=False), None
        except Exception as e:  # noqa: BLE001  the hours from here on can be told from empty ones
            yield partition.target, datetime.fromtimestamp((done + 1) * HOUR, timezone.utc), None, f"{type(e).__name__}: {e}"

    def commit(self, end: dict) -> None:
        pass  # nothing is kept at the service


class HourlySource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "envflow_hourly"

    def schema(self) -> str:
        return "target STRING, hour TIMESTAMP, body STRING, error STRING"

    def streamReader(self, schema) -> D.DataSourceStreamReader:
        return _Reader(self.options)


def hours_since_1970(day: str) -> int:
    """The first hour of an ISO day or time in UTC."""
    return int(datetime.fromisoformat(day).replace(tzinfo=timezone.utc).timestamp() // HOUR)


def stream_hours(spark: SparkSession, targets: Sequence[str], fetch: Callable[[str, int, int], Iterator[tuple[int, dict]]], first: str, folder: str, hours_per_batch: int = 24, lag: float = 0.0, clock: Callable[[], float] = time.time) -> DataFrame:
    """A stream of (target, hour, body, error): the results of fetch(target, first hour, last hour), which gives (hour, result).

    It begins at the day or time first, in UTC. lag is how many seconds after its end an hour is complete. folder is one that all share and
    belongs to this stream alone, like its checkpoint. A target that a restart adds begins at first; one that it leaves out keeps its place.
    fetch asks a service with its own policy of tries (see rest.ask); what it raises becomes an error row for the hours that are left.
    """
    spark.dataSource.register(HourlySource)
    plan = (list(targets), fetch, hours_since_1970(first), clock, lag, hours_per_batch)
    return spark.readStream.format("envflow_hourly").option("plan", cloudpickle.dumps(plan).hex()).option("folder", folder.rstrip("/")).load()
