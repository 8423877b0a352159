"""A committing sink of messages: tasks send rows, and what the receiver has acknowledged is counted when Spark commits.

A task sends its rows through a producer of its own, waits for what is outstanding at its end, and tells how many messages were acknowledged and
how many were not. The counts of the tasks that Spark took become a manifest in a shared folder when the job commits. An attempt that
died tells nothing, so its messages are sent again by the next attempt and counted once: receivers see messages at least once and tell them
apart by key. A batch that has a manifest is not sent again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql.streaming import StreamingQuery

from envflow.sources.rest import Store


class Producer:
    """What a task sends with. Made in the task by the function that the caller gives."""

    def send(self, topic: str, key: str | None, value: str) -> Callable[[], bool]:
        """Begins to send a message; what it returns waits for the answer and tells whether the message was acknowledged."""
        raise NotImplementedError

    def close(self) -> None:
        pass


@dataclass
class Sent(D.WriterCommitMessage):
    """What a task has sent: acknowledged messages and others."""

    partition: int
    attempt: int
    acknowledged: int
    failed: int


def send_rows(rows: Iterator, producer: Producer, topic: str, outstanding: int) -> tuple[int, int]:
    """(acknowledged, failed) of rows (key, value). With outstanding 1 each message is waited for before the next is sent."""
    waiting: list[Callable[[], bool]] = []
    acknowledged = failed = 0

    def settle(n: int) -> None:
        nonlocal acknowledged, failed
        for answer in waiting[:n]:
            try:
                ok = bool(answer())
            except OSError:
                ok = False
            acknowledged, failed = acknowledged + ok, failed + (not ok)
        del waiting[:n]

    for row in rows:
        try:
            waiting.append(producer.send(topic, row["key"], row["value"]))
        except OSError:
            failed += 1
        if len(waiting) >= outstanding:
            settle(len(waiting) - outstanding + 1)
    settle(len(waiting))
    return acknowledged, failed


def manifest_of(folder: str, batch: str | int) -> str:
    return f"{folder.rstrip('/')}/batch-{batch}.json"


def counts(folder: str, batch: str | int) -> dict | None:
    """The manifest of a batch: acknowledged, failed, tasks; None where it has not been committed."""
    kept = Store().get(manifest_of(folder, batch))
    return json.loads(kept) if kept else None


class _Writer(D.DataSourceWriter):
    def __init__(self, options: dict):
        self.connect, self.topic, self.outstanding = cloudpickle.loads(bytes.fromhex(options["plan"]))
        self.folder, self.batch = options["folder"], options.get("batch")

    def write(self, iterator: Iterator) -> Sent:
        from pyspark import TaskContext

        task, producer = TaskContext.get(), self.connect()
        try:
            acknowledged, failed = send_rows(iterator, producer, self.topic, self.outstanding)
        finally:
            producer.close()
        return Sent(task.partitionId() if task else 0, task.taskAttemptId() if task else 0, acknowledged, failed)

    def _commit(self, messages: list, batch: str | int) -> None:
        told = [asdict(m) for m in messages if m is not None]
        total = {k: sum(t[k] for t in told) for k in ("acknowledged", "failed")}
        Store().put(manifest_of(self.folder, batch), json.dumps({**total, "batch": batch, "tasks": told}).encode())

    def commit(self, messages: list) -> None:
        self._commit(messages, self.batch)

    def abort(self, messages: list) -> None:
        pass  # what has been sent stays sent and uncounted; the batch has no manifest


class _StreamWriter(_Writer, D.DataSourceStreamWriter):
    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803
        self._commit(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        pass


class MessageSink(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "envflow_messages"

    def schema(self) -> str:
        return "key STRING, value STRING"

    def writer(self, schema, overwrite: bool) -> D.DataSourceWriter:
        return _Writer(self.options)

    def streamWriter(self, schema, overwrite: bool) -> D.DataSourceStreamWriter:
        return _StreamWriter(self.options)


def _options(spark: SparkSession, connect: Callable[[], Producer], topic: str, folder: str, outstanding: int) -> dict[str, str]:
    spark.dataSource.register(MessageSink)
    return {"plan": cloudpickle.dumps((connect, topic, outstanding)).hex(), "folder": folder.rstrip("/")}


def send(messages: DataFrame, connect: Callable[[], Producer], topic: str, folder: str, batch: str | int | None = None, outstanding: int = 1000) -> dict:
    """Sends messages (key, value) and returns the batch's counts: acknowledged, failed, and each task's.

    A batch that folder has a manifest of is not sent again. With outstanding 1 messages are sent one by one, each acknowledged before the next.
    An empty table is a batch of no messages.
    """
    batch = uuid.uuid4().hex if batch is None else batch
    done = counts(folder, batch)
    if done is None:
        options = _options(messages.sparkSession, connect, topic, folder, outstanding)
        messages.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value").write.format("envflow_messages").options(**options, batch=str(batch)).mode("append").save()
        done = counts(folder, batch)
    return done


def send_stream(messages: DataFrame, connect: Callable[[], Producer], topic: str, folder: str, checkpoint: str, outstanding: int = 1000) -> StreamingQuery:
    """Sends a stream of messages (key, value), each micro-batch once: one that was sent before a failure of the driver isn't sent again."""

    def one(rows: DataFrame, batch: int) -> None:
        send(rows, connect, topic, folder, batch, outstanding)

    return messages.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
