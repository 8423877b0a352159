"""Exact dedup by content sort.

Normalised texts (every run of space and tab..carriage return is one space) are put in order of their bytes and the rows of
equal texts by doc_id: Spark samples splitters, deals the rows into ranges and sorts each range, spilling to disk.
Equal texts are then neighbours, and a pass over each range compares every text with the one before it in full.

The sort key stands for the whole text and is short: its first ``LEAD`` characters and the digest of all of it. So
splitters, of which the driver holds a sample, are short too, and texts that begin alike don't meet in one range. After them
the key has doc_id and a number of the row, so a text that a third of the rows hold, and a row that repeats
as often, are spread over as many ranges as they fill. Such a group is put together again from the ranges' ends:
each range tells its first and its last group, neighbouring ranges' texts are compared in full by a join, and only the
outcome, at most two short rows for each range, goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import n_partitions, written

#: Characters of a text at the front of its sort key.
LEAD = 32
_FIRST, _LAST = 1, 2
_OUT = "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string, part int, ends int, edge string"


def normalised(text: Column) -> Column:
    """A text with each run of separators as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


class _Group:
    """The rows of one text in a range, as far as they have been read: the ids alone, and the text once."""

    def __init__(self, text: str, digest: str, number: int):
        self.text, self.digest, self.number, self.ids, self.n = text, digest, number, [], 0

    def add(self, ids: pa.Array, first: int, n: int) -> None:
        """Copies n ids, as a slice would keep the whole batch in memory."""
        self.ids.append(ids.take(pa.array(np.arange(first, first + n))))
        self.n += n

    def rows(self, part: int, ends: int) -> pa.RecordBatch:
        ids, n = pa.concat_arrays(self.ids), self.n
        first = np.zeros(n, dtype=bool)
        first[0] = True
        edge = pa.array([self.text if ends else None, *[None] * (n - 1)], pa.string())
        same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
        return pa.RecordBatch.from_arrays(
            [ids, same(ids[0].as_py(), pa.int64()), same(n, pa.int64()), pa.array(first), same(self.digest, pa.string()), same(part, pa.int32()), same(ends, pa.int32()), edge],
            names=[x.split()[0] for x in _OUT.split(", ")],
        )


def _singles(batch: pa.RecordBatch, at: np.ndarray, part: int) -> pa.RecordBatch:
    """The rows at some places of a batch, each the only one of its text, inside the range."""
    ids, n = batch.column("doc_id").take(pa.array(at)), len(at)
    same = lambda value, kind: pa.repeat(pa.scalar(value, kind), n)
    return pa.RecordBatch.from_arrays(
        [ids, ids, same(1, pa.int64()), same(True, pa.bool_()), batch.column("digest").take(pa.array(at)), same(part, pa.int32()), same(0, pa.int32()), pa.nulls(n, pa.string())],
        names=[x.split()[0] for x in _OUT.split(", ")],
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal neighbours in a sorted range (doc_id, digest, text); ends tells the first and the last of them."""
    from pyspark import TaskContext

    part, group, number = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        n = len(batch)
        if not n:
            continue
        texts, ids = batch.column("text"), batch.column("doc_id")
        new = np.ones(n, dtype=bool)
        new[1:] = ~pc.equal(texts.slice(1), texts.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        new[0] = group is None or texts[0].as_py() != group.text
        starts = np.flatnonzero(new)
        upto = starts[0] if len(starts) else n
        if upto:
            group.add(ids, 0, int(upto))
        if not len(starts):
            continue
        if group is not None:
            yield group.rows(part, _FIRST if group.number == 0 else 0)
        # groups that begin and end in this batch; the range's first one is told apart, its last one is not known yet
        sizes = np.diff(np.append(starts, n))
        own = starts[:-1][(sizes[:-1] == 1) & (np.arange(number, number + len(starts) - 1) > 0)]
        if len(own):
            yield _singles(batch, own, part)
        digests = batch.column("digest")
        for i in np.flatnonzero((sizes > 1) | (np.arange(number, number + len(starts)) == 0)).tolist() + [len(starts) - 1]:
            at, size = int(starts[i]), int(sizes[i])
            if group is not None and group.number == number + i:
                continue  # the batch's last group, seen already
            group = _Group(texts[at].as_py(), digests[at].as_py(), number + i)
            group.add(ids, at, size)
            if i < len(starts) - 1:
                yield group.rows(part, _FIRST if group.number == 0 else 0)
        number += len(starts)
    if group is not None:
        yield group.rows(part, _LAST | (_FIRST if group.number == 0 else 0))


def _joined_ends(ends: list, equal: set[int]) -> list[tuple[int, int, int | None, int, int]]:
    """(part, ends, keep_id, group_size, head part) of the end groups that go on in another range.

    ends are (part, ends, keep_id, group_size) in order; equal holds the parts whose last text is the next range's first.
    """
    parts = sorted({e[0] for e in ends})
    groups = {(p, bit): e for e in ends for p in [e[0]] for bit in (_FIRST, _LAST) if e[1] & bit}
    out, chain = [], []

    def close() -> None:
        if len(chain) > 1:
            total = sum(e[3] for e in chain)
            out.extend((e[0], e[1], chain[0][2], total, chain[0][0]) for e in chain)
        chain.clear()

    for part in parts:
        first, last = groups[part, _FIRST], groups[part, _LAST]
        chain.append(first)
        if last is not first:
            close()
            chain.append(last)
        if part not in equal:
            close()
    close()
    return out


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    A null text counts as empty, and texts of separators alone are one space. Of the rows of a text exactly one is kept: that
    with the smallest doc_id, one of them where rows share it; rows without an id come last, so that keep_id is null only
    where no row of the group has an id. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    rows = rows.select("doc_id", "text", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.substring("text", 1, LEAD).alias("lead"))
    # rows that are alike in every column are told apart by a number, by which they can be dealt to several ranges
    key = ["lead", "digest", F.col("doc_id").asc_nulls_last(), "row"]
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(n_partitions(spark), *key).sortWithinPartitions(*key)
    found = written(ranged.select("doc_id", "digest", "text").mapInArrow(_compare, _OUT), "content_sort")

    edges = found.where("edge IS NOT NULL").select("part", "ends", "keep_id", "group_size", "edge")
    ends = [(r.part, r.ends, r.keep_id, r.group_size) for r in edges.drop("edge").collect()]  # two rows of a range at most
    parts = sorted({e[0] for e in ends})
    result = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    if len(parts) < 2:
        return found.select(*result)
    after = spark.createDataFrame(list(zip(parts[:-1], parts[1:], strict=True)), "part int, next int")
    last = edges.where(F.col("ends").bitwiseAND(_LAST) > 0).select("part", F.col("edge").alias("text")).join(F.broadcast(after), "part")
    first = edges.where(F.col("ends").bitwiseAND(_FIRST) > 0).select(F.col("part").alias("next"), F.col("edge").alias("next_text"))
    equal = {r.part for r in last.join(first, "next").where("text = next_text").select("part").collect()}
    several = _joined_ends(ends, equal)
    if not several:
        return found.select(*result)
    table = spark.createDataFrame(several, "part int, ends int, head_id bigint, total bigint, head int")
    whole = found.join(F.broadcast(table), ["part", "ends"], "left")
    return whole.select(
        "doc_id",
        F.when(F.col("total").isNull(), F.col("keep_id")).otherwise(F.col("head_id")).alias("keep_id"),
        F.coalesce("total", "group_size").alias("group_size"),
        (F.col("kept") & (F.col("head").isNull() | (F.col("head") == F.col("part")))).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text and whatever else) that are kept, one for each different text; columns stay as they are.

    Rows are found again by doc_id and text digest; of rows that share both, one stays, that with the smallest hash of all its columns.
    """
    kept = exact_duplicates(docs).where("kept").select(F.col("doc_id").alias("_keep_id"), F.col("text_sha256").alias("_keep_text"))
    digest = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    marked = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_id"), digest.alias("_digest"), F.xxhash64(*docs.columns).alias("_order"))
    met = F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_digest") == F.col("_keep_text"))
    found = marked.join(kept, met, "left_semi").groupBy("_id", "_digest").agg(F.min_by("_row", "_order").alias("_row"))
    return found.select("_row.*")

