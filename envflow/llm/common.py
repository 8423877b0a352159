"""What the operators share: a shared folder for written tables, and word and shingle hashes in numpy.

Words are maximal runs of bytes other than space and tab..carriage return, i.e. ``[^\\x20\\x09-\\x0D]+``.
A null text has no words. Hashes are 64 bits wide, computed from fixed random tables, so every task
and every retry gives the same value.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Texts are hashed in pieces of about so many bytes (whole documents), which bounds a task's memory.
CHUNK_BYTES = 1 << 20
#: Input rows from which on a hot key matters: a third of fewer rows is still a fair task.
SPLIT_ROWS = 50_000_000
_MASK = (1 << 64) - 1


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Where the session names none, a temporary one in local mode; a cluster must name one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="envflow-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SCRATCH: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Tables written inside are deleted at the end, but for those that the caller takes out of the list."""
    made: list[DataFrame] = []
    _SCRATCH.append(made)
    try:
        yield made
    finally:
        _SCRATCH.pop()
        discard(*made)


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """df written once as Parquet to the shared folder and read again: cuts lineage and survives lost executors.

    Every task of df's last stage writes its own file, so the work stays dealt out as Spark dealt it. Where no more than
    so many rows are known to come, they are written into a file for each core, or for 500,000 rows if that is more. The shuffle files of df are
    deleted when it has been written, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    out = df if rows is None else df.coalesce(max(spark.sparkContext.defaultParallelism, rows // 500_000))
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        out.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    if _SCRATCH:
        _SCRATCH[-1].append(out)
    return out


def splittable(aggregate: DataFrame, name: str, rows: int) -> DataFrame:
    """An aggregate of a table of so many rows that is to be joined with that table, written first if they are many.

    Then both sides of the join are plain exchanges, which adaptive execution can split where a key is hot; with the
    aggregate in the join's own stage it can't.
    """
    return written(aggregate, name) if rows >= SPLIT_ROWS else aggregate


def discard(*tables: DataFrame) -> None:
    """Deletes written tables (others stay) that nothing reads any more: what was made of them has been written since."""
    for table in tables:
        if hasattr(table, "written_to"):
            context = table.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(table.written_to)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def forget(spark: SparkSession) -> None:
    """Lets the driver drop what finished jobs left there: plans that Python still names, broadcasts, classes made for plans.

    Spark does so by itself every half hour; a driver of little memory that runs hundreds of short jobs can't wait for that.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def few(table: DataFrame, rows: int = 2_000_000) -> DataFrame:
    """A written table of narrow rows, to be joined: broadcast where its count is within rows, else as it is."""
    return F.broadcast(table) if table.count() <= rows else table


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with value as a variable: it is in the expression once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def prefixes(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """combine over the first i + 1 values, for every i of an array, native: each round combines over twice as many values.

    Appending to an array in a fold would copy it for every value; this takes as many passes as its length has binary digits.
    """

    def over(every: Column) -> Column:
        rounds = F.when(F.size(every) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(every))).cast("int") - 1)).otherwise(F.expr("CAST(array() AS array<int>)"))

        def one(now: Column, k: Column) -> Column:
            return let(F.call_function("shiftleft", F.lit(1), k), lambda back: F.transform(now, lambda x, i: F.when(i >= back, combine(F.get(now, i - back), x)).otherwise(x)))

        return F.aggregate(rounds, every, one)

    return let(values, over)


def n_partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of so many rows at most (and 64 MB, Spark's own limit): a batch is held in memory whole."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_BYTE, _PLACE = stream(11, 256), stream(12, 4096)
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(SEPARATORS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = stream(12, max(n, 2 * len(_PLACE)))
    return _PLACE


class Words:
    """The words of consecutive rows lo..hi-1 of a column: their hashes, each row's bounds, and where they lie.

    starts and ends are offsets in data, the bytes of these rows; row r has words bounds[r-lo]..bounds[r-lo+1]-1.
    """

    __slots__ = ("bounds", "data", "ends", "hashes", "hi", "lo", "row_starts", "starts")

    def __init__(self, lo: int, hi: int, data: np.ndarray, row_starts: np.ndarray, lower: bool):
        self.lo, self.hi, self.data, self.row_starts = lo, hi, data, row_starts
        word = _IS_WORD[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = row_starts[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        first[inner] = word[inner]
        self.starts = np.flatnonzero(first)
        word_bytes = np.flatnonzero(word)
        at = np.searchsorted(word_bytes, self.starts)
        lens = np.diff(np.append(at, len(word_bytes)))
        self.ends = self.starts + lens
        self.bounds = np.searchsorted(self.starts, row_starts)
        if len(self.starts):
            text = data[word_bytes]
            k = np.arange(len(text)) - np.repeat(at, lens)
            values = _BYTE[_LOWER[text] if lower else text] * places(int(lens.max()))[k]
            self.hashes = mix(np.add.reduceat(values, at))
        else:
            self.hashes = np.empty(0, dtype=np.uint64)

    def text(self, row: int) -> bytes:
        a, b = self.row_starts[row - self.lo : row - self.lo + 2]
        return self.data[a:b].tobytes()


def word_hash(word: bytes) -> np.ndarray:
    """The hash of one word, as an array of one, as Words has it."""
    with np.errstate(over="ignore"):
        return mix((_BYTE[np.frombuffer(word, dtype=np.uint8)] * places(len(word))[: len(word)]).sum(keepdims=True))


def words_of(column: pa.Array, lower: bool = False, chunk: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of a string column, in pieces of whole rows of about chunk bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    lo = 0
    with np.errstate(over="ignore"):
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk, "right")) - 1)
            hi = min(hi, n)
            a, b = int(offsets[lo]), int(offsets[hi])
            yield Words(lo, hi, data[a:b], offsets[lo : hi + 1] - a, lower)
            lo = hi


def shingle_hashes(hashes: np.ndarray, k: int, seed: int = 21) -> np.ndarray:
    """A hash of every k consecutive words (also across rows: callers use those that lie in one row)."""
    if len(hashes) < k:
        return np.empty(0, dtype=np.uint64)
    c, n = stream(seed, k), len(hashes) - k + 1
    with np.errstate(over="ignore"):
        total = hashes[:n] * c[0]
        for j in range(1, k):
            total += hashes[j : j + n] * c[j]
        return mix(total)


def sequence_hash(hashes: np.ndarray, seed: int = 31) -> int:
    """One hash of a whole sequence of words, its length included."""
    with np.errstate(over="ignore"):
        total = int((hashes * stream(seed, len(hashes) + 1)[1:]).sum(dtype=np.uint64)) if len(hashes) else 0
        return int(mix(np.array([(total + 0x9E3779B97F4A7C15 * len(hashes)) & _MASK], dtype=np.uint64))[0])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def long_lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list<int64> column from concatenated values."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(values), pa.int64()))
