"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise sum is computed in linear time as
1/2 * sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2).

Inputs: words (lower-cased, hashed into ``BUCKETS``, logarithm of their counts, each text scaled to length 1), and
statistics of the text's characters, words, repeats and lines, with its length as metadata. Labels, language, source
and id are no inputs. The machine is fitted on at most ``SAMPLE`` labelled rows, those with the smallest hashes of
their ids; it is a few hundred kilobytes whatever the input. Every row is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import long_lists, small_batches, words_of

BUCKETS = 1 << 14
RANK = 8
#: Labelled rows that the machine is fitted on, at most.
SAMPLE = 4000
EPOCHS = 8
#: Steps at least, so that a small sample is fitted too.
STEPS = 256
THRESHOLD = 0.3
STATISTICS = ("upper", "lower", "digit", "sign", "high", "blank", "marked", "only_signs", "repeated", "distinct", "word_length", "lines", "length", "words", "empty")
_KIND = np.full(256, 3, dtype=np.uint8)  # 0 upper, 1 lower, 2 digit, 3 other ASCII, 4 above ASCII, 5 blank
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 0, 1, 2, 4
_KIND[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 5


def features(words, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value, statistics) of the rows of words: sparse words, and one line of STATISTICS per row."""
    rows = words.hi - words.lo
    row = np.repeat(np.arange(rows), np.diff(words.bounds))
    keys, counts = np.unique(row * BUCKETS + (words.hashes & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    at, value = keys // BUCKETS, np.log1p(counts)
    norm = np.sqrt(np.bincount(at, value * value, minlength=rows))
    value = value / np.maximum(norm, 1e-9)[at]

    kind = _KIND[words.data]
    size = np.diff(words.row_starts)
    byte_row = np.repeat(np.arange(rows), size)
    shares = np.bincount(byte_row * 6 + kind, minlength=6 * rows).reshape(rows, 6) / np.maximum(size, 1)[:, None]
    n = np.diff(words.bounds)
    per = lambda x: np.bincount(row, x, minlength=rows) / np.maximum(n, 1)
    last = kind[words.ends - 1] == 3 if len(words.ends) else np.empty(0, dtype=bool)
    last_two = last & (words.ends - words.starts > 1) & (kind[np.maximum(words.ends - 2, 0)] == 3) if len(last) else last
    signs = np.concatenate(([0], np.cumsum(kind == 3)))
    only = signs[words.ends] - signs[words.starts] == words.ends - words.starts
    again = np.zeros(len(row), dtype=bool)
    if len(row) > 1:
        again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    whole = np.unique(row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words.hashes, return_index=True)[1]
    distinct = np.bincount(row[whole], minlength=rows) / np.maximum(n, 1)
    lines = np.bincount(byte_row[words.data == 10], minlength=rows) / np.maximum(n, 1)
    stats = np.column_stack([shares[:, 0], shares[:, 1], shares[:, 2], shares[:, 3], shares[:, 4], shares[:, 5], per(last_two), per(only), per(again), distinct, per(words.ends - words.starts) / 10, lines, np.log1p(n_chars) / 10, np.log1p(n) / 10, n == 0])
    return at, keys % BUCKETS, value, stats.astype(np.float64)


class Machine:
    """The fitted machine. Its inputs are BUCKETS words and then STATISTICS, scaled by the sample's mean and deviation."""

    def __init__(self, base: float, mean: np.ndarray, scale: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.base, self.mean, self.scale, self.w0, self.w, self.v = base, mean, scale, w0, w, v

    def inputs(self, at, bucket, value, stats):
        """All inputs as (row, index, value), in order of rows."""
        rows, k = stats.shape
        dense = np.clip((stats - self.mean) / self.scale, -4, 4)
        row = np.concatenate((at, np.repeat(np.arange(rows), k)))
        index = np.concatenate((bucket, np.tile(BUCKETS + np.arange(k), rows)))
        return row, index, np.concatenate((value, dense.ravel()))

    def sums(self, row, index, value, rows):
        """(linear part, sum_i v_if x_i, sum_i v_if**2 x_i**2) of each row."""
        linear = np.bincount(row, self.w[index] * value, minlength=rows)
        first = np.column_stack([np.bincount(row, self.v[index, f] * value, minlength=rows) for f in range(RANK)])
        square = np.bincount(row, (self.v[index] ** 2).sum(axis=1) * value**2, minlength=rows)
        return linear, first, square

    def score(self, at, bucket, value, stats) -> np.ndarray:
        if self.w is None:
            return np.full(len(stats), self.base)
        row, index, value = self.inputs(at, bucket, value, stats)
        linear, first, square = self.sums(row, index, value, len(stats))
        return 1 / (1 + np.exp(-np.clip(self.w0 + linear + 0.5 * ((first**2).sum(axis=1) - square), -30, 30)))


def fit(at, bucket, value, stats, label: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss by Adam over batches of rows. at, bucket, value hold the words of all rows, in order of rows."""
    n = len(label)
    mean, scale = (stats.mean(axis=0), stats.std(axis=0) + 1e-3) if n else (np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
    base = float(label.mean()) if n else 0.5
    if n < 10 or base in (0.0, 1.0):
        return Machine(base, mean, scale, 0.0, None, None)
    rng, width = np.random.default_rng(seed), BUCKETS + len(STATISTICS)
    machine = Machine(base, mean, scale, float(np.log(base / (1 - base))), np.zeros(width), rng.normal(0, 0.05, (width, RANK)))
    starts = np.searchsorted(at, np.arange(n + 1))
    state = {k: [np.zeros_like(x), np.zeros_like(x)] for k, x in (("w", machine.w), ("v", machine.v))} | {"w0": [0.0, 0.0]}
    step, rate = 0, 0.02
    for _ in range(max(epochs, -(-STEPS * 128 // max(n, 128)))):
        order = rng.permutation(n)
        for a in range(0, n, 128):
            chosen = order[a : a + 128]
            take = np.concatenate([np.arange(starts[i], starts[i + 1]) for i in chosen])
            local = np.repeat(np.arange(len(chosen)), starts[chosen + 1] - starts[chosen])
            row, index, x = machine.inputs(local, bucket[take], value[take], stats[chosen])
            linear, first, square = machine.sums(row, index, x, len(chosen))
            raw = machine.w0 + linear + 0.5 * ((first**2).sum(axis=1) - square)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[chosen]) / len(chosen)
            part = error[row] * x
            grad_w = np.bincount(index, part, minlength=width) + 1e-4 * machine.w
            grad_v = np.column_stack([np.bincount(index, part * (first[row, f] - machine.v[index, f] * x), minlength=width) for f in range(RANK)]) + 1e-4 * machine.v
            step += 1
            for name, grad in (("w0", error.sum()), ("w", grad_w), ("v", grad_v)):
                m = state[name]
                m[0] = 0.9 * m[0] + 0.1 * grad
                m[1] = 0.999 * m[1] + 0.001 * grad * grad
                move = rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
                setattr(machine, name, getattr(machine, name) - move)
    return machine


def _chars(docs: DataFrame) -> Column:
    """n_chars, or the length of text where the column is absent or null."""
    chars = F.length(F.coalesce("text", F.lit("")))
    chars = F.coalesce(F.col("n_chars").cast("bigint"), chars) if "n_chars" in docs.columns else chars
    return F.greatest(chars, F.lit(0)).cast("bigint")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, held_in=None) -> Machine:
    """Fits on the rows of docs that labels (doc_id, quality) mark and held_in, a condition on doc_id, admits.

    A document that is marked more than once counts as marked by the least mark; null marks don't count. Of rows that
    share a doc_id one counts, that with the least hash of its text: each task keeps its least, Spark the least of those.
    """
    small_batches(docs.sparkSession)
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    marks = marks.where(held_in) if held_in is not None else marks
    chosen = marks.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[int, int]] = {}  # doc_id -> (hash, n_chars) of its row, at most sample of them
        for batch in batches:
            better = {}
            for i, (doc, *mark) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "hash", "n_chars")), strict=True)):
                if doc not in least or tuple(mark) < least[doc]:
                    least[doc], better[doc] = tuple(mark), i
            batch = batch.take(pa.array(sorted(better.values()), pa.int64()))
            chars = batch.column("n_chars").to_numpy()
            for words in words_of(batch.column("text"), lower=True):
                at, bucket, value, stats = features(words, chars[words.lo : words.hi])
                bounds = np.searchsorted(at, np.arange(words.hi - words.lo + 1))
                part = batch.slice(words.lo, words.hi - words.lo)
                floats = lambda x, b: pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(x, pa.float32()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "quality", "hash", "n_chars")), long_lists(bucket, bounds), floats(value, bounds), floats(stats.ravel(), np.arange(len(part) + 1) * stats.shape[1])], names=["doc_id", "quality", "hash", "n_chars", "bucket", "value", "stats"])

    rows = docs.select("doc_id", "text", _chars(docs).alias("n_chars")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "n_chars", F.col("quality").cast("int").alias("quality"), F.xxhash64("text").alias("hash"))
    each = rows.mapInArrow(run, "doc_id bigint, quality int, hash bigint, n_chars bigint, bucket array<bigint>, value array<float>, stats array<float>")
    one = each.groupBy("doc_id").agg(F.min_by(F.struct("quality", "bucket", "value", "stats"), F.struct("hash", "n_chars")).alias("row"))
    found = one.select("doc_id", "row.*").toArrow().sort_by("doc_id")  # at most sample rows
    flat = lambda c: found.column(c).combine_chunks().flatten().to_numpy() if len(found) else np.empty(0)
    sizes = np.array([len(x) for x in found.column("bucket")], dtype=np.int64)
    at = np.repeat(np.arange(len(found)), sizes)
    return fit(at, flat("bucket").astype(np.int64), flat("value").astype(np.float64), flat("stats").astype(np.float64).reshape(len(found), len(STATISTICS)), np.array(found.column("quality").to_pylist(), dtype=np.float64))


def held_out():
    """crc32 of the id as text is divisible by 5; rows without an id are."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def score(docs: DataFrame, machine: Machine, keep: tuple[str, ...] = (), threshold: float = THRESHOLD) -> DataFrame:
    """docs with doc_id, score and predicted, and the columns in keep. Null texts count as empty; every row is scored."""
    small_batches(docs.sparkSession)
    broadcast = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = broadcast.value
        for batch in batches:
            chars, scores = batch.column("_chars").to_numpy(), np.empty(len(batch))
            for words in words_of(batch.column("_text"), lower=True):
                scores[words.lo : words.hi] = fitted.score(*features(words, chars[words.lo : words.hi]))
            kept = [batch.column(c) for c in ("doc_id", *keep)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", *keep, "score", "predicted"])

    given = docs.select("doc_id", *keep, F.col("text").alias("_text"), _chars(docs).alias("_chars"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select("doc_id", *keep).schema] + ["score double", "predicted int"])
    return given.mapInArrow(run, schema)


def keep_good(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that the machine rejects; all columns stay, and nothing is shuffled."""
    small_batches(docs.sparkSession)
    broadcast, has_length = docs.sparkSession.sparkContext.broadcast(machine), "n_chars" in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = broadcast.value
        for batch in batches:
            texts, good = batch.column("text"), np.ones(len(batch), dtype=bool)
            chars = pc.fill_null(pc.utf8_length(texts), 0).cast(pa.int64())
            chars = pc.coalesce(batch.column("n_chars").cast(pa.int64()), chars) if has_length else chars
            chars = np.maximum(chars.to_numpy(zero_copy_only=False), 0)
            for words in words_of(texts, lower=True):
                good[words.lo : words.hi] = fitted.score(*features(words, chars[words.lo : words.hi])) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
