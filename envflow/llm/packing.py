"""Packing of documents into sequences by best-fit decreasing.

Overlong documents are first cut into full windows, each a sequence of its own. The rests, shorter than a window, are
packed by best fit in decreasing order. Best fit needs only how many rests there are of each length: the driver gets
this histogram, at most ``size`` rows whatever the input, and packs whole runs of equal rests at once. Open windows are
kept in classes by remaining capacity, and a segment tree indexed by remaining capacity finds the tightest class that
still holds a rest. The plan, of a few rows for each length, says where the i-th rest of a length goes; Spark numbers
the rests of each length without gathering them, and every task looks its rests up in the plan.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import small_batches, written

SIZE = 2048
END_ID = 1
#: The pieces of a length are numbered in shares of about so many, so that a very common length, such as that of full windows, is not
#: one task's work; there are as many shares as the pieces of all lengths need, and one for each length besides.
SHARE_ROWS = 100_000


def tokenizer(name: str = "byte_bpe_50k.tiktoken"):
    """text -> ids. The file is the rank form of byte_bpe_50k.json: the same ids, several times as fast.

    Strings of the tokens that the JSON adds to the vocabulary are those tokens, as they are for the JSON's own reader.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(public_tokenizers.path(name.replace(".tiktoken", ".json")), encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: encoding.encode(text, allowed_special="all")


class CapacityTree:
    """A segment tree over 0..size: which remaining capacities have open windows, and the smallest from one on."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = bytearray(2 * self.leaves)

    def set(self, capacity: int, there: bool) -> None:
        at = capacity + self.leaves
        self.some[at] = there
        while at > 1:
            at >>= 1
            self.some[at] = self.some[2 * at] | self.some[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        at = least + self.leaves
        if self.some[at]:
            return least
        while at > 1:
            if not at & 1 and self.some[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit_decreasing(histogram: dict[int, int], size: int = SIZE) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(plan, windows) for histogram[length] rests of each length from 1 to size - 1.

    A row of the plan is (length, first rank, first window, rests in each window, offset): of the rests of this length,
    those from first rank on go into consecutive windows, so many in each, at offset and right after one another.
    It ends where the next row of its length begins. The result is that of best fit decreasing done one by one.
    """
    open_: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # remaining capacity -> runs (first window, windows)
    tree, plan, windows = CapacityTree(size), [], 0

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            open_[capacity].append((first, n))
            tree.set(capacity, True)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, n = size, -(-left // (size // length))
                first, windows = windows, windows + n
            else:
                first, n = open_[capacity].popleft()
                if not open_[capacity]:
                    tree.set(capacity, False)
            each = capacity // length
            full = min(n, left // each)
            if full:
                plan.append((length, rank, first, each, size - capacity))
                put(capacity - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n:
                some = min(left, each - 1) if full < n and left < each else 0
                if some:
                    plan.append((length, rank, first + full, some, size - capacity))
                    put(capacity - some * length, first + full, 1)
                    rank, left, full = rank + some, left - some, full + 1
                put(capacity, first + full, n - full)
    return plan, windows


def _pieces(size: int, end_id: int, load):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load()
        for batch in batches:
            ids, rows, total = batch.column("doc_id").to_pylist(), [], 0
            for doc, text in zip(ids, batch.column("text"), strict=True):
                tokens = np.array([*encode(text.as_py() or ""), end_id], dtype="<u4")
                for at in range(0, len(tokens), size):
                    part = tokens[at : at + size]
                    rows.append((doc, at, len(part), zlib.crc32(part.tobytes()), len(tokens)))
            cols = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=names)

    return run


def pack(docs: DataFrame, size: int = SIZE, end_id: int = END_ID, load=tokenizer) -> DataFrame:
    """One row per piece of every row of docs (doc_id, text).

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A null or empty text is the end id
    alone. Repeated rows and rows without an id are packed like any other. Sequences are numbered from 0: full windows
    last. Every id lies in exactly one piece; the pieces of a sequence follow one another from offset 0.
    load is called once in each task and gives the function from text to ids.
    """
    spark = docs.sparkSession
    small_batches(spark)
    pieces = docs.select("doc_id", "text").mapInArrow(_pieces(size, end_id, load), "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")
    # written with the pieces, so that both jobs that number them see the same; rows that repeat are told apart by their number
    spread = F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id())
    pieces = written(pieces.withColumn("spread", spread), "pieces")

    totals = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most size rows
    shares = spark.createDataFrame([(length, n // SHARE_ROWS + 1) for length, n in totals.items()], "length bigint, shares bigint")
    whole = totals.pop(size, 0)
    plan, windows = best_fit_decreasing(totals, size)
    # how many of each length come before a share
    pieces = pieces.join(F.broadcast(shares), "length").withColumn("share", F.pmod("spread", "shares")).drop("spread", "shares")
    counts = pieces.groupBy("length", "share").agg(F.count("*").alias("n"))
    sums = "sum(n) OVER (PARTITION BY length ORDER BY share ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n"
    before = counts.withColumn("before", F.expr(sums)).select("length", "share", "before")
    # repeated rows are alike in every column, so their order does not matter
    order = "row_number() OVER (PARTITION BY length, share ORDER BY doc_id, start, ids_crc32, doc_tokens) - 1"
    ranked = pieces.withColumn("own", F.expr(order)).join(F.broadcast(before), ["length", "share"]).withColumn("rank", F.col("own") + F.col("before"))

    table = np.array([(size, 0, windows, 1, 0), *plan] if whole else plan, dtype=np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a length's ranks lie in consecutive rows of the plan
        keys = table[:, 0] * (1 << 48) + table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(keys, length * (1 << 48) + rank, "right") - 1]
            at = rank - row[:, 1]
            sequence, offset = row[:, 2] + at // row[:, 3], row[:, 4] + at % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:5]), pa.array(sequence), pa.array(offset)], names=names)

    return ranked.select(*names[:5], "rank").mapInArrow(place, ", ".join(f"{c} bigint" for c in names))
