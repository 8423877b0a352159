"""Benchmark decontamination by SimHash over item-sized windows.

Words are lower-cased (A-Z). An item of n words is compared with windows of n consecutive words of a document (the whole
document where it is shorter). Shingles are five words, or all words of a shorter item. They are weighed in two ways:
all alike, and by rarity, one over the number of different texts of items that hold it, and 1 where none does. The
similarity is the larger of both: alike, a passage that items share counts as much as other words; by rarity, an item's
own question counts more than the passage. Where no items share a shingle both are the same and one is computed.

1. A window without any shingle of an item has similarity 0 with it, so only windows around a shared shingle are
   considered; every such window is, for every item length found there.
2. The window's 128-bit SimHash is looked up in a multi-index: fingerprints are cut into blocks of 16 bits, and two that
   differ in at most ``RADIUS`` bits differ, in some block, in no more bits than that block's bound, where the bounds add up to
   RADIUS less the number of blocks, plus one. All keys within a block's bound are probed, so no fingerprint within the
   radius is missed.
3. A candidate counts if its exact weighted similarity, sum of minima over sum of maxima of weighted counts, reaches
   ``THRESHOLD``.

The items are the stated query set. They are streamed through the driver in passes of at most ``PASS_WORDS`` words
(or one item), and each pass goes over all documents; nothing of the documents leaves the tasks but matches.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import long_lists, mix, shingle_hashes, small_batches, stream, words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Bits that may differ, of BITS. Two windows at similarity 0.8 differ in 19 on average, in over 31 once in hundreds of cases.
RADIUS, BITS, BLOCK_BITS = 31, 128, 16
PASS_WORDS = 1 << 20
#: Window starts of a document that are worked on at once.
STARTS = 4096
_OTHER = stream(61, 1)[0]
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def spread(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A row of BITS signed weights for each shingle."""
    with np.errstate(over="ignore"):
        wide = np.concatenate((shingles[:, None] & _BITS, mix(shingles ^ _OTHER)[:, None] & _BITS), axis=1)
    return np.where(wide, weights[:, None], -weights[:, None])


def fingerprint(total: np.ndarray) -> np.ndarray:
    """The SimHash of each row of summed signed weights, as two numbers."""
    return np.stack([((total[..., :64] > 0) * _BITS).sum(axis=-1, dtype=np.uint64), ((total[..., 64:] > 0) * _BITS).sum(axis=-1, dtype=np.uint64)], axis=-1)


def _masks(bits: int) -> np.ndarray:
    """All keys of a block with at most so many bits set."""
    every = np.arange(1 << BLOCK_BITS, dtype=np.uint16)
    return every[np.bitwise_count(every) <= bits]


class MultiIndex:
    """Fingerprints (n, 2) by block: those within radius of a value are near it in some block."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        self.keys = np.ascontiguousarray(prints).view(np.uint16).reshape(len(prints), BITS // BLOCK_BITS)
        blocks = self.keys.shape[1]
        least, more = divmod(radius - blocks + 1, blocks)  # were each block past its bound, more than radius bits would differ
        self.bounds = np.array([least + (i < more) for i in range(blocks)])
        self.masks = [_masks(int(b)) if b >= 0 else np.empty(0, dtype=np.uint16) for b in self.bounds]
        self.order = np.argsort(self.keys, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.keys, self.order, axis=0)

    def candidates(self, value: np.ndarray) -> np.ndarray:
        """All indices that are within the bound of a block of value: by probing its keys, or all keys where they are fewer."""
        own = np.ascontiguousarray(value).view(np.uint16)
        if len(self.prints) <= len(self.masks[0]):
            return np.flatnonzero((np.bitwise_count(self.keys ^ own) <= self.bounds).any(axis=1))
        found = []
        for block, masks in enumerate(self.masks):
            probes = masks ^ own[block]
            column = self.sorted[:, block]
            first, last = np.searchsorted(column, probes, "left"), np.searchsorted(column, probes, "right")
            some = last > first
            first, n = first[some], (last - first)[some]
            at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            found.append(self.order[at, block])
        return np.unique(np.concatenate(found))

    def within(self, value: np.ndarray) -> np.ndarray:
        """All indices whose fingerprints differ from value in at most radius bits."""
        some = self.candidates(value)
        return some[np.bitwise_count(self.prints[some] ^ value).sum(axis=1) <= self.radius]


class Item(NamedTuple):
    id: object
    words: int
    shingles: np.ndarray
    seen: list[int]  # how many different items hold each shingle, of all items and not of the pass


class Items:
    """The items of one pass that have shingles of k words, weighed by rarity or all alike."""

    def __init__(self, k: int, items: list[Item], rarity: bool = True):
        self.k, self.ids, self.rarity, sets = k, [x.id for x in items], rarity, [x.shingles for x in items]
        self.words = np.array([x.words for x in items])
        seen = {s: n for x in items for s, n in zip(x.shingles.tolist(), x.seen, strict=True)}
        self.keys = np.array(sorted(seen), dtype=np.uint64)
        self.weights = np.array([1 / seen[s] if rarity else 1.0 for s in self.keys.tolist()])
        # shingles of items with a shared one: a document without them has the same similarities in both ways
        self.differs = np.isin(self.keys, np.concatenate([x.shingles for x in items if max(x.seen) > 1] or [self.keys[:0]]))
        self.counts = [dict(Counter(x.tolist())) for x in sets]
        self.prints = np.array([fingerprint(spread(x, self.weight(x)).sum(axis=0)) for x in sets], dtype=np.uint64).reshape(-1, 2)
        lengths = defaultdict(set)
        for n, x in zip(self.words.tolist(), sets, strict=True):
            for s in x.tolist():
                lengths[s].add(n)
        self.lengths = [sorted(lengths[s]) for s in self.keys.tolist()]
        self.by_length = {n: (at := np.flatnonzero(self.words == n), MultiIndex(self.prints[at])) for n in set(self.words.tolist())}
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[self.keys >> np.uint64(44)] = True

    def weight(self, shingles: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, shingles), len(self.keys) - 1)
        return np.where(self.keys[at] == shingles, self.weights[at], 1.0)

    def hits(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where shingles of the items are, and which."""
        some = np.flatnonzero(self.maybe[shingles >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, shingles[some]), len(self.keys) - 1)
        same = self.keys[at] == shingles[some]
        return some[same], at[same]

    def similarity(self, item: int, window: np.ndarray, weights: np.ndarray) -> float:
        weight, mine, theirs = dict(zip(window.tolist(), weights.tolist(), strict=True)), Counter(window.tolist()), self.counts[item]
        least = sum(min(n, mine[s]) * weight[s] for s, n in theirs.items() if s in mine)
        total = sum(n * weight[s] for s, n in mine.items()) + sum(n * float(self.weight(np.array([s], dtype=np.uint64))[0]) for s, n in theirs.items())
        return least / (total - least) if total else 0.0


def matches(items: Items, shingles: np.ndarray, hits: np.ndarray, which: np.ndarray, n_words: int, threshold: float) -> dict[int, tuple[float, int, int]]:
    """item -> (similarity, first word, words) of the best window of one document, the first among equals.

    shingles: those of the document, in order; hits and which: where shingles of items are, and which.
    """
    k, best = items.k, {}
    by_length: dict[int, list[int]] = defaultdict(list)
    for p, w in zip(hits.tolist(), which.tolist(), strict=True):
        for n in items.lengths[w]:
            by_length[n].append(p)
    for n, places in by_length.items():
        at = np.array(places)
        last = max(0, n_words - n)
        starts = np.unique(np.clip(at[:, None] + k - n + np.arange(n - k + 1)[None, :], 0, last))
        size = min(n, n_words) - k + 1
        chosen, index = items.by_length[n]
        for part in np.split(starts, np.flatnonzero((np.diff(starts) > n) | (np.arange(1, len(starts)) % STARTS == 0)) + 1):
            a = int(part[0])
            local = shingles[a : int(part[-1]) + size]
            weights = items.weight(local)
            sums = np.zeros((len(local) + 1, BITS))
            np.cumsum(spread(local, weights), axis=0, out=sums[1:])
            prints = fingerprint(np.round(sums[part - a + size] - sums[part - a], 9))
            for start, value in zip((part - a).tolist(), prints, strict=True):
                for i in chosen[index.within(value)].tolist():
                    found = items.similarity(i, local[start : start + size], weights[start : start + size])
                    if found >= threshold and (i not in best or (found, -(a + start)) > (best[i][0], -best[i][1])):
                        best[i] = (found, a + start, min(n, n_words))
    return best


def _passes(benchmark: DataFrame, size: int) -> Iterator[list[Item]]:
    """The items with words, by id, in lists of at most size words or one item. An item that repeats counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for words in words_of(batch.column("text"), lower=True):
                    n = np.diff(words.bounds)
                    sets = [shingle_hashes(words.hashes[a:b], min(SHINGLE_WORDS, b - a)) if b > a else words.hashes[:0] for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(words.lo, len(n)), pa.array(n.astype(np.int64)), long_lists(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))], names=["item_id", "words", "shingles"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", "text").mapInArrow(run, f"item_id {kind}, words bigint, shingles array<bigint>").where("words > 0").distinct()
    seen = items.select("shingles").distinct().select(F.explode(F.array_distinct("shingles")).alias("s")).groupBy("s").agg(F.count("*").alias("n"))
    each = items.select("*", F.posexplode("shingles").alias("at", "s")).join(seen, "s").groupBy("item_id", "words", "shingles").agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("seen"))
    held, words = [], 0
    for row in each.orderBy("item_id", "shingles").toLocalIterator():
        if held and words + row.words > size:
            yield held
            held, words = [], 0
        held.append(Item(row.item_id, row.words, np.array(row.shingles, dtype=np.int64).view(np.uint64), [x.n for x in row.seen]))
        words += row.words
    if held:
        yield held


def _both(k: int, items: list[Item]) -> list[Items]:
    """The items weighed alike and, where that differs, by rarity: two indexes of the same items in the same order."""
    return [Items(k, items, rarity) for rarity in ((False, True) if any(n > 1 for x in items for n in x.seen) else (False,))]


def _indexes(spark, benchmark: DataFrame, pass_words: int) -> Iterator:
    """Each pass's index, sent to the executors: at most pass_words words, or one item."""
    with np.errstate(over="ignore"):
        for items in _passes(benchmark, pass_words):
            groups = defaultdict(list)
            for item in items:
                groups[min(SHINGLE_WORDS, item.words)].append(item)
            yield spark.sparkContext.broadcast([index for k, group in sorted(groups.items()) for index in _both(k, group)])


def _found(column: pa.Array, index: list[Items], threshold: float) -> Iterator[tuple[int, object, int, int, float]]:
    """(row, item id, first word, words, similarity) of the texts of a column."""
    with np.errstate(over="ignore"):
        for words in words_of(column, lower=True):
            best: dict[tuple[int, int, int], tuple[float, int, int]] = {}  # (row, k, item) -> (similarity, first word, words)
            names = {}
            for items in index:
                if not items.rarity:  # the index by rarity follows that of the same items weighed alike
                    shingles = shingle_hashes(words.hashes, items.k)
                    places, which = items.hits(shingles) if len(shingles) else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
                    row = np.searchsorted(words.bounds, places, "right") - 1
                    inside = places + items.k <= words.bounds[row + 1]
                    places, which, row = places[inside], which[inside], row[inside]
                for r in np.unique(row[items.differs[which]] if items.rarity else row).tolist():
                    a, b = words.bounds[r : r + 2]
                    mine = row == r
                    for i, (near, first, n) in matches(items, shingles[a : b - items.k + 1], places[mine] - a, which[mine], int(b - a), threshold).items():
                        at = (words.lo + r, items.k, i)
                        names[at] = items.ids[i]
                        if at not in best or (near, -first) > (best[at][0], -best[at][1]):
                            best[at] = (near, first, n)
            for at, (near, first, n) in sorted(best.items()):
                yield at[0], names[at], first, n, near


def find(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, pass_words: int = PASS_WORDS) -> DataFrame:
    """One row per document and item that it holds: doc_id, item_id, first_word, n_words, similarity.

    docs (doc_id, text), benchmark (item_id, text). The row tells the best window; where several are as good, the
    first. Null and empty texts match nothing, on either side. Rows that repeat are matched alike; other columns are
    ignored; an empty table on either side gives an empty result.
    """
    small_batches(docs.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id bigint, item_id {kind}, first_word int, n_words int, similarity double"
    names, kinds = ["doc_id", "item_id", "first_word", "n_words", "similarity"], [pa.int64(), None, pa.int32(), pa.int32(), pa.float64()]

    def search(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("doc_id")
                out = [(ids[r].as_py(), *rest) for r, *rest in _found(batch.column("text"), index.value, threshold)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    found = [search(index) for index in _indexes(docs.sparkSession, benchmark, pass_words)]
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, pass_words: int = PASS_WORDS) -> DataFrame:
    """docs without the rows whose text holds an item; all columns stay, and nothing is shuffled."""
    small_batches(docs.sparkSession)

    def keep(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good = np.ones(len(batch), dtype=bool)
                for r, *_ in _found(batch.column("text"), index.value, threshold):
                    good[r] = False
                yield batch.filter(pa.array(good))

        return run

    for index in _indexes(docs.sparkSession, benchmark, pass_words):
        docs = docs.mapInArrow(keep(index), docs.schema)
    return docs
