"""Substring dedup by relative Lempel-Ziv parsing against an index of every document's reference blocks.

Index: every document is cut into reference blocks by content. A window of ``min_words`` words has as its anchor the
leftmost smallest hash among its k-word grams, k being half of min_words; consecutive windows with the same anchor
make one block. As the anchor depends on the window's words alone, equal windows have equal anchors, so every copy
of a window lies in blocks of one anchor, and one shuffle by anchor finds them all: no document is skipped. Anchors are
counted first, and only blocks whose anchor occurs again are kept; the others are literals.

Sources: where all blocks of an anchor hold the same words, the first and the last of them (by document and offset) are the
sources of all. Where they differ, one example of each different block is opened, and each of its windows has as sources
the first and the last place of that window in any block; thousands of copies cost one example.

Parse: a document is factored greedily from left to right. At a matched window the parser takes the source, of the two,
that the document agrees with for longer, other than the window's own place, and follows it through block after block while the next
window continues it: the factor is (source document, source offset, length). Where it ends, the windows that cross its
boundary are checked in turn: if one of them has a source of its own, the next factor begins there and overlaps the
last; if not, literals follow. Factors are at least min_words words long, and their words are the duplicate spans. The windows
are those of the input: nothing is removed while it is judged. Windows are compared by 64-bit hashes within a 64-bit anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import discard, mix, signed, small_batches, splittable, words_of, written

MIN_WORDS = 35
_R = 0x9E3779B97F4A7C55
_R_INVERSE = pow(_R, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    if base not in _POWERS or len(_POWERS[base]) < n:
        steps = np.full(max(n, 1 << 18), base, dtype=np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS[base]


class Ranges:
    """Hashes of any ranges of words, each in constant time, from one prefix sum."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * _powers(_R, n)[:n], out=self.sums[1:])

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the words first..last-1."""
        value = (self.sums[last] - self.sums[first]) * _powers(_R_INVERSE, len(self.sums))[first]
        return mix(value + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def gram_words(min_words: int) -> int:
    """Words in a gram: half of a window, and more where a block's windows would not fit the bits of a long."""
    return max((min_words + 1) // 2, min_words - 62)


def _anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """The position of the leftmost smallest of grams[i : i + span], for every i."""
    value, at, width = grams, np.arange(len(grams)), 1
    while width < span:
        step = min(width, span - width)
        right = value[step:] < value[:-step]
        value, at = np.where(right, value[step:], value[:-step]), np.where(right, at[step:], at[:-step])
        width += step
    return at


#: A place is a block's first window and its number of windows, in one number.
PLACE = 64


def _cut(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[tuple]:
    """(docs, rows, anchor, block, first, n) of the blocks of rows (doc, row, text)."""
    k = gram_words(min_words)
    with np.errstate(over="ignore"):
        for batch in batches:
            docs, rows = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "row"))
            for words in words_of(batch.column("text")):
                total = len(words.hashes)
                if total < min_words:
                    continue
                ranges, at = Ranges(words.hashes), np.arange(total - k + 1)
                grams = ranges(at, at + k)
                anchor = _anchors(grams, min_words - k + 1)
                row = np.repeat(np.arange(len(words.bounds) - 1), np.diff(words.bounds))
                inside = row[: len(anchor)] == row[min_words - 1 :]
                new = inside.copy()
                new[1:] &= ~inside[:-1] | (anchor[1:] != anchor[:-1])
                start = np.flatnonzero(new)
                if not len(start):
                    continue
                count = np.add.reduceat(inside.astype(np.int64), start)  # windows outside a row count 0
                row = row[start]
                yield docs[words.lo + row], rows[words.lo + row], signed(grams[anchor[start]]), lambda ranges=ranges, start=start, count=count: signed(ranges(start, start + count + min_words - 1)), start - words.bounds[row], count


def _anchor_counts(min_words: int):
    """(anchor, seen): the anchors of a piece of the documents, counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, anchor, _, _, _ in _cut(batches, min_words):
            values, seen = np.unique(anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(seen)], names=["anchor", "seen"])

    return run


def _blocks(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, row, anchor, block, first, n in _cut(batches, min_words):
            yield pa.RecordBatch.from_arrays([*map(pa.array, (doc, row, anchor, block(), first * PLACE + n))], names=["doc", "row", "anchor", "block", "place"])

    return run


_ASKED = ("anchor", "block", "copies", "lo_doc", "lo", "hi_doc", "hi")


def _windows(min_words: int):
    """_ASKED and windows: hashes of the windows of the blocks asked for. Of rows that repeat, a task answers for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answered: set[int] = set()
        with np.errstate(over="ignore"):
            for batch in batches:
                new = []
                for i, row in enumerate(batch.column("row").to_pylist()):
                    if row not in answered:
                        answered.add(row)
                        new.append(i)
                batch = batch.take(pa.array(new, pa.int64()))
                asked = batch.column("asked")
                for words in words_of(batch.column("text")):
                    if not len(words.hashes):
                        continue
                    ranges = Ranges(words.hashes)
                    part = asked.slice(words.lo, words.hi - words.lo)
                    flat, sizes = part.flatten(), np.diff(part.offsets.to_numpy())
                    row = np.repeat(np.arange(len(sizes)), sizes)
                    field = {f: flat.field(f).to_numpy() for f in (*_ASKED, "place")}
                    first, n = words.bounds[row] + field["place"] // PLACE, field["place"] % PLACE
                    fit = first + n + min_words - 1 <= words.bounds[row + 1]
                    fit[fit] = signed(ranges(first[fit], (first + n + min_words - 1)[fit])) == field["block"][fit]
                    first, n = first[fit], n[fit]
                    bounds = np.concatenate(([0], np.cumsum(n)))
                    at = np.repeat(first - bounds[:-1], n) + np.arange(bounds[-1])
                    values = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(ranges(at, at + min_words))))
                    yield pa.RecordBatch.from_arrays([*(pa.array(field[f][fit]) for f in _ASKED), values], names=[*_ASKED, "windows"])

    return run


class Sources:
    """Of each window of a document, whether it matches and the places (document, first word) of its two sources."""

    def __init__(self, windows: int):
        self.matched = np.zeros(windows, dtype=bool)
        self.doc, self.first = np.zeros((2, windows), dtype=np.int64), np.zeros((2, windows), dtype=np.int64)

    def put(self, first: np.ndarray, n: np.ndarray, block: np.ndarray, mask: np.ndarray, places: list[np.ndarray]) -> None:
        """Runs of blocks: block tells each run's block, of n windows from window first on, and mask which of them are in the run.

        places are those of the block's window 0: the documents and first words of both sources.
        """
        n = n[block]
        run = np.repeat(np.arange(len(block)), n)
        j = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
        some = (mask[run] >> j) & 1 == 1
        run, j = run[some], j[some]
        at = first[block[run]] + j
        self.matched[at] = True
        for role in (0, 1):
            self.doc[role, at], self.first[role, at] = places[2 * role][run], places[2 * role + 1][run] + j


def factors(own: int, sources: Sources, min_words: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (first word, words, source document, source's first word) of document own.

    A factor begins at the first matched window that the last one does not reach, and follows the source that goes on
    for longer. A window's own place is no source, unless a row that repeats the document gives no other.
    """
    matched, at = sources.matched, np.arange(len(sources.matched))
    here = (sources.doc == own) & (sources.first == at[None, :])
    usable = matched & (~here | here.all(axis=0))
    goes_on = usable[:, :-1] & usable[:, 1:] & (sources.doc[:, 1:] == sources.doc[:, :-1]) & (sources.first[:, 1:] == sources.first[:, :-1] + 1)
    stops = [np.flatnonzero(np.append(~role, True)) for role in goes_on]  # a run's last window, by role
    starts, out, now = np.flatnonzero(matched), [], 0
    while now < len(starts):
        i = int(starts[now])
        reach = [int(stops[role][np.searchsorted(stops[role], i)]) if usable[role, i] else -1 for role in (0, 1)]
        role = int(reach[1] > reach[0])
        out.append((i, reach[role] - i + min_words, int(sources.doc[role, i]), int(sources.first[role, i])))
        now = int(np.searchsorted(starts, reach[role] + 1))
    return out


_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, kept_sha256 string, spans array<struct<first:int,n:int,source:bigint,source_first:int>>"


def _parse(min_words: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, docs, out = batch.column("hits"), batch.column("doc").to_pylist(), []
            some = hits.is_valid().to_numpy(zero_copy_only=False)
            texts = batch.column("text")
            found: dict[int, list] = {}
            chosen = np.flatnonzero(some)
            with np.errstate(over="ignore"):
                for words in words_of(texts.take(pa.array(chosen))):
                    ranges = Ranges(words.hashes)
                    for r in range(words.lo, words.hi):
                        a, b = words.bounds[r - words.lo : r - words.lo + 2]
                        flat = hits[int(chosen[r])].values
                        block, place = flat.field("block").to_numpy(), flat.field("place").to_numpy()
                        first, n = a + place // PLACE, place % PLACE
                        fit = first + n + min_words - 1 <= b
                        fit[fit] = signed(ranges(first[fit], (first + n + min_words - 1)[fit])) == block[fit]
                        runs, sources = flat.field("runs"), Sources(max(0, b - a - min_words + 1))
                        bounds = runs.offsets.to_numpy()
                        owner = np.repeat(np.arange(len(first)), np.diff(bounds))
                        runs = runs.values.slice(bounds[0], bounds[-1] - bounds[0])
                        mask, *places = (runs.field(f).to_numpy()[fit[owner]] for f in ("mask", "lo_doc", "lo", "hi_doc", "hi"))
                        sources.put(first - a, n, owner[fit[owner]], mask, places)
                        found[int(chosen[r])] = factors(docs[int(chosen[r])], sources, min_words)
            for i in range(len(batch)):
                words = (texts[i].as_py() or "").encode().split()
                spans = found.get(i, [])
                kept, at, gone = [], 0, 0
                for first, n, *_ in spans:
                    kept += words[at:first] if first > at else []
                    gone += max(0, first + n - max(at, first))
                    at = max(at, first + n)
                kept = b" ".join(kept + words[at:] if spans else words)
                out.append((len(words), gone, kept.decode() if with_text else None, hashlib.sha256(kept).hexdigest(), [dict(zip(_SPAN, span, strict=True)) for span in spans]))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([(f, pa.int64() if f == "source" else pa.int32()) for f in _SPAN]))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "spans"])

    return run


_SPAN = ("first", "n", "source", "source_first")


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, with_text: bool = True) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_words, n_removed, kept_text, kept_sha256, spans.

    A word goes if a window of min_words consecutive words that covers it also starts anywhere else, in the same
    document or another one. Null and empty texts, and texts shorter than a window, keep all their words (none).
    A repeated row is another place where its windows start, so both rows lose them. Rows without an id are judged
    too, by a hash of their text. What a row needs is collected by its id and text together, so rows that share an id don't mix and
    are dealt out one by one; what rows that repeat have in common is collected once.
    Other columns are ignored. spans are the factors, in words of the input: first, n, source (the id of the document that
    has them too, or the hash of its text where it has none) and source_first, the word of source that they begin at.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.coalesce("doc_id", F.xxhash64("text")).alias("doc"), F.xxhash64("doc_id", "text").alias("row"), "text")
    texts = docs.select("doc", "row", "text").where("text IS NOT NULL")
    often = texts.mapInArrow(_anchor_counts(min_words), "anchor bigint, seen bigint").groupBy("anchor").agg(F.sum("seen").alias("seen"))
    often = written(often.where("seen > 1").select("anchor"), "often")
    blocks = texts.mapInArrow(_blocks(min_words), "doc bigint, row bigint, anchor bigint, block bigint, place bigint")
    again = written(blocks.join(often, "anchor"), "again")
    discard(often)
    # one example of each different block of an anchor, with its copies and the first and last of them; copies meet in partial sums
    rows, place = again.count(), F.struct("doc", "place", "row")
    different = written(again.groupBy("anchor", "block").agg(F.count("*").alias("copies"), F.min(place).alias("lo"), F.max(place).alias("hi")), "different")
    alike = different.groupBy("anchor").agg((F.min("block") == F.max("block")).alias("alike"))
    first_of = lambda x: F.expr(f"{x}.place div {PLACE}").alias(x)
    flagged = different.join(splittable(alike, "alike", rows), "anchor")
    flagged = written(flagged.select("anchor", "block", "copies", "alike", F.col("lo.place").alias("place"), F.col("lo.row").alias("row"), F.col("lo.doc").alias("lo_doc"), first_of("lo"), F.col("hi.doc").alias("hi_doc"), first_of("hi")), "flagged")
    discard(different)
    asked = written(flagged.where("NOT alike").groupBy("row").agg(F.collect_list(F.struct(*_ASKED, "place")).alias("asked")), "asked")
    opened = texts.join(asked, "row").mapInArrow(_windows(min_words), ", ".join(f"{c} bigint" for c in _ASKED) + ", windows array<bigint>")
    opened = written(opened.dropDuplicates(["anchor", "block"]), "opened")  # rows that repeat may answer in several tasks
    single = opened.select(*_ASKED, F.posexplode("windows").alias("j", "hash"))
    lo, hi = F.min(F.struct("lo_doc", (F.col("lo") + F.col("j")).alias("lo"))).alias("x"), F.max(F.struct("hi_doc", (F.col("hi") + F.col("j")).alias("hi"))).alias("y")
    twice = splittable(single.groupBy("anchor", "hash").agg(F.sum("copies").alias("seen"), lo, hi).where("seen > 1").drop("seen"), "twice", rows)
    base = [F.col("x.lo_doc").alias("lo_doc"), (F.col("x.lo") - F.col("j")).alias("lo"), F.col("y.hi_doc").alias("hi_doc"), (F.col("y.hi") - F.col("j")).alias("hi")]
    # windows of a block with the same two sources, at the same distance, are one run
    matched = single.select("anchor", "block", "hash", "j").join(twice, ["anchor", "hash"]).select("anchor", "block", "j", *base).repartition("anchor", "block")
    runs = matched.groupBy("anchor", "block", "lo_doc", "lo", "hi_doc", "hi").agg(F.bit_or(F.expr("shiftleft(1L, j)")).alias("mask"))
    run = F.struct("mask", "lo_doc", "lo", "hi_doc", "hi")
    whole = flagged.where("alike").withColumn("mask", F.lit(-1).cast("bigint")).select("anchor", "block", F.array(run).alias("runs"))
    sources = written(whole.unionAll(runs.groupBy("anchor", "block").agg(F.collect_list(run).alias("runs"))), "sources")
    discard(flagged, asked, opened)
    # a set, as rows that repeat have the same blocks
    hits = again.join(sources, ["anchor", "block"]).groupBy("row").agg(F.collect_set(F.struct("block", "place", "runs")).alias("hits"))
    hits = written(hits, "hits")
    discard(again, sources)
    return docs.join(hits, "row", "left").select("doc_id", "doc", "text", "hits").mapInArrow(_parse(min_words, with_text), _KEPT)
