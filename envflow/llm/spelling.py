"""Spelling variant grouping by Levenshtein automata over trie shards.

The words with their counts are put in order by ranges, and tasks build compact tries of neighbouring ranges, ``SHARD_WORDS`` words
each at most. One shard at a time is broadcast: its bytes are bounded by ``SHARD_WORDS`` and ``SHARD_BYTES`` whatever the
input, and the driver holds one. Every task walks the automaton of each of its words, which accepts what is exactly one
edit away, depth-first over the shard; a branch that the automaton can't follow ends there. Of the accepting neighbours a task keeps
their number and the best of them, so what is written is a row for each word and shard that has any, and shards are reduced
by one aggregate. A chain of forms at least doubles the count at each step, so the roots are found by a few rounds of joins.
"""

from __future__ import annotations

import pickle
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import discard, n_partitions, scratch, written

#: Runs of letters of Latin-1: a code point is one byte of that encoding, and its bytes are in code-point order.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_COUNT = 5, 3
#: One run in so many is written with a letter missing, chosen by its hash.
MISSING = 97
#: Words of a trie shard and bytes of their letters, at most (a single word is a shard whatever its length).
SHARD_WORDS, SHARD_BYTES = 500_000, 8 << 20
#: Words that a task looks up in a shard, about.
ASKED = 5_000


def observed(doc_id: Column, run: Column) -> Column:
    """The word that a run of a document is taken for: one letter of some runs is deleted, by the crc32 of ``<doc_id>:<run>``."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % MISSING == 0, short).otherwise(run)


def word_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of docs (doc_id, text) that are long and frequent enough. A row without an id has its runs as they are."""
    runs = docs.where("text IS NOT NULL").select("doc_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_chars)
    words = runs.select(F.coalesce(observed(F.col("doc_id"), F.col("run")), F.col("run")).alias("word")).where(F.char_length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Trie:
    """A compact trie of sorted words: nodes numbered level by level, so that a node's children are neighbours.

    labels has each node's letter; children of node v are the nodes first[v]..first[v + 1] - 1; word[v] is the number of the word
    that ends at v, or -1. Node 0 is the root. A node takes nine bytes, a word its letters and sixteen more.
    """

    __slots__ = ("at", "counts", "first", "labels", "letters", "word")

    def __init__(self, words: list[bytes], counts: list[int]):
        n = len(words)
        data, lens = np.frombuffer(b"".join(words), dtype=np.uint8), np.array([len(w) for w in words], dtype=np.int64)
        at = np.cumsum(lens) - lens
        alive, parent = np.arange(n), np.zeros(n, dtype=np.int64)
        labels, parents, ends, nodes, depth = [np.zeros(1, dtype=np.uint8)], [], [], 1, 0
        while len(alive):
            letter = data[at[alive] + depth]
            new = np.ones(len(alive), dtype=bool)
            new[1:] = (parent[1:] != parent[:-1]) | (letter[1:] != letter[:-1])
            node = nodes + np.cumsum(new) - 1
            labels.append(letter[new])
            parents.append(parent[new])
            nodes += int(new.sum())
            depth += 1
            done = lens[alive] == depth
            ends.append((node[done], alive[done]))
            alive, parent = alive[~done], node[~done]
        self.labels = np.concatenate(labels).tobytes()
        children = np.bincount(np.concatenate(parents), minlength=nodes) if parents else np.zeros(nodes, dtype=np.int64)
        word = np.full(nodes, -1, dtype=np.int32)
        for node, which in ends:
            word[node] = which
        self.first = array("I", (np.concatenate(([0], np.cumsum(children))) + 1).astype(np.uint32).tobytes())
        self.word, self.counts = array("i", word.tobytes()), array("q", counts)
        self.letters, self.at = data.tobytes(), array("q", np.append(at, len(data)).astype(np.int64).tobytes())

    def text(self, which: int) -> bytes:
        return self.letters[self.at[which] : self.at[which + 1]]

    def near(self, query: bytes) -> list[int]:
        """The numbers of the words that are exactly one inserted, deleted or replaced letter away, each once.

        A stack of automaton states, walked depth-first: (node, letters of query consumed) before the edit; after it the
        rest has only one way to go.
        """
        labels, first, word, n, found = self.labels, self.first, self.word, len(query), []

        def rest(node: int, i: int) -> None:
            while i < n:
                node = labels.find(query[i], first[node], first[node + 1])
                if node < 0:
                    return
                i += 1
            if word[node] >= 0:
                found.append(word[node])

        stack, find = [(0, 0)], labels.find
        while stack:
            node, i = stack.pop()
            here = query[i] if i < n else -1
            for child in range(first[node], first[node + 1]):
                if labels[child] == here:
                    stack.append((child, i + 1))
                    continue
                # inserted before here, or in its place: what must follow is looked up at once, as it seldom does. A letter that repeats
                # the next one of query is inserted after it instead, so each word comes up once
                low, high = first[child], first[child + 1]
                if i + 1 < n:
                    if low < high:
                        if (at := find(here, low, high)) >= 0:
                            rest(at, i + 1)
                        if (at := find(query[i + 1], low, high)) >= 0:
                            rest(at, i + 2)
                else:
                    if i < n and low < high and (at := find(here, low, high)) >= 0:
                        rest(at, i + 1)
                    if word[child] >= 0:
                        found.append(word[child])
            if i < n and (i + 1 == n or query[i + 1] != here):
                rest(node, i + 1)
        return found


def _pieces(words: int, size: int):
    """(piece, words, bytes): a sorted range (word, n) in pieces of at most so many words and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, held_bytes = [], [], 0

        def piece() -> pa.RecordBatch:
            values = (pickle.dumps((held, counts)), len(held), held_bytes)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["piece", "words", "bytes"])

        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                letters = word.encode("latin-1")
                if held and (len(held) >= words or held_bytes + len(letters) > size):
                    yield piece()
                    held, counts, held_bytes = [], [], 0
                held.append(letters)
                counts.append(n)
                held_bytes += len(letters)
        if held:
            yield piece()

    return run


def _bundles(pieces: list[tuple[int, int, int]], words: int, size: int) -> list[tuple[int, int]]:
    """(id, shard): neighbouring pieces (id, words, bytes) are one shard as long as it stays within words and size."""
    out, shard, held, held_bytes = [], 0, 0, 0
    for id_, n, length in sorted(pieces):
        if held and (held + n > words or held_bytes + length > size):
            shard, held, held_bytes = shard + 1, 0, 0
        out.append((id_, shard))
        held, held_bytes = held + n, held_bytes + length
    return out


def tries(words: DataFrame, shard_words: int = SHARD_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(shard, trie): the pickled tries of words (word, n), few rows however many ranges Spark has cut the words into.

    The driver learns the sizes of pieces alone, a row for each range or shard; tasks put them together.
    """
    spark, total = words.sparkSession, words.count()
    in_order = words.repartitionByRange(max(1, min(n_partitions(spark), total // shard_words + 1)), "word").sortWithinPartitions("word")
    pieces = written(in_order.mapInArrow(_pieces(shard_words, shard_bytes), "piece binary, words bigint, bytes bigint").withColumn("id", F.monotonically_increasing_id()), "pieces")
    bundles = _bundles([tuple(r) for r in pieces.select("id", "words", "bytes").collect()], shard_words, shard_bytes)

    def build(frame):
        import pandas as pd

        letters, counts = [], []
        for piece in frame.sort_values("id")["piece"]:
            more, n = pickle.loads(piece)
            letters, counts = letters + more, counts + n
        return pd.DataFrame({"shard": frame["shard"].iloc[:1], "trie": [pickle.dumps(Trie(letters, counts))]})

    of = spark.createDataFrame(bundles, "id bigint, shard int")
    return written(pieces.join(F.broadcast(of), "id").groupBy("shard").applyInPandas(build, "shard int, trie binary"), "tries")


_FOUND = "word string, n_near bigint, best_n bigint, best string"


_LOADED: dict[str, Trie] = {}


def _loaded(key: str, broadcast) -> Trie:
    """The trie of a broadcast shard, made once in a worker process; the one before it goes."""
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = pickle.loads(broadcast.value)
    return _LOADED[key]


def _intersect(key: str, broadcast):
    """_FOUND of the words that have neighbours in a shard: how many, and the most frequent, the first in code-point order of equals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _loaded(key, broadcast)
        counts = trie.counts
        for batch in batches:
            out = []
            for word in batch.column("word").to_pylist():
                found = trie.near(word.encode("latin-1"))
                if found:
                    most = max(counts[i] for i in found)
                    best = min(i for i in found if counts[i] == most)  # words are numbered in their order
                    out.append((word, len(found), most, trie.text(best).decode("latin-1")))
            if out:
                cols = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=[x.split()[0] for x in _FOUND.split(", ")])

    return run


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(word, n_near, best, best_n) of the words (word, n; each word once) that have a near word: every word meets every shard."""
    spark, context, total = words.sparkSession, words.sparkSession.sparkContext, words.count()
    shards = tries(words, shard_words, shard_bytes)
    asked, parts = written(words.select("word").repartition(max(context.defaultParallelism, total // ASKED), "word"), "asked"), []
    for row in shards.select("shard").collect():
        sent = context.broadcast(bytes(shards.where(F.col("shard") == row.shard).first().trie))
        parts.append(written(asked.mapInArrow(_intersect(uuid.uuid4().hex, sent), _FOUND), "near"))
        sent.destroy()
    found = parts[0] if parts else spark.createDataFrame([], _FOUND)
    for part in parts[1:]:
        found = found.unionByName(part)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("at")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("at.best").alias("best"), (-F.col("at.less")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last. Each round goes twice as far as the one before."""
    at = written(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        # a word without a form is its own root: only the others, each the root of some words, have to be looked up
        further = at.where("word <> root").select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = written(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        discard(at)
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        path = now.written_to
        at = now.select("word", "root")
        at.written_to = path


def variants(docs: DataFrame, factor: int = 2, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, shard_words: int = SHARD_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per word of docs (doc_id, text): word, form, root, n, n_near, form_n.

    Words are the runs of letters of Latin-1, A-Z in lower case, of at least least_chars letters and least_count occurrences.
    Near words differ by exactly one letter. form is the near word with the largest n (of equals the first in code-point order)
    where that is at least factor times the word's own n, else null; root is where forms lead to. factor is at least 2.
    Null and empty texts have no words; a repeated row counts again; rows without an id have no deleted letters. Other columns are
    ignored; an empty table gives an empty result. A word may be of any length.
    """
    if factor < 2:
        raise ValueError("forms end only where each is more frequent than the last")
    with scratch() as made:
        words = written(word_counts(docs, least_chars, least_count), "words")
        near = near_words(words, shard_words, shard_bytes)
        is_form = F.col("best_n") >= factor * F.col("n")
        joined = words.join(near, "word", "left")
        formed = joined.select("word", F.when(is_form, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n"))
        formed = written(formed, "forms")
        out = written(formed.join(roots(formed), "word").select("word", "form", "root", "n", "n_near", "form_n"), "variants")
        made.remove(out)
    return out
