"""Document fingerprints by MinHash.

A document's set is its five-word shingles; a text of one to four words has its whole sequence as its only shingle.
A fingerprint holds, for each of ``N_HASHES`` universal hash functions ``(a * x + b) mod 2**64`` with odd a, 16 bits
of the smallest value over the set, as four hexadecimal digits. The smallest value is mixed first: its own upper bits
are nearly all zero for large sets, so they would agree for sets that have nothing in common. Texts without words have the
fingerprint of their white space (the empty text: of nothing). Equal texts have equal fingerprints.

``fingerprints`` adds the fingerprint. ``with_neighbours`` pairs every document with the next one by descending id.
``near_duplicates`` joins bands of signatures in Spark and verifies the exact Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import discard, few, long_lists, mix, n_partitions, scratch, sequence_hash, shingle_hashes, small_batches, stream, word_hash, words_of, written
from envflow.llm.components import connected_components
from envflow.llm.jaccard_join import join_lists, parity

SHINGLE_WORDS = 5
N_HASHES = 128
#: Bands of so many hashes: at similarity 0.8, 21 bands of 6 miss a pair with probability (1 - 0.8**6)**21 < 0.002.
BAND_HASHES = 6
#: Shingles of a document that are hashed at a time, which bounds memory for very long texts.
BLOCK = 4096
_A, _B = stream(41, N_HASHES), stream(42, N_HASHES)


_MOST = np.iinfo(np.uint64).max


def least(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over some shingles; minima of parts give that of the whole."""
    out = np.full(N_HASHES, _MOST, dtype=np.uint64)
    for at in range(0, len(shingles), BLOCK):
        values = shingles[at : at + BLOCK][None, :] * _A[:, None]
        values += _B[:, None]
        np.minimum(out, values.min(axis=1), out=out)
    return out


def sealed(minima: np.ndarray) -> np.ndarray:
    """N_HASHES values of 16 bits from the smallest values."""
    return (mix(minima) & np.uint64(0xFFFF)).astype(np.uint16)


def signature(shingles: np.ndarray) -> np.ndarray:
    """N_HASHES values of 16 bits."""
    return sealed(least(shingles))


def shingle_sets(words, k: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The shingles of each row of words, not made distinct: a minimum doesn't need it."""
    every = shingle_hashes(words.hashes, k)
    for a, b, row in zip(words.bounds[:-1], words.bounds[1:], range(words.lo, words.hi), strict=True):
        if b - a >= k:
            yield every[a : b - k + 1]
        elif b > a:
            yield np.array([sequence_hash(words.hashes[a:b])], dtype=np.uint64)
        else:
            yield _nothing(words.text(row))


def signatures(column: pa.Array) -> np.ndarray:
    out = np.empty((len(column), N_HASHES), dtype=np.uint16)
    with np.errstate(over="ignore"):
        for words in words_of(column):
            for row, shingles in enumerate(shingle_sets(words), words.lo):
                out[row] = signature(shingles)
    return out


def hexadecimal(values: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in values.astype(">u2")]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes, row by row: an estimate of the Jaccard similarity."""
    return (a == b).mean(axis=1)


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with fingerprint; a null text counts as empty. Repeated rows and other columns stay."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = signatures(batch.column("text"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hexadecimal(values), pa.string())], names=[*batch.schema.names, "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string, fingerprint string")


def _nothing(text: bytes) -> np.ndarray:
    """The only shingle of a text without words: its white space."""
    return mix(np.frombuffer(hashlib.blake2b(text, digest_size=8).digest(), dtype=np.uint64))


class _Row:
    """A document on its way past its neighbours: its words, and the minima over parts of its shingles, each of which is hashed once.

    Its edited text is its first characters, up to byte cut, and the first of the next document. Words that end before the cut are words of both
    texts (stable of them), and so are the shingles of those words.
    """

    __slots__ = ("cut", "data", "doc", "ends", "hashes", "n_chars", "offsets", "own", "part", "prefix", "shingles", "stable", "starts")

    def __init__(self, part: int, doc: int | None, words, row: int, every: np.ndarray):
        a, b = words.bounds[row - words.lo : row - words.lo + 2]
        base = words.row_starts[row - words.lo]
        self.part, self.doc, self.data = part, doc, words.text(row)
        self.hashes, self.starts, self.ends = words.hashes[a:b], words.starts[a:b] - base, words.ends[a:b] - base
        bytes_ = np.frombuffer(self.data, dtype=np.uint8)
        self.offsets = None if self.data.isascii() else np.flatnonzero((bytes_ & 0xC0) != 0x80)
        self.n_chars = len(bytes_) if self.offsets is None else len(self.offsets)
        self.cut = self.byte_of(self.n_chars - self.n_chars // 2)
        self.stable = int(np.searchsorted(self.ends, self.cut, "left"))
        n = b - a
        self.shingles = every[a : b - SHINGLE_WORDS + 1] if n >= SHINGLE_WORDS else np.array([sequence_hash(self.hashes)], dtype=np.uint64) if n else _nothing(self.data)
        self.own = self.prefix = None

    def byte_of(self, chars: int) -> int:
        return chars if self.offsets is None else int(self.offsets[chars]) if chars < len(self.offsets) else len(self.data)

    def measure(self, first: int = 0, last: int = 0) -> np.ndarray:
        """Sets the minima over all shingles and over those of stable words; gives those over shingles first..last-1."""
        full = len(self.hashes) >= SHINGLE_WORDS
        end = max(0, self.stable - SHINGLE_WORDS + 1) if full else 0
        first, last = (first, last) if full and last > first else (0, 0)
        cuts = sorted({0, end, first, last, len(self.shingles)})
        parts = [(a, b, least(self.shingles[a:b])) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        over = lambda lo, hi: np.minimum.reduce([m for a, b, m in parts if lo <= a and b <= hi] or [np.full(N_HASHES, _MOST, dtype=np.uint64)])
        self.own, self.prefix = over(0, len(self.shingles)), over(0, end)
        return over(first, last)


class _Edit:
    """The edited text of a row x, which ends with the beginning of row y: whose words it has, and the words that neither has."""

    def __init__(self, x: _Row, y: _Row):
        self.x, self.y = x, y
        self.bytes = y.byte_of(min(x.n_chars // 2, y.n_chars))
        tail = x.data[x.starts[x.stable] : x.cut] if x.stable < len(x.starts) and x.starts[x.stable] < x.cut else b""
        merged = bool(tail) and self.bytes > 0 and len(y.starts) > 0 and y.starts[0] == 0
        self.first = int(merged)
        whole = int(np.searchsorted(y.ends, self.bytes, "right"))
        self.last = max(self.first, whole)
        middle = tail + (y.data[: min(int(y.ends[0]), self.bytes)] if merged else b"")
        cut = y.data[y.starts[self.last] : self.bytes] if self.last < len(y.starts) and y.starts[self.last] < self.bytes else b""
        one = lambda word: word_hash(word) if word else np.empty(0, dtype=np.uint64)
        self.middle, self.cut = one(middle), one(cut)

    def shared(self) -> tuple[int, int]:
        """The shingles of y that the edited text has too."""
        return self.first, max(self.first, self.last - SHINGLE_WORDS + 1)

    def text(self) -> bytes:
        return self.x.data[: self.x.cut] + self.y.data[: self.bytes]

    def minima(self, of_y: np.ndarray) -> np.ndarray:
        """The minima over the edited text's shingles, given those over the shingles shared with y."""
        x, y, k = self.x, self.y, SHINGLE_WORDS
        at = x.stable + len(self.middle)  # where the words of y begin
        n = at + self.last - self.first + len(self.cut)
        words = lambda lo, hi: np.concatenate((x.hashes[: x.stable], self.middle, y.hashes[self.first : self.last], self.cut))[lo:hi] if lo < hi else x.hashes[:0]
        if n < k:
            return least(np.array([sequence_hash(words(0, n))], dtype=np.uint64) if n else _nothing(self.text()))
        before, after = max(0, x.stable - k + 1), max(at, at + self.last - self.first - k + 1)
        rest = np.concatenate((shingle_hashes(words(before, min(n, at + k - 1)), k), shingle_hashes(words(after, n), k)))
        return np.minimum.reduce([x.prefix, of_y, least(rest)])


#: Digests and fingerprints are bytes while they travel, which take half of what their digits do.
_NEIGHBOURS = "doc_id bigint, n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, same bigint"


def _in_digits(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def packed(values: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in values.astype(">u2")]


def _same(shingles: np.ndarray, words: int) -> int | None:
    """A hash of a text's set of shingles; null for texts without words."""
    return sequence_hash(np.unique(shingles)) - (1 << 63) if words else None


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by part and in order; the last row of a part is the first of the next part, as a ghost."""
    names = [x.split()[0] for x in _NEIGHBOURS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int64()]
    held: _Row | None = None
    with np.errstate(over="ignore"):
        for batch in batches:
            out, parts, ids = [], batch.column("part").to_pylist(), batch.column("doc_id").to_pylist()
            for words in words_of(batch.column("text")):
                every = shingle_hashes(words.hashes, SHINGLE_WORDS)
                for r in range(words.lo, words.hi):
                    row = _Row(parts[r], ids[r], words, r, every)
                    if held is None or held.part != row.part:
                        row.measure()
                    else:
                        edit = _Edit(held, row)
                        edited = sealed(edit.minima(row.measure(*edit.shared())))
                        own, after = sealed(held.own), sealed(row.own)
                        prints = packed(np.array([own, edited]))
                        out.append((held.doc, held.n_chars, hashlib.sha256(edit.text()).digest(), *prints, float((own == edited).mean()), float((own == after).mean()), _same(held.shingles, len(held.hashes))))
                    held = row
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


#: Rows of a range of documents, about.
RANGE_ROWS = 50_000


def _range_bounds(docs: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, ties): where n ranges of documents begin, from a sample of a bounded number of rows.

    Where many rows share an id, or have none, ties cut inside it, by a hash of the text; else all ties are 0 and no text is read for them.
    """
    share = min(1.0, 32 * n / max(1, docs.count()))
    cut = lambda rows: [rows[len(rows) * i // n] for i in range(1, n)] if rows else []
    found = cut(sorted((r.key, 0) for r in docs.select("key").sample(share, 1).collect()))
    if len(set(found)) < len(found):
        found = cut(sorted((r.key, r.tie) for r in docs.select("key", _tie().alias("tie")).sample(share, 1).collect()))
    found = sorted(set(found))
    return np.array([k for k, _ in found], dtype=np.int64), np.array([t for _, t in found], dtype=np.int64)


def _tie() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _key() -> Column:
    """Descending ids as ascending numbers; rows without an id come last."""
    return F.coalesce(F.bitwise_not("doc_id"), F.lit(2**63 - 1))


def with_neighbours(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text), compared with its edited text and with the next document.

    Next is by descending doc_id, after the last the first; rows with equal ids (repeated rows) are ordered by a hash of their text and by text,
    and rows without an id come last. A single row is its own next. An empty table gives an empty result. same is a hash of the
    set of shingles, null for texts without words.

    Documents are dealt into ranges of ids, of about RANGE_ROWS rows; each range also gets a copy of the first row of the range after it, so
    every row meets its next one without a global sort. An id that very many rows share is several ranges. The driver holds only the ranges' bounds.
    A text is hashed once: of its edited text only the shingles around the seam are new.
    """
    return _in_digits(_neighbours(docs))


def _neighbours(docs: DataFrame) -> DataFrame:
    """with_neighbours with digests and fingerprints in bytes."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text", _key().alias("key"))
    n = max(4 * n_partitions(spark), docs.count() // RANGE_ROWS)
    keys, ties = _range_bounds(docs, n)
    tied = bool(len(ties)) and bool(ties.any())

    @F.pandas_udf("int")
    def part_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(), tie.to_numpy()
        lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        at = hi.copy()
        for a, b in set(zip(lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True)):
            rows = (lo == a) & (hi == b)
            at[rows] = a + np.searchsorted(ties[a:b], t[rows], "right")
        return pd.Series(at, dtype="int32")

    dealt = docs.withColumn("tie", _tie() if tied else F.lit(0).cast("bigint")).withColumn("part", part_of("key", "tie"))
    first = dealt.groupBy("part").agg(F.min(F.struct("key", "tie")).alias("head")).orderBy("part").collect()  # a row for each part
    if not first:
        return spark.createDataFrame([], _NEIGHBOURS)
    before = {row.part: first[i - 1].part for i, row in enumerate(first)}
    heads = spark.createDataFrame([(r.part, r["head"].key, r["head"].tie, before[r.part]) for r in first], "part int, key bigint, tie bigint, before int")
    # of the rows that a part may begin with, the one that sorts first
    ghosts = dealt.join(F.broadcast(heads), ["part", "key", "tie"]).groupBy("before").agg(F.min(F.struct(_tie().alias("h"), F.coalesce("text", F.lit("")).alias("text"))).alias("least"), F.first("doc_id").alias("doc_id"))
    ghosts = ghosts.select(F.col("before").alias("part"), "doc_id", F.col("least.text").alias("text"), F.lit(1).alias("ghost"))
    rows = dealt.select("part", "doc_id", "text", F.lit(0).alias("ghost")).unionByName(ghosts)
    sent = rows.repartition(max(n_partitions(spark), n // 4), "part").sortWithinPartitions("part", "ghost", F.col("doc_id").desc_nulls_last(), _tie(), F.coalesce("text", F.lit("")))
    return sent.select("part", "doc_id", "text").mapInArrow(_pairs, _NEIGHBOURS)


def _bands(signatures_: np.ndarray) -> np.ndarray:
    """A row of hashes for each signature: one for every band of BAND_HASHES of it."""
    n = N_HASHES // BAND_HASHES
    values = signatures_[:, : n * BAND_HASHES].astype(np.uint64).reshape(-1, n, BAND_HASHES)
    return mix((values * stream(43, n * BAND_HASHES).reshape(n, BAND_HASHES)[None]).sum(axis=2, dtype=np.uint64))


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, bands) of rows (rep, fingerprint)."""
    with np.errstate(over="ignore"):
        for batch in batches:
            raw = b"".join(batch.column("fingerprint").to_pylist())
            keys = _bands(np.frombuffer(raw, dtype=">u2").reshape(-1, N_HASHES))
            yield pa.RecordBatch.from_arrays([batch.column("rep"), long_lists(keys.ravel(), np.arange(len(keys) + 1) * keys.shape[1])], names=["rep", "bands"])


def near_duplicates(docs: DataFrame, threshold: float = 0.8, prints: DataFrame | None = None) -> DataFrame:
    """(doc_id, class_id) for every row of docs (doc_id, text) that has an id: classes of near duplicates.

    Texts with equal sets are one class from the start, so copies cost one representative. Bands of the
    representatives' signatures are joined in Spark, and an exact Jaccard similarity of threshold (in whole percent)
    confirms links; pairs that one component holds already aren't compared again. class_id is the smallest doc_id
    reachable. Texts without words are alone, each its own class. Only what shares no band is missed (see BAND_HASHES).

    prints (doc_id, same, fingerprint in bytes) are the signatures of the rows of docs, if they are there already; then of the texts only those that share a
    band with others are read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.where("doc_id IS NOT NULL").select("doc_id", "text")

    def cut(words) -> list[np.ndarray]:
        return [np.unique(s) if b > a else s[:0] for s, a, b in zip(shingle_sets(words), words.bounds[:-1], words.bounds[1:], strict=True)]

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for words in words_of(batch.column("text")):
                    sets = cut(words)
                    same = pa.array([sequence_hash(s) - (1 << 63) if len(s) else None for s in sets], pa.int64())
                    prints_ = packed(np.array([signature(s) for s in sets]))
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(words.lo, len(sets)), same, pa.array(prints_, pa.binary())], names=["doc_id", "same", "fingerprint"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for words in words_of(batch.column("text")):
                    sets = cut(words)
                    same = pa.array([sequence_hash(s) - (1 << 63) for s in sets], pa.int64())
                    yield pa.RecordBatch.from_arrays([batch.column("rep").slice(words.lo, len(sets)), same, pa.array([len(s) for s in sets], pa.int64()), long_lists(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))], names=["rep", "same", "n", "tokens"])

    rows = prints.select("doc_id", "same", "fingerprint").where("doc_id IS NOT NULL") if prints is not None else written(docs.mapInArrow(printed, "doc_id bigint, same bigint, fingerprint binary"), "minhash")
    members = written(rows.where("same IS NOT NULL").groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("fingerprint").alias("fingerprint")), "members")
    # copies of one set have one representative, but an id may be the representative of several sets
    entries = members.select("rep", "fingerprint").mapInArrow(_banded, "rep bigint, bands array<bigint>").select("rep", F.explode(F.array_distinct("bands")).alias("bucket"))
    several = entries.groupBy("bucket").agg((F.min("rep") < F.max("rep")).alias("some")).where("some").select("bucket")
    entries = written(entries.join(written(several, "several"), "bucket"), "entries")
    # texts of the representatives that share a band; a row that shares its id with another text is not taken for it
    some = few(written(entries.select("rep").distinct(), "reps"))
    sets = docs.join(some, docs.doc_id == some.rep).select("rep", "text").mapInArrow(whole, "rep bigint, same bigint, n bigint, tokens array<bigint>")
    sets = sets.join(members.select("rep", "same"), ["rep", "same"], "left_semi").dropDuplicates(["rep", "same"])
    sets = written(sets.withColumn("own", F.lit(0)).withColumn("bits", parity("tokens")), "tokens")
    lists = entries.join(sets.select("rep", "n", "own", "bits"), "rep").withColumn("index", F.lit(True))
    links = join_lists(lists, sets, round(100 * threshold))
    classes = connected_components(links).select(F.col("node").alias("rep"), "component")
    class_of = written(members.select("rep", "same").join(classes, "rep", "left").select("same", F.coalesce("component", "rep").alias("class_id")), "classes")
    discard(entries, sets)
    return rows.select("doc_id", "same").join(class_of, "same", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def compared(docs: DataFrame) -> DataFrame:
    """with_neighbours, and class_id of near_duplicates (of rows that share an id the smallest; null for rows without one): texts are hashed once for both."""
    pairs = written(_neighbours(docs), "neighbours")
    with scratch() as made:
        found = near_duplicates(docs, prints=pairs).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
        classes = written(found, "class_ids")
        made.remove(classes)
    return _in_digits(pairs.drop("same")).join(few(classes), "doc_id", "left")
