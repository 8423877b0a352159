"""Nulls, empty tables and texts, repeated rows, very long texts and clashing columns, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from envflow.llm import content_sort, decontamination, jaccard_join, minhash, packing, pii, quality, secrets, substring_dedup, url_filters, warc

LONG = " ".join(f"w{i}" for i in range(30_000))
SENTENCE = "the quick brown fox jumps over the lazy dog and runs far away from here today"
ROWS = [(1, SENTENCE), (1, SENTENCE), (2, None), (3, ""), (4, " \n\t"), (5, LONG), (6, SENTENCE), (None, SENTENCE), (7, "one"), (8, "é" * 50), (None, None)]
#: Names that the operators use inside, beside the columns that they read.
CLASHING = ("doc", "rep", "n", "part", "token", "found", "kept", "score", "rank", "anchor", "component", "digest", "alias", "bucket", "hits", "_text", "_chars", "_row", "_assign", "key", "tie", "row", "ghost", "same")

OPERATORS = {
    "substring": lambda d: substring_dedup.remove_repeats(d, 10),
    "fingerprints": minhash.fingerprints,
    "neighbours": minhash.with_neighbours,
    "near": minhash.near_duplicates,
    "jaccard": jaccard_join.components,
    "pii": pii.scan,
    "secrets": secrets.scan,
    "packing": packing.pack,
    "leaks": lambda d: decontamination.find(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 6")),
    "quality": lambda d: quality.score(d, quality.train(d, d.sparkSession.createDataFrame([(1, 1), (3, 0), (None, 1), (5, None)], "doc_id bigint, quality int"))),
}
#: Rows of the result for ROWS; None: whatever.
COUNT = {"substring": 11, "fingerprints": 11, "neighbours": 11, "near": 9, "jaccard": 11, "pii": 11, "secrets": 11, "packing": None, "leaks": 4, "quality": 11}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string")


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(docs, name):
    got = OPERATORS[name](docs).collect()
    assert COUNT[name] is None or len(got) == COUNT[name]


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, name):
    assert OPERATORS[name](docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_columns(docs, name):
    more = docs.withColumns({c: F.lit("x") for c in CLASHING})
    key = lambda rows: sorted(map(str, rows))
    assert key(OPERATORS[name](more).collect()) == key(OPERATORS[name](docs).collect())


def test_values_of_odd_rows(docs):
    """Not only as many rows as given: what each odd row gets."""
    empty = hashlib.sha256(b"").hexdigest()
    prints = {(r.doc_id, r.text): r.fingerprint for r in minhash.fingerprints(docs).collect()}
    assert prints[1, SENTENCE] == prints[6, SENTENCE] == prints[None, SENTENCE] and prints[2, None] == prints[3, ""] == prints[None, None]
    assert len({prints[1, SENTENCE], prints[3, ""], prints[4, " \n\t"], prints[5, LONG], prints[7, "one"], prints[8, "é" * 50]}) == 6 and all(len(p) == 512 for p in prints.values())
    near = {}
    for r in minhash.with_neighbours(docs).collect():
        near.setdefault(r.doc_id, []).append(r)
    assert [len(near[d]) for d in (1, 2, 3, 4, 5, 6, 7, 8, None)] == [2, 1, 1, 1, 1, 1, 1, 1, 2]
    assert near[2][0].n_chars == 0 and near[2][0].edited_sha256 == empty and near[2][0].near_edited == 1.0 and near[2][0].same is None
    assert near[8][0].n_chars == 50 and near[8][0].edited_sha256 == hashlib.sha256(("é" * 25 + "one").encode()).hexdigest()  # the next is 7
    assert near[1][0].near_next == 1.0 or near[1][1].near_next == 1.0  # the row that repeats is its own next
    found = {r.doc_id: r for r in pii.scan(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()}
    hidden = {r.doc_id: r for r in secrets.digests(secrets.scan(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))).collect()}
    for r in (*found.values(), *hidden.values()):
        assert r.base_sha256 == empty and r.spans == "" and all(r[c] == 0 for c in r.asDict() if c.startswith("n_"))
    leaks = decontamination.find(docs, docs.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 6")).collect()
    assert sorted((str(r.doc_id), r.item_id, r.similarity) for r in leaks) == [("1", 6, 1.0), ("1", 6, 1.0), ("6", 6, 1.0), ("None", 6, 1.0)]
    scores = {}
    for r in OPERATORS["quality"](docs).collect():
        scores.setdefault(r.doc_id, set()).add((r.score, r.predicted))
    assert all(0 <= s <= 1 and p == (s >= 0.3) for v in scores.values() for s, p in v) and scores[2] == scores[3] and scores[1] == scores[6]


def test_empty_tables_of_the_other_functions(spark, docs):
    none = docs.limit(0)
    files = spark.createDataFrame([], "file string")
    assert warc.read_archives(files).collect() == [] and jaccard_join.link_counts(none).collect() == [] and all(t.collect() == [] for t in jaccard_join.all_links(none))
    assert secrets.redact(none.withColumn("n_chars", F.lit(0).cast("bigint"))).collect() == [] and content_sort.deduplicate(none).collect() == []


def test_substring_results(docs):
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(docs, 10).collect()}
    assert got == {(1, 16, 16), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 30_000, 0), (6, 16, 16), (None, 16, 16), (7, 1, 0), (8, 1, 0), (None, 0, 0)}


def test_jaccard_results(docs):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.components(docs).collect()}
    assert got == {(1, 13, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 29_997, 5), (6, 13, 1), (None, 13, None), (7, 1, 7), (8, 1, 8), (None, 0, None)}


def test_near_duplicates_results(docs):
    assert {(r.doc_id, r.class_id) for r in minhash.near_duplicates(docs).collect()} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 1), (7, 7), (8, 8)}


def test_one_row_is_its_own_neighbour(spark):
    row = minhash.with_neighbours(spark.createDataFrame([(4, "abcdef")], "doc_id bigint, text string")).first()
    assert (row.edited_sha256, row.near_next) == (hashlib.sha256(b"abcabc").hexdigest(), 1.0)


def test_pipeline_filters_keep_columns(spark, docs):
    more = docs.withColumns({c: F.lit("x") for c in (*CLASHING, "_row", "_clean", "n_chars_")}).withColumn("n_chars", F.length("text").cast("bigint"))
    machine = quality.train(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    for got in (quality.keep_good(more, machine), secrets.redact(more), decontamination.clean(more, spark.createDataFrame([], "item_id bigint, text string"))):
        assert got.columns == more.columns and got.count() == more.count()


def test_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "h" * 200), (1, "http://a.org/x", "h" * 200), (2, None, None), (None, "no scheme", "h" * 200), (3, "http://a.com/de/ü b", "h" * 200), (4, "://", "é" * 10)], "page_id bigint, url string, html string")
    pages = pages.withColumns({c: F.lit("x") for c in ("host", "alias", "digest", "known", "file", "own")})
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(pages).collect()}
    assert got == {(1, "a.org", "/x", "org/", "allow"), (2, "", "", None, "allow"), (None, "", "", None, "allow"), (3, "a.com", "/de/ü b", "com/de/", "block"), (4, "", "", None, "allow")}
    back = sorted((str(r.page_id), r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    assert back == [("1", 200, "response", None), ("1", 200, "response", None), ("2", 0, "response", None), ("3", 200, "revisit", 1), ("4", 20, "response", None), ("None", 200, "revisit", 1)]
    assert url_filters.judge(pages.limit(0)).collect() == [] and warc.round_trip(pages.limit(0)).collect() == []


def test_packing_results(docs):
    """Each row's pieces are its ids and the end id: of null and empty texts the end id alone, of a very long text several windows."""
    import zlib
    from collections import Counter

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc, text in ROWS:
        ids = np.array([*encode.encode(text or "", add_special_tokens=False).ids, packing.END_ID], dtype="<u4")
        want.update((doc, at, len(ids[at : at + packing.SIZE]), zlib.crc32(ids[at : at + packing.SIZE].tobytes()), len(ids)) for at in range(0, len(ids), packing.SIZE))
    got = packing.pack(docs).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    used = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.SIZE and sorted(used) == list(range(len(used)))


def test_the_driver_forgets_what_finished_stages_left(spark, monkeypatch):
    """Each stage begins with a driver that has dropped what nothing names any more."""
    import weakref

    import corpus_pipeline
    from envflow.llm import common

    class Plan:
        pass

    plan = Plan()
    plan.itself, gone = plan, weakref.ref(plan)
    del plan
    common.forget(spark)
    assert gone() is None
    asked = []
    monkeypatch.setattr(corpus_pipeline, "forget", asked.append)
    corpus_pipeline.without_secrets(spark, spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), "")
    assert asked == [spark]
