"""Rows that share an id, payloads and windows that are a third of a table, and links of any form: results and how they are dealt out."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from contextlib import contextmanager

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from envflow.llm import common, minhash, packing, queries, substring_dedup, url_filters, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@contextmanager
def conf(spark, **settings):
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def tables_of(module):
    """The tables that a module writes, by name, before they are deleted: (name) -> facts that look makes of them."""
    seen, original, look = {}, module.written, {}

    def written(df, name, *more):
        out = original(df, name, *more)
        if name in look:
            seen[name] = look[name](out)
        return out

    module.written = written
    try:
        yield seen, look
    finally:
        module.written = original


# substring dedup


@pytest.mark.parametrize("alike", [False, True])
def test_rows_that_share_an_id_are_not_gathered(spark, alike):
    """A third of the rows has one id, with texts of their own or the same text; no row gets the hits of another text."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    own = lambda i: [f"w{i}_{k}" for k in range(30)]
    rows = [(7, own(0 if alike else i) + passage) for i in range(200)] + [(1000 + i, own(500 + i // 2) * 2) for i in range(400)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id bigint, text string").repartition(6)
    starts = Counter(tuple(w[i : i + 20]) for _, w in rows for i in range(len(w) - 19))
    want = Counter((d, len(w), len({i + k for i in range(len(w) - 19) if starts[tuple(w[i : i + 20])] > 1 for k in range(20)})) for d, w in rows)
    with tables_of(substring_dedup) as (seen, look):
        look["hits"] = lambda t: t.agg(F.max(F.size("hits"))).first()[0]
        got = Counter((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(docs, 20).collect())
    assert got == want and seen["hits"] <= 70


# WARC


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [0, 500_000])
def test_a_payload_on_a_third_of_the_pages(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "FEW", few)
    hot = "<p>" + "x" * 300
    rows = [(i, f"http://h/{i}", hot if i % 3 == 0 else f"{'y' * 200}{i % 50}") for i in range(900)] + [(5000, None, None), (None, "u", hot)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5)
    with conf(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert ("hashpartitioning(digest" in plan_of(warc.with_revisits(pages))) == (few == 0)  # no payload travels where the repeated ones are few
    first = defaultdict(list)
    for i, _, h in rows:
        if h and i is not None:
            first[h].append(i)
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.round_trip(pages).collect()}
    assert got == {i: ("revisit", min(first[h])) if h and i != min(first[h]) else ("response", None) for i, _, h in rows}


# packing


def test_full_windows_are_dealt_out(spark, monkeypatch):
    """Nearly all pieces are full windows, and a document repeats: no share of a length is much larger than asked for."""
    monkeypatch.setattr(packing, "SHARE_ROWS", 50)
    rows = [(i, "x" * 160) for i in range(40)] + [(7, "y" * 5)] * 700 + [(100 + i, "z" * (i % 16)) for i in range(200)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = packing.pack(docs, size=16, end_id=1, load=lambda: lambda text: [ord(c) for c in text]).collect()
    assert Counter(r.doc_id for r in got if r.length == 16) == Counter({i: 10 for i in range(40)} | {115 + 16 * i: 1 for i in range(12)})
    used = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 16 and sorted(used) == list(range(len(used))) and sum(used.values()) == sum(len(t or "") + 1 for _, t in rows)
    places = Counter((r.sequence_id, r.offset) for r in got)
    assert max(places.values()) == 1 and len(got) == len(rows) + 40 * 10  # 161 ids: ten windows and a rest


# URL links


def planted_pages(n, seed):
    rng = random.Random(seed)
    host = lambda: rng.choice([f"s{rng.randrange(500)}.net"] * 12 + [f"b{rng.randrange(40)}.com/de", f"g{rng.randrange(40)}.org", "www.x.net", "Y.NET:80", f"f{rng.randrange(9)}.com/fr"])
    url = lambda: rng.choice(["http://", "https://"]) + host() + rng.choice(["", "/", "/de/", "/x/../y", "/q?a=1&utm_source=z#f"])
    target = lambda: url() if rng.random() < 0.7 else rng.choice([f"//s{rng.randrange(500)}.net/", "/de/1", "../k", "./x?y=1", "?z=2", "#top", "mailto:a@b", "", "a/b/../../../c", "/x#y"])
    forms = [
        '<link rel="canonical" href="{}">', "<LINK HREF='{}' rel='x Canonical'>", "<link href={} rel=canonical/>", '<meta property="og:url" content="{}">', "<meta http-equiv=refresh content='5; url={}'>",
        '<meta content="0;URL=\'{}\'" http-equiv="Refresh">', f'<link data-x="{"v" * 9000} > <link" rel=canonical href="{{}}">', "<link " + "".join(f" a{i}='>{i}'" for i in range(90)) + ' rel="canonical" href="{}">',
        '<base href="{}">', '<meta name="og:url" content=" {} ">', '<link rel="stylesheet" href="{}">', '<!-- canonical --><link "rel=canonical href={}>', "<meta http-equiv=refresh content=5>", "<linkx rel=canonical href='{}'>",
    ]
    page = lambda: "<html>canonical " + "".join(rng.choice(forms).format(target()) + rng.choice(["", "'", '"', "<p>", ">"]) for _ in range(rng.choice([0, 0, 1, 1, 2])))
    return [(i, url() if rng.random() < 0.95 else rng.choice([None, "no scheme", "://"]), page() if rng.random() < 0.95 else None) for i in range(n)]


def test_classes_of_planted_links_equal_the_sql(spark):
    df = spark.createDataFrame(planted_pages(600, 4), "page_id bigint, url string, html string")
    con = duckdb.connect()
    con.register("pages", df.toPandas())
    want = con.execute(queries.ORACLES["op1_url_filters"]).fetchall()
    got = url_filters.judge(df).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    changed = [r for r in got if r.rule is None and r.verdict == "block"]
    assert changed and url_filters.link_edges(df).count() > 150


def test_links_in_long_values_and_of_many_attributes(spark):
    many = "".join(f" a{i}='{i}'" for i in range(40))
    pages = ["<link rel='canonical' href='http://t.net/1'>", f"<link data-x='{'v' * 9000}' rel='canonical' href='http://t.net/1'>", f"<link title='a > b'{many} rel='canonical' href='http://t.net/1'>", f"<link rel='canonical'{' ' * 3000}href='http://t.net/1'>", f"<link rel='canonical' href='http://t.net/{'p' * 20_000}'>"]
    rows = [(i, f"http://m{i}.net/", h) for i, h in enumerate(pages)]
    got = {r.a: r.b for r in url_filters.link_edges(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {f"m{i}.net": "t.net/" + ("p" * 20_000 if i == 4 else "1") for i in range(5)}


@pytest.mark.parametrize("tag", ["<link ", "<link '", '<meta ">', "<link rel=canonical ", "<link '\"", "<link \"''", "<link ''\"' "])
def test_tags_that_never_end_take_time_in_proportion(spark, tag):
    import time

    def seconds(n):
        df = spark.createDataFrame([(1, "http://m.net/", f"canonical {tag * n}<p><link rel=canonical href='/there'>")], "page_id bigint, url string, html string")
        began = time.perf_counter()
        found = [tuple(r) for r in url_filters.link_edges(df).collect()]
        return time.perf_counter() - began, found

    seconds(1000)
    taken, found = seconds(200_000)
    assert found == [("m.net", "m.net/there")] and taken < 5


# fingerprints


def test_an_edited_text_is_hashed_from_its_parts():
    """The signature of an edited text, put together from minima of both documents, is that of the text; any cut, in words and in characters of several bytes."""
    rng = random.Random(1)

    def row(t):
        for w in common.words_of(pa.array([t])):
            return minhash._Row(0, 1, w, 0, common.shingle_hashes(w.hashes, minhash.SHINGLE_WORDS))

    with np.errstate(over="ignore"):
        for _ in range(1500):
            k, alphabet = rng.choice([0, 3, 10, 40, 200]), rng.choice(["ab ", "a é\n", "ab      ", "漢字 x"])
            x, y = ("".join(rng.choices(alphabet, k=rng.randrange(k + 1))) for _ in range(2))
            first, after = row(x), row(y)
            first.measure()
            edit = minhash._Edit(first, after)
            got = minhash.sealed(edit.minima(after.measure(*edit.shared())))
            n = len(x) // 2
            assert edit.text().decode() == x[: len(x) - n] + y[:n] and first.n_chars == len(x)
            for found, text in ((got, x[: len(x) - n] + y[:n]), (minhash.sealed(first.own), x), (minhash.sealed(after.own), y)):
                assert (found == minhash.signatures(pa.array([text]))[0]).all()


@pytest.mark.parametrize("range_rows", [50_000, 20])
def test_neighbours_of_rows_that_share_an_id(spark, monkeypatch, range_rows):
    """A third of the rows has one id, a part none, and rows repeat: every row meets the next in order, whatever the ranges."""
    monkeypatch.setattr(minhash, "RANGE_ROWS", range_rows)
    rng = random.Random(2)
    text = lambda: " ".join(rng.choices("abcdefghij", k=rng.randrange(12)))
    rows = [(7, text()) for _ in range(200)] + [(i, text()) for i in range(300)] + [(None, text()) for _ in range(60)] + [(7, "the same row")] * 40 + [(3, None), (-5, "below zero")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    hashes = [r.h for r in spark.createDataFrame([(i, t or "") for i, (_, t) in enumerate(rows)], "i int, t string").select("i", F.xxhash64("t").alias("h")).orderBy("i").collect()]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, -(rows[i][0] or 0), hashes[i], rows[i][1] or ""))
    want = Counter()
    for i, j in zip(order, order[1:] + order[:1], strict=True):
        x, y = rows[i][1] or "", rows[j][1] or ""
        n = len(x) // 2
        want[rows[i][0], len(x), hashlib.sha256((x[: len(x) - n] + y[:n]).encode()).hexdigest()] += 1
    got = Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in minhash.with_neighbours(docs).collect())
    assert got == want


def test_a_shared_id_is_cut_into_ranges(spark):
    docs = spark.createDataFrame([(7, f"text {i}") for i in range(2000)] + [(i, "x") for i in range(1000)], "doc_id bigint, text string").withColumn("key", minhash._key())
    keys, ties = minhash._range_bounds(docs, 16)
    assert len(keys) == len(ties) >= 12 and (keys == -8).sum() >= 6 and len(set(ties.tolist())) > 6
    plain, none = minhash._range_bounds(docs.where("doc_id <> 7"), 16)
    assert len(plain) == 15 and not none.any()
