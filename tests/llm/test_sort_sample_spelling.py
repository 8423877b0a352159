"""Content sort, importance resampling and spelling variants against brute force, SQL and odd rows."""

import hashlib
import math
import os
import pickle
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from envflow.llm import content_sort, importance, spelling

DATA = os.environ.get("ENVFLOW_TEST_DATA", "/root/testdata/sf0.001")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = "wörd number " * 60_000
ROWS = [(1, "a  b"), (1, "a  b"), (2, None), (3, ""), (4, " \n\t"), (5, LONG), (6, "a\tb"), (None, "a b"), (7, " a b"), (None, None), (None, "only here"), (None, "only here"), (8, "a\xa0b")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


# content sort


def brute_copies(rows):
    groups = defaultdict(list)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    for d, t in rows:
        groups[norm(t)].append(d)
    least = {t: min((d for d in ids if d is not None), default=None) for t, ids in groups.items()}
    want = Counter((d, least[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for d, t in rows)
    return want, {hashlib.sha256(t.encode()).hexdigest(): least[t] for t in groups}


def check_copies(spark, rows, df):
    got = content_sort.exact_duplicates(df).collect()
    want, least = brute_copies(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [(r.text_sha256, r.doc_id) for r in got if r.kept]
    assert len(kept) == len(least) and dict(kept) == least


def test_copies_of_odd_rows(spark):
    check_copies(spark, ROWS, frame(spark, ROWS).withColumns({c: F.lit("x") for c in ("lead", "digest", "row", "part", "ends", "edge", "keep_id", "next", "total", "_row")}))
    assert content_sort.exact_duplicates(frame(spark, [])).collect() == []
    assert [tuple(r) for r in content_sort.exact_duplicates(frame(spark, [(None, None)])).collect()] == [(None, None, 1, True, hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_copies_over_many_ranges(spark, parts):
    """A text on a third of the rows, a row that repeats as often, texts that begin alike; small batches, so that groups span them."""
    rng = random.Random(parts)
    rows = [(i, "the same text") for i in rng.sample(range(10_000), 400)] + [(77, "one row again and again")] * 400
    rows += [(20_000 + i, f"a long beginning that very many texts of this table share, and then {i % 150}") for i in range(300)] + [(40_000 + i, rng.choice(["x", "y", ""]) + str(rng.randrange(90))) for i in range(200)]
    rng.shuffle(rows)
    conf = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        check_copies(spark, rows, frame(spark, rows).repartition(5))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_hot_text_is_spread_over_ranges(spark):
    rows = frame(spark, [(i, "the same text") for i in range(3000)] + [(7, "the same row")] * 3000 + [(10_000 + i, f"text {i}") for i in range(3000)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        made = []
        original = content_sort.written
        content_sort.written = lambda df, name: made.append(original(df, name)) or made[-1]
        try:
            content_sort.exact_duplicates(rows).collect()
        finally:
            content_sort.written = original
        sizes = [r.n for r in made[0].groupBy("part").agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) == 12 and max(sizes) < 3 * 9000 / 12


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.booleans(), st.booleans()), min_size=1, max_size=12))
def test_groups_are_joined_over_ranges(ranges):
    """Each range has one group or several; whether its last text is the next one's first is given."""
    ends, runs, equal = [], [], set()
    for part, (n, single, goes_on) in enumerate(ranges):
        groups = [(part, 3, 100 * part, n)] if single else [(part, 1, 100 * part, n), (part, 2, 100 * part + 1, n + 1)]
        ends += groups
        if part - 1 in equal:
            runs[-1].append(groups[0])
        else:
            runs.append([groups[0]])
        runs += [[g] for g in groups[1:]]
        if goes_on and part < len(ranges) - 1:
            equal.add(part)
    want = sorted((g[0], g[1], run[0][2], sum(x[3] for x in run), run[0][0]) for run in runs if len(run) > 1 for g in run)
    assert sorted(content_sort._joined_ends(ends, equal)) == want


def test_deduplicate_keeps_columns(spark):
    rows = frame(spark, ROWS).withColumns({"source": F.lit("s"), "_row": F.lit(1), "_id": F.lit(2), "kept": F.lit("k")})
    got = content_sort.deduplicate(rows)
    assert got.columns == rows.columns
    assert sorted((str(r.doc_id), r.text) for r in got.select("doc_id", "text").collect() if r.text != LONG) == sorted([("1", "a  b"), ("2", None), ("4", " \n\t"), ("7", " a b"), ("None", "only here"), ("8", "a\xa0b")])


# importance resampling


def brute_sample(rows, target, percent=10, least=20, longest=1, buckets=10_000):
    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    every = [(d, *features(t)) for d, t in rows]
    s, t = Counter(b for _, _, f in every for b in f), Counter(b for x in target for b in features(x)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (s.total() + buckets) / ((s[b] + 1.0) * (t.total() + buckets))))
    noise = lambda d: math.floor(-1000 * math.log(-math.log((int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296)))
    out = []
    for d, n, f in every:
        weight = sum(map(gain, f))
        out.append((d, n, len(f), weight, None if d is None else weight + noise(d)))
    part = sorted((x for x in out if x[1] >= least and x[4] is not None), key=lambda x: (-x[4], x[0]))
    drawn = Counter()
    ranks = defaultdict(list)
    for r, x in enumerate(part[: percent * len(part) // 100], 1):
        ranks[x].append(r)
    result = []
    for x in out:
        drawn[x] += 1
        result.append((x[0], x[2], x[3], x[4], ranks[x][drawn[x] - 1] if x[1] >= least and drawn[x] <= len(ranks[x]) else None))
    return Counter(result)


@pytest.mark.parametrize("longest, parts", [(1, 1), (1, 9), (3, 4)])
def test_sample_against_brute_force(spark, longest, parts):
    rng = random.Random(longest)
    vocabulary = [f"{c}{i}" for i in range(60) for c in ("w", "É", "é", "x'")]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(45)))) for i in range(300)] + [(7, "same row " * 12)] * 40 + [(None, "no id " * 12), (500, None), (501, ""), (502, " ,.; "), (503, "Word " * 20_000)]
    target = [" ".join(rng.choices(vocabulary[:50], k=30)) for _ in range(9)] + [None]
    docs = frame(spark, rows).withColumns({c: F.lit("x") for c in ("rank", "score", "part", "at", "row", "bucket_ids", "before", "n_words", "weight")})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = importance.resample(docs.repartition(4), spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=500).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert Counter(map(tuple, got)) == brute_sample(rows, target, longest=longest, buckets=500)


def test_sample_of_empty_tables(spark):
    none = frame(spark, [])
    assert importance.resample(none, none).collect() == []
    got = importance.resample(frame(spark, [(i, "word " * 20) for i in range(10)]), none).collect()
    assert sorted(r.rank for r in got if r.rank) == [1] and all(r.weight < 0 for r in got)


def test_scoring_has_neither_explode_nor_join(spark):
    docs = frame(spark, [(1, "some words here")])
    weighed = docs.select(importance.weight_of(importance.buckets_of(F.col("text")), list(range(importance.BUCKETS))).alias("w"))
    plan = weighed._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Generate|Join|Exchange|Python", plan) and "split" not in plan  # the gains are a literal
    assert weighed.first().w == sum(zlib.crc32(w) % 10_000 for w in (b"some", b"words", b"here"))


def test_the_draw_is_in_proportion_to_the_weights(spark):
    """Documents of the target's words are drawn far more often than others, and some others are drawn too."""
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices([f"{'t' if i % 4 == 0 else 'o'}{k}" for k in range(40)], k=25))) for i in range(800)]
    target = spark.createDataFrame([(" ".join(f"t{k}" for k in range(40)),)], "text string")
    got = [r for r in importance.resample(frame(spark, rows), target).collect() if r.rank]
    assert len(got) == 80 and sum(r.doc_id % 4 == 0 for r in got) == 80


# spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_words(rows, least_chars=5, least_count=3):
    n = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_chars:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= least_count}


def brute_variants(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, v in near.items():
        best = min(v, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text(alphabet="abé", min_size=1, max_size=6), min_size=1, max_size=60), st.text(alphabet="abé", min_size=1, max_size=6))
def test_automaton_accepts_what_is_one_edit_away(words, query):
    letters = sorted(w.encode("latin-1") for w in words)
    found = spelling.Trie(letters, [1] * len(letters)).near(query.encode("latin-1"))
    assert sorted(letters[i].decode("latin-1") for i in found) == sorted(w for w in words if one_edit(w, query))


def odd_texts():
    rng = random.Random(5)
    base = ["Straße", "straSSe", "colour", "color", "colours", "naïve", "naive", "ÉTUDE", "étude", "aaaaa", "aaaaaa", "aaaa", "abcde" * 40, "abcde" * 39 + "abcd", "x×yzÿz"]
    rows = [(i, " ".join(rng.choices(base, weights=[1 + k * k for k in range(len(base))], k=40))) for i in range(120)]
    return rows + [(5, "colour-color" * 3), (5, "colour-color" * 3), (None, "colour color 1color2 " * 5), (900, None), (901, ""), (902, "é" * 100_000 + " " + "é" * 100_000 + "," + "é" * 100_000)]


@pytest.mark.parametrize("shard_words, shard_bytes", [(500_000, 8 << 20), (3, 8 << 20), (100, 12)])
def test_variants_against_brute_force(spark, shard_words, shard_bytes):
    rows = odd_texts()
    docs = frame(spark, rows).withColumns({c: F.lit("x") for c in ("word", "run", "n", "best", "root", "form", "id", "shard")})
    got = spelling.variants(docs, shard_words=shard_words, shard_bytes=shard_bytes).collect()
    want = brute_variants(brute_words(rows))
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_variants_of_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    n = {r.word: r.n for r in spelling.word_counts(docs).collect()}
    assert n == brute_words([(r.doc_id, r.text) for r in docs.collect()])
    assert spelling.variants(docs.limit(0)).collect() == [] and spelling.variants(frame(spark, [(1, "once")])).collect() == []


def test_roots_follow_long_chains(spark):
    """Forms that lead on for twenty steps, and many words that lead to one."""
    forms = [(f"w{i}", f"w{i + 1}" if i < 20 else None) for i in range(21)] + [(f"v{i}", "w3") for i in range(200)] + [("alone", None)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "alone" if w == "alone" else "w20" for w, _ in forms} and spelling.roots(spark.createDataFrame([], "word string, form string")).collect() == []


def test_a_shard_is_bounded(spark):
    """Every trie holds so many words at most, also where a range of words is larger; a factor that would allow a circle is refused."""
    words = spark.createDataFrame([(f"w{i:05d}", 3) for i in range(1000)], "word string, n bigint").repartition(9)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "30"):  # neighbouring ranges are one shard as long as it stays small
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for most, shards in ((2000, 1), (400, 3), (70, 15)):
                sizes = [len(pickle.loads(r.trie).counts) for r in spelling.tries(words, most).collect()]
                assert sum(sizes) == 1000 and max(sizes) <= most and shards <= len(sizes) <= 2 * shards
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with pytest.raises(ValueError):
        spelling.variants(words, factor=1)
