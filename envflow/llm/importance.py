"""Target-distribution importance resampling, explode-free.

Features are runs of words, hashed into ``BUCKETS`` buckets. A bucket's gain is the logarithm of how much likelier it is in
the target's texts than in the corpus. A document's weight is the sum of its features' gains, and Gumbel noise fixed by
its id makes the largest scores a draw without replacement, in proportion to exp(weight).

Higher-order functions make each document's array of buckets. Counting makes a row of an array inside a task only, under a
partial aggregate, so that of the corpus no more than ``BUCKETS`` totals a task are shuffled. Scoring has no explode and no
join: it folds element_at over one literal array of ``BUCKETS`` gains. The totals, and so the array, are bounded by
``BUCKETS`` whatever the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import discard, let, n_partitions, written

BUCKETS = 10_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words: what is no letter or digit of ASCII separates, everything from U+0080 on belongs to words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The share of documents drawn, in percent, and the words that a document needs to take part.
PERCENT, LEAST_WORDS = 10, 20
SEED = 2024


def words_of(text: Column) -> Column:
    """The words of a whole text, A-Z in lower case; none for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def features_of(words: Column, longest: int = 1) -> Column:
    """All runs of 1 to longest consecutive words, joined by one space; repeats stay."""
    if longest == 1:
        return words

    def runs(every: Column) -> Column:
        of = lambda n: F.when(F.size(every) >= n, F.transform(F.sequence(F.lit(1), F.size(every) - (n - 1)), lambda i: F.array_join(F.slice(every, i, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))
        return F.concat(every, *(of(n) for n in range(2, longest + 1)))

    return let(words, runs)


def buckets_of(text: Column, longest: int = 1, buckets: int = BUCKETS) -> Column:
    """The bucket of each feature of a text: the crc32 of its UTF-8 bytes, modulo buckets."""
    return F.transform(features_of(words_of(text), longest), lambda f: (F.crc32(f.cast("binary")) % buckets).cast("int"))


def totals(bucketed: DataFrame) -> dict[int, int]:
    """How many features each bucket of column bucket_ids has; a row for each bucket at most."""
    counts = bucketed.select(F.explode("bucket_ids").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    return {r.bucket: r.n for r in counts.collect()}


def gains_of(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """A whole number for each bucket: thousandths of the log of its smoothed share in target over that in corpus."""
    here, there = sum(corpus.values()), sum(target.values())
    return [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * (here + buckets) / ((corpus.get(b, 0) + 1.0) * (there + buckets)))) for b in range(buckets)]


def weight_of(bucket_ids: Column, gains: list[int]) -> Column:
    """The sum of the gains of an array of buckets; 0 for none."""
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")  # folded to one literal when the query is planned
    return F.aggregate(bucket_ids, F.lit(0).cast("bigint"), lambda total, b: total + F.element_at(table, b + 1))


def noise_of(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of the Gumbel noise of an id; null for none."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def scores(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) for every row of docs (doc_id, text), against target (text).

    A null text has no words: weight 0. Rows without an id have no noise and a null score.
    """
    words = F.size(words_of(F.col("text")))
    bucketed = docs.select("doc_id", (words if longest > 1 else F.lit(0)).cast("bigint").alias("n_words"), buckets_of(F.col("text"), longest, buckets).alias("bucket_ids"))
    bucketed = written(bucketed, "buckets")
    aimed = target.select(buckets_of(F.col("text"), longest, buckets).alias("bucket_ids"))
    gains = gains_of(totals(bucketed), totals(aimed), buckets)
    n = F.size("bucket_ids").cast("bigint")
    weighed = bucketed.select("doc_id", (F.col("n_words") if longest > 1 else n).alias("n_words"), n.alias("n_features"), weight_of(F.col("bucket_ids"), gains).alias("weight"))
    out = written(weighed.withColumn("score", F.col("weight") + noise_of(F.col("doc_id"), seed)), "scores")
    discard(bucketed)
    return out


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, longest: int = 1, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_features, weight, score, rank.

    Of the N rows with at least least_words words, floor(percent * N / 100) are drawn, those with the highest scores, ties to the
    smaller doc_id; rank is 1, 2, 3... in that order and null for the others. A repeated row takes part as often as it is there.
    Rows without an id have no score and take no part. Without target texts all gains tell against the corpus alone.
    Other columns are ignored; an empty table gives an empty result.

    The rows that take part are put in order by ranges of score and id; a row's rank is its place in its range and the
    number of rows in the ranges before, one number for each range.
    """
    spark = docs.sparkSession
    scored = scores(docs, target, longest, buckets, seed)
    takes_part = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    # the number of a row tells repeated rows apart, which have the same score and id
    key = [F.col("score").desc(), F.col("doc_id"), F.col("row")]
    ranged = scored.where(takes_part).withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n_partitions(spark), *key).sortWithinPartitions(*key)
    in_order = written(ranged.drop("row").withColumn("at", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, total = {}, 0
    for r in sorted(in_order.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):  # a row for each range
        before[r.part], total = total, total + r.n
    drawn = percent * total // 100
    starts = spark.createDataFrame(list(before.items()), "part bigint, before bigint")
    ranked = in_order.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + place + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = ranked.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return ranked.unionByName(scored.where(~F.coalesce(takes_part, F.lit(False))).select(*columns, F.lit(None).cast("bigint").alias("rank")))
