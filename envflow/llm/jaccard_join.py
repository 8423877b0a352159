"""N-gram Jaccard join: a size-aware heavy-light similarity join over sets of word shingles, and its components.

Two sets of sizes n <= m link when 100 * intersection >= percent * union. Then the smaller shares at least
``i(n) = ceil(2 * percent * n / (100 + percent))`` shingles and the larger at least ``o(m) = ceil(percent * m / 100)``;
so under any common order of the shingles the first j common ones are among the first ``n - i(n) + j`` of the smaller,
which index it, and among the first ``m - o(m) + j`` of the larger, which probe. A set is in both roles, as it may be
the smaller of one pair and the larger of another.

1. Equal sets are one representative with its members; copies cost nothing after that.
2. Screen, in the order of hashes: a set sends its first ``n - o(n) + j(n)`` shingles, j(n) being half of the plain
   prefix. A set stays only if as many of them as any partner's j are seen in other sets. Most sets end here.
3. The sets that stay are ordered by frequency, rare shingles first. Light sets, up to a boundary size, list all
   two-shingle subsets of their prefix; heavy sets, and light ones near the boundary, are in the inverted list of each
   prefix shingle. The boundary is the power of two with the least cost: subsets listed, against rows in lists and
   comparisons of blocks. A list that indexes nothing, such as that of a common line in documents that have
   enough words of their own, holds no pair and is dropped.
4. A list of n sets isn't n * n pairs. First its pivot, the set with the smallest share of shingles of its own, is
   verified against the other members; sets that are in one component by then need no more comparisons. Lists with sets of
   several components stay open. Where few sets of an open list index it, these are paired with its members, and parity
   bitmaps, which bound the intersection from above, drop most pairs before any shingles are sent. Crowded lists are
   compared by blocks of sets as products of matrices; blocks of one component don't meet each other. Components that meet in
   crowded lists form a group that is compared once, unless its lists hold far fewer pairs than the group; then each
   list is. No link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import discard, few, long_lists, mix, sequence_hash, shingle_hashes, signed, small_batches, splittable, stream, words_of, written
from envflow.llm.components import connected_components

SHINGLE_WORDS = 4
PERCENT = 85
#: A block of sets that is compared with another block at once; every WEIGHT shingles count as a set more.
BLOCK, WEIGHT = 1024, 256
#: Columns of the matrices that the comparison multiplies.
COLUMNS = 1 << 12
#: A list is crowded if more sets than this index it.
CROWDED = 64
#: A group is compared whole if it has at most so many pairs for each pair in its lists: a pair in a block costs far less.
DENSE = 128
_WHICH = stream(52, 1)[0]


def least_common(n, percent: int):
    """o(n), for numpy arrays and integers."""
    return -(-percent * n // 100)


def screen_common(n, percent: int):
    """j(n): it never falls as n grows."""
    return np.maximum(1, (n - least_common(n, percent) + 1) // 2)


def _shingles(words, k: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each row, sorted; its whole sequence where it is shorter; none without words."""
    every = shingle_hashes(words.hashes, k)
    for a, b in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        else:
            yield np.array([sequence_hash(words.hashes[a:b])] if b > a else [], dtype=np.uint64)


def _screen(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for words in words_of(batch.column("text"), lower=True):
                    sets = list(_shingles(words, k))
                    n = np.array([len(s) for s in sets], dtype=np.int64)
                    send = np.where(n > 0, n - least_common(n, percent) + screen_common(n, percent), 0)
                    same = [[(mix(s ^ c)).sum(dtype=np.uint64) for s in sets] for c in stream(51, 2)]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(words.lo, len(sets)), pa.array(n), *(pa.array(signed(np.array(x, dtype=np.uint64))) for x in same), long_lists(np.concatenate([s[:m] for s, m in zip(sets, send, strict=True)]), np.cumsum([0, *np.minimum(send, n)]))],
                        names=["doc_id", "n", "same1", "same2", "sent"],
                    )

    return run


def _whole(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for words in words_of(batch.column("text"), lower=True):
                    sets = list(_shingles(words, k))
                    which = np.array([mix(s ^ _WHICH).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                    yield pa.RecordBatch.from_arrays([batch.column("rep").slice(words.lo, len(sets)), pa.array(signed(which)), long_lists(np.concatenate(sets), np.cumsum([0, *map(len, sets)]))], names=["rep", "which", "shingles"])

    return run


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, common): sizes of the intersections of sorted lists x and y."""
    for batch in batches:
        x, y = batch.column("x"), batch.column("y")
        xs, ys, xo, yo = x.values.to_numpy(), y.values.to_numpy(), x.offsets.to_numpy(), y.offsets.to_numpy()
        found = [len(np.intersect1d(xs[xo[i] : xo[i + 1]], ys[yo[i] : yo[i + 1]], assume_unique=True)) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), batch.column("nx"), batch.column("ny"), pa.array(found, pa.int64())], names=["a", "b", "nx", "ny", "common"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) of representatives that link, by their exact similarity."""
    x = sets.select(F.col("rep").alias("a"), F.col("n").alias("nx"), F.col("tokens").alias("x"))
    y = sets.select(F.col("rep").alias("b"), F.col("n").alias("ny"), F.col("tokens").alias("y"))
    found = pairs.join(x, "a").join(y, "b").select("a", "b", "nx", "ny", "x", "y").mapInArrow(_common, "a bigint, b bigint, nx bigint, ny bigint, common bigint")
    return found.where(100 * F.col("common") >= percent * (F.col("nx") + F.col("ny") - F.col("common"))).select("a", "b").distinct()


def _block_links(percent: int, every: bool):
    """Links between two blocks of sets, side 0 and side 1, or within one that is on side 0 alone."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side, rep, n, component = (table.column(c).to_numpy() for c in ("side", "rep", "n", "component"))
        tokens = table.column("tokens").combine_chunks()
        row = np.repeat(np.arange(len(rep)), np.diff(tokens.offsets.to_numpy()))
        _, column, times = np.unique(tokens.flatten().to_numpy(), return_inverse=True, return_counts=True)
        again = times[column] > 1
        row, column = row[again], column[again]
        column = np.unique(column, return_inverse=True)[1]
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = not len(y)
        y = x if within else y
        place = np.empty(len(rep), dtype=np.int64)
        place[x], place[y] = np.arange(len(x)), np.arange(len(y))
        common = np.zeros((len(x), len(y)), dtype=np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            a, b = np.searchsorted(column, (at, at + COLUMNS))
            left, right = np.zeros((len(x), COLUMNS), dtype=np.float32), np.zeros((len(y), COLUMNS), dtype=np.float32)
            part, cell = row[a:b], column[a:b] - at
            mine = side[part] == 0
            left[place[part[mine]], cell[mine]] = 1
            theirs = mine if within else ~mine
            right[place[part[theirs]], cell[theirs]] = 1
            common += left @ right.T
        linked = ((100 + percent) * common.astype(np.int64) >= percent * (n[x][:, None] + n[y][None, :])) & (component[x][:, None] != component[y][None, :])
        i, j = np.nonzero(np.triu(linked, 1) if within else linked)
        i, j = x[i], y[j]
        if not every:
            root = {c: c for c in component.tolist()}

            def find(c: int) -> int:
                while root[c] != c:
                    root[c] = c = root[root[c]]
                return c

            new = np.zeros(len(i), dtype=bool)
            for k, (p, q) in enumerate(zip(component[i].tolist(), component[j].tolist(), strict=True)):
                p, q = find(p), find(q)
                root[p], new[k] = q, p != q
            i, j = i[new], j[new]
        return pa.table({"a": pa.array(np.minimum(rep[i], rep[j]), pa.int64()), "b": pa.array(np.maximum(rep[i], rep[j]), pa.int64())})

    return run


def _in_blocks(members: DataFrame, sets: DataFrame, percent: int, every: bool = False) -> DataFrame:
    """Links (a, b) between components in each unit of members (unit, rep, n, component), a written table.

    Enough of them to join the components, or every one, then also more than once. A component of more than a
    block has blocks of its own, which don't meet each other; small ones share blocks. Pairs of blocks are made of ids
    alone; a set is sent once for each block that its own meets.
    """
    weight = 1 + F.floor(F.col("n") / WEIGHT)
    sizes = members.groupBy("unit", "component").agg(F.sum(weight).alias("size")).withColumn("big", F.col("size") > BLOCK)
    shared = sizes.where("NOT big").groupBy("unit").agg(F.sum("size").alias("all")).select("unit", F.ceil(F.col("all") / BLOCK).alias("shared"))
    sizes = sizes.join(shared, "unit", "left").select("unit", "component", "big", F.when(F.col("big"), F.ceil(F.col("size") / BLOCK)).otherwise(F.col("shared")).alias("blocks"))
    number = F.pmod(F.xxhash64(F.when(F.col("big"), F.col("rep")).otherwise(F.col("component"))), F.col("blocks")).cast("int")
    own = F.when(F.col("big"), F.col("component")).otherwise(F.lit(0)).alias("own")
    placed = written(members.join(splittable(sizes, "sizes", members.count()), ["unit", "component"]).select("unit", "rep", "n", "component", F.struct("big", own, number.alias("number")).alias("block")), "placed")
    blocks = placed.select("unit", "block").distinct()
    other = blocks.withColumnRenamed("block", "second")
    pairs = blocks.withColumnRenamed("block", "first").join(other, "unit").where("first <= second AND NOT (first.big AND second.big AND first.own = second.own)")
    pairs = written(pairs.select("unit", F.xxhash64("unit", "first", "second").alias("pair"), "first", "second"), "block_pairs")
    sides = pairs.select("unit", "pair", F.col("first").alias("block"), F.lit(0).alias("side")).unionAll(pairs.where("first <> second").select("unit", "pair", F.col("second").alias("block"), F.lit(1)))
    dealt = placed.join(sides, ["unit", "block"]).select("pair", "side", "rep", "n", "component").join(sets.select("rep", "n", "tokens"), ["rep", "n"])
    return dealt.groupBy("pair").applyInArrow(_block_links(percent, every), "a bigint, b bigint")


def _boundary(sets: DataFrame, percent: int) -> int:
    """Sets of up to so many shingles are light: the power of two with the least cost. One job over partial sums by size."""
    if percent <= 50:  # then sets may link by a single shingle, which no subset of two holds
        return 0
    level = F.floor(F.log2("n")).cast("int")
    subsets = sets.groupBy(level.alias("level")).agg(F.sum(F.expr("size(two) * (size(two) - 1) / 2D")).alias("cost"))
    lists = sets.select(level.alias("level"), F.explode("one").alias("token")).groupBy("level", "token").agg(F.count("*").alias("n"))
    lists = lists.groupBy("level").agg(F.sum(F.expr(f"n + n * (n - 1) / {2 * BLOCK}D")).alias("cost"))
    rows = subsets.withColumn("light", F.lit(True)).unionByName(lists.withColumn("light", F.lit(False))).collect()
    light, heavy = ({r.level: r.cost or 0 for r in rows if r.light == kind} for kind in (True, False))
    levels = sorted(light.keys() | heavy.keys())
    cost = {b: sum(light.get(x, 0) for x in levels if x < b) + sum(heavy.get(x, 0) for x in levels if x >= b) for b in range(1 + max(levels, default=0) + 1)}
    return 1 << min(cost, key=lambda b: (cost[b], b))


def links(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sets, edges) of docs (doc_id, text).

    sets: doc_id, n, rep, one row per row of docs; rep is the smallest doc_id with the same set, null for empty sets
    and for rows without an id. edges: (a, b), links between representatives that join all linked ones. Without every,
    links that follow from others by way of a component may be absent, which is a step towards components and no
    result; see all_links.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    rows = written(docs.mapInArrow(_screen(k, percent), "doc_id bigint, n bigint, same1 bigint, same2 bigint, sent array<bigint>"), "sets")
    some = rows.where("n > 0 AND doc_id IS NOT NULL")
    reps = some.groupBy("same1", "same2").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sent").alias("sent"))
    sent = reps.select("rep", "n", F.explode("sent").alias("token"))
    seen = sent.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select("token")
    seen = splittable(seen, "seen", rows.agg(F.sum(F.size("sent"))).first()[0] or 0)
    least = F.ceil(F.lit(percent) * F.col("n") / 100)  # the smallest partner
    need = F.greatest(F.lit(1), F.floor((least - F.ceil(F.lit(percent) * least / 100) + 1) / 2))
    shared = sent.join(seen, "token").groupBy("rep", "n").agg(F.count("*").alias("shared"))
    stay = written(shared.where(F.col("shared") >= need).select("rep").distinct(), "stay")
    discard(seen)
    full = docs.join(few(stay), docs.doc_id == F.col("rep")).select("rep", "text").mapInArrow(_whole(k), "rep bigint, which bigint, shingles array<bigint>")
    full = written(full.where(F.size("shingles") > 0).dropDuplicates(["rep", "which"]), "full")
    discard(stay)

    # frequencies among the sets that stay; a shingle seen once is in no intersection and first in the order
    tokens = full.select("rep", "which", F.size("shingles").cast("bigint").alias("n"), F.explode("shingles").alias("token"))
    often = splittable(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "often", full.agg(F.sum(F.size("shingles"))).first()[0] or 0)
    sets = tokens.join(often, "token").groupBy("rep", "which", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("order"))
    own = F.col("n") - F.size("order")
    probe, index = F.ceil(F.lit(percent) * F.col("n") / 100), F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent))
    size = lambda least, j: F.greatest(F.lit(0), F.col("n") - least + j - own).cast("int")
    prefix = lambda j: F.slice("order", F.lit(1), size(probe, j))["token"]
    tokens = F.sort_array("order.token").alias("tokens")
    sets = sets.select("rep", "n", own.alias("own"), tokens, prefix(1).alias("one"), prefix(2).alias("two"), size(index, 1).alias("one_index"), size(index, 2).alias("two_index"))
    sets = written(sets.where(F.size("tokens") >= probe).withColumn("bits", parity("tokens")), "prefixes")
    discard(full, often)

    bound = _boundary(sets, percent)
    subsets = F.expr("flatten(transform(two, (x, i) -> transform(slice(two, i + 2, size(two)), (y, k) -> struct(xxhash64(x, y) AS bucket, i + 1 + k < two_index AS index))))")
    single = F.expr("transform(one, (x, i) -> struct(x AS bucket, i < one_index AS index))")
    row = ["rep", "n", "own", "bits"]
    light = sets.where(F.col("n") <= bound).select(*row, F.explode(subsets).alias("entry")).select(*row, "entry.*")
    heavy = sets.where(100 * F.col("n") >= percent * (bound + 1)).select(*row, F.explode(single).alias("entry")).select(*row, "entry.*")
    edges = join_lists(light.unionAll(heavy), sets, percent, every)
    discard(sets)
    same = written(reps.select("same1", "same2", "rep"), "same")
    out = rows.select("doc_id", "n", "same1", "same2").join(same, ["same1", "same2"], "left")
    return out.select("doc_id", "n", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")), edges


def parity(tokens: str) -> Column:
    """64 bits, each the parity of the number of tokens that it stands for."""
    return F.expr(f"aggregate({tokens}, 0L, (bits, t) -> bits ^ shiftleft(1L, CAST(t & 63 AS INT)))")


def may_link(x: str, y: str, percent: int) -> Column:
    """Whether the sets of structs x and y (n, own, bits) may link, by their sizes and the parities of their tokens.

    Tokens that only one of them holds change its parity bit, so the bits that differ are at most as many.
    """
    most = f"({x}.n - {x}.own + {y}.n - {y}.own - bit_count({x}.bits ^ {y}.bits)) / 2"
    return F.expr(f"100 * least({x}.n, {y}.n) >= {percent} * greatest({x}.n, {y}.n) AND {100 + percent} * {most} >= {percent} * ({x}.n + {y}.n)")


def join_lists(lists: DataFrame, sets: DataFrame, percent: int, every: bool = False) -> DataFrame:
    """Links (a, b) among the sets that share a list: enough of them to join all that link (see step 4 above), or every one, once.

    lists: (bucket, index, rep, n, own, bits). sets: (rep, n, tokens), tokens being those that another set may hold too; n is the size of
    the set, own how many of it tokens leaves out. The smaller of two sets that link indexes a list that the larger is in.
    """
    x = F.struct("rep", "n", "own", "bits")
    lists = lists.select("bucket", "index", x.alias("x"))
    pivot = F.min(F.struct((F.col("x.own") / F.col("x.n")).alias("alone"), F.col("x.rep").alias("rep"), F.col("x.n").alias("n"), F.col("x.own").alias("own"), F.col("x.bits").alias("bits"))).alias("p")
    heads = lists.groupBy("bucket").agg(pivot, F.sum(F.col("index").cast("int")).alias("indexing"), F.count("*").alias("all")).where("indexing > 0 AND all > 1")
    heads = written(heads, "heads")
    lists = written(lists.join(heads, "bucket"), "lists")

    if every:
        open_ = lists.withColumn("component", F.col("x.rep"))
        firm = met = now = None
    else:
        # one round of pivots: each list's most central set against its other members
        met = lists.where(F.col("x.rep") != F.col("p.rep")).where(may_link("x", "p", percent))
        met = written(met.select(F.least("x.rep", "p.rep").alias("a"), F.greatest("x.rep", "p.rep").alias("b")).distinct(), "pairs")
        firm = written(_verified(met, sets, percent), "links")
        now = connected_components(firm).withColumnRenamed("node", "rep")
        open_ = lists.withColumn("rep", F.col("x.rep")).join(now, "rep", "left").withColumn("component", F.coalesce("component", "rep")).drop("rep")
        several = open_.groupBy("bucket").agg(F.min("component").alias("head"), F.max("component").alias("last")).where("head < last").select("bucket")
        open_ = written(open_.join(written(several, "several"), "bucket"), "open")

    # lists that few sets index: these against all members
    few_index = open_.where(F.col("indexing") <= CROWDED)
    smaller = few_index.where("index").select("bucket", "x", "component")
    larger = few_index.select("bucket", F.col("x").alias("y"), F.col("component").alias("other"))
    pairs = smaller.join(larger, "bucket").where("component <> other AND x.n <= y.n").where(may_link("x", "y", percent))
    pairs = pairs.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    found = _verified(pairs if every else pairs.join(met, ["a", "b"], "left_anti"), sets, percent)

    # lists that many sets index, by blocks
    crowded = open_.where(F.col("indexing") > CROWDED)
    if not crowded.isEmpty():
        found = found.unionAll(_crowded(crowded, sets, percent, every))
    if every:
        return written(found.distinct(), "links")
    edges = written(firm.unionAll(found), "links")
    discard(lists, heads, met, firm, open_)
    return edges


def _crowded(lists: DataFrame, sets: DataFrame, percent: int, every: bool) -> DataFrame:
    """Links between components in lists (bucket, x, component, indexing, all): by groups of components that meet, or by lists."""
    pairs = F.expr("CAST(indexing AS DOUBLE) * all")
    meet = written(lists.groupBy("bucket").agg(F.min("component").alias("head"), F.max(pairs).alias("pairs")), "meet")
    groups = connected_components(lists.join(meet, "bucket").select(F.col("component").alias("a"), F.col("head").alias("b")))
    groups = written(groups.select(F.col("node").alias("component"), F.col("component").alias("group")), "groups")
    in_lists = meet.join(groups, F.col("head") == F.col("component")).groupBy("group").agg(F.sum("pairs").alias("in_lists"))
    members = lists.select("component", F.col("x.rep").alias("rep"), F.col("x.n").alias("n")).distinct().join(groups, "component")
    dense = members.groupBy("group").agg(F.count("*").alias("sets")).join(in_lists, "group").where(F.expr("CAST(sets AS DOUBLE) * (sets - 1) / 2") <= DENSE * F.col("in_lists")).select("group")
    dense = written(dense, "dense")
    whole = members.join(dense, "group").select(F.col("group").alias("unit"), "rep", "n", "component")
    apart = groups.join(dense, "group", "left_anti").select("component")
    single = lists.join(apart, "component").select(F.xxhash64(F.lit(1), "bucket").alias("unit"), F.col("x.rep").alias("rep"), F.col("x.n").alias("n"), "component")
    return _in_blocks(written(whole.unionAll(single), "members"), sets, percent, every)


def all_links(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS) -> tuple[DataFrame, DataFrame]:
    """(members, edges): the whole join of docs (doc_id, text).

    members: doc_id, n, rep, one row per row of docs; rows with equal sets have the same rep and link with one another.
    rep is the hash of a text, not a doc_id, so rows of different texts are apart also where they share a doc_id; it is
    null for empty sets and for rows without an id, which link with nothing. edges: (a, b) with a < b, every pair of
    different sets that link, once.
    """
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("text"))
    sets, edges = links(docs.select(key.alias("doc_id"), "text"), percent, k, every=True)
    sets = sets.select(F.col("doc_id").alias("key"), "n", "rep")
    counted = written(sets.where("key IS NOT NULL").distinct(), "counted")
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", key.alias("key")).join(counted, "key").select("doc_id", "n", "rep")
    alone = sets.where("key IS NULL").select(F.lit(None).cast("bigint").alias("doc_id"), "n", "rep")
    return rows.unionAll(alone), edges


def link_counts(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, n_links, the number of other rows that link with it."""
    members, edges = all_links(docs, percent, k)
    copies = written(members.where("rep IS NOT NULL").groupBy("rep").agg(F.count("*").alias("copies")), "copies")
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(copies, F.col("b") == F.col("rep")).groupBy(F.col("a").alias("rep")).agg(F.sum("copies").alias("others"))
    counts = copies.join(others, "rep", "left").select("rep", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return members.join(counts, "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def components(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id reachable by links, the row's own included. Null and empty texts, and texts
    without words, have no shingles and are alone; so are rows without an id, whose component_id is null. Rows that
    share a doc_id are one node of the graph. Other columns are ignored.
    """
    sets, edges = links(docs, percent, k)
    graph = connected_components(edges)
    out = sets.join(graph.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))
