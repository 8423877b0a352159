"""Secret scans by sliding-window entropy. Native: DataFrame functions only, in one pass without a shuffle.

Base kinds are patterns: assign (a value given to a password, secret, token or key), access (access key ids) and hex
(long lower-case hexadecimal runs). The method adds ``entropy`` spans: a candidate is a run of key characters with a
letter and a digit; for its character class (hexadecimal, letters and digits, or base-64) the Shannon entropy of every
window of ``WINDOW`` characters is computed, from counts that are updated by the character that enters and the one
that leaves. A candidate is a span if its largest entropy reaches the class's threshold, unless the allow list
suppresses it or a base span covers it. Base spans are never suppressed.

Spans are in code points, with an exclusive end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.llm.common import let, prefixes

BASE = ("assign", "access", "hex")
#: Fixed patterns. Each is searched leftmost without overlaps; what fails a length check is dropped.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ of 20 characters or more: a shorter run holds no longer one
HEX = "[0-9a-f]{24,}"
#: Cheaper conditions that hold wherever the pattern matches.
HINTS = {"assign": "(?i:passw|secret|token|api_?key)", "access": "AKIA", "hex": "[0-9a-f]{24}"}
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits per character that a window of WINDOW must reach, by class: random text has about 3.3, 4.0 and 4.1.
THRESHOLDS = {"hexadecimal": 2.9, "alphanumeric": 3.5, "base64": 3.6}
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: What a candidate may be and yet no secret: words of examples at its ends, a UUID, signs, one character, an address, a checksum.
ALLOW = r"(?i)^(example|sample|dummy|placeholder|redacted|changeme|your[_-]|x{4})|(example|dummy|placeholder|changeme|x{8})(key)?$|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$|^[-_=+/]*$|^(.)\4+$|^//|^sha(1|256|512)-"



#: Characters of a long text, or of a long candidate, that are worked on at a time.
SEGMENT, PART = 2048, 256
_SPAN = "struct<kind:string,start:int,stop:int,match:string,value:string>"


def _placed(text: Column, pattern: str, kind: str, hint: Column, value: int = 0) -> Column:
    """array<struct<kind, start, stop, match, value>> of the matches of pattern, placed by the lengths of what lies between."""
    every = F.regexp_extract_all(text, F.lit(pattern), 0)
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), every.alias("match"), F.regexp_extract_all(text, F.lit(pattern), value).alias("value"))

    def place(parts: Column) -> Column:
        stops = prefixes(F.transform(parts, lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["match"]), F.lit(0))), lambda x, y: x + y)
        span = lambda p, stop: F.struct(F.lit(kind).alias("kind"), (stop - F.length(p["match"])).alias("start"), stop.alias("stop"), p["match"].alias("match"), p["value"].alias("value"))
        spans = let(stops, lambda every: F.transform(parts, lambda p, i: span(p, F.get(every, i))))
        return F.filter(spans, lambda s: s["match"].isNotNull())

    return F.when(hint, let(parts, place)).otherwise(F.from_json(F.lit("[]"), f"array<{_SPAN}>"))


def _uncovered(candidates: Column, base: Column) -> Column:
    """The candidates that lie in no base span: no base span that starts before their end is past it by their start."""
    row = lambda last, none: lambda s: F.struct(s["start"].alias("start"), F.lit(last).alias("last"), s["stop"].alias("stop"), (F.lit(None).cast("string") if none else s["match"]).alias("match"))
    every = F.sort_array(F.concat(F.transform(base, row(0, True)), F.transform(candidates, row(1, False))))

    def left(every: Column) -> Column:
        reach = prefixes(F.transform(every, lambda s: F.when(s["last"] == 0, s["stop"]).otherwise(0)), F.greatest)
        span = lambda s: F.struct(F.lit("entropy").alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["match"].alias("match"), F.lit(None).cast("string").alias("value"))
        spans = let(reach, lambda r: F.transform(every, lambda s, i: F.when((s["last"] == 1) & (F.get(r, i) < s["stop"]), span(s))))
        return F.filter(spans, lambda s: s.isNotNull())

    return let(every, left)


def _gain(n: Column) -> Column:
    """n * log2(n), which is 0 for 0."""
    return F.when(n > 1, n * F.log2(n)).otherwise(F.lit(0.0))


def segments(text: Column, size: int) -> Column:
    """text in pieces of so many characters."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), 0)


def _overlapping(value: Column, window: int) -> Column:
    """value in segments that overlap by window - 1 characters, so that each window lies in one."""
    return let(segments(value, PART), lambda every: F.transform(every, lambda s, i: F.concat(s, F.coalesce(F.substring(F.get(every, i + 1), 1, window - 1), F.lit("")))))


def _entropy(part: Column, window: int) -> Column:
    """The largest entropy of the windows of a short text; null where it is shorter than a window.

    State: a count for each symbol, several packed in a long, and the sum s of n * log2(n); a window's entropy is
    log2(window) - s / window. A step adds one to the count of the character that enters and takes one from that of
    the one that leaves.
    """
    width = window.bit_length()  # bits of a count
    each = 63 // width  # counts in a long
    longs = -(-(len(SYMBOLS) + 1) // each)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def place(code: Column) -> Column:
        return F.struct(F.floor(code / each).cast("int").alias("at"), (F.pmod(code, F.lit(each)) * width).cast("int").alias("shift"))

    def count(counts: Column, p: Column) -> Column:
        return F.call_function("shiftrightunsigned", F.get(counts, p["at"]), p["shift"]).bitwiseAND(F.lit((1 << width) - 1))

    def step(state: Column, s: Column) -> Column:
        enters, leaves, counts = s["enters"], s["leaves"], state["counts"]
        put = lambda p, j: F.when(p["at"] == j, F.call_function("shiftleft", one, p["shift"])).otherwise(zero)
        moved = F.transform(counts, lambda c, j: c + put(enters, j) - F.when(leaves.isNotNull(), put(leaves, j)).otherwise(zero))
        n_in, n_out = count(counts, enters), F.coalesce(count(counts, leaves), F.lit(1))
        change = F.when(leaves.isNotNull() & (enters == leaves), 0.0).otherwise(_gain(n_in + 1) - _gain(n_in) + _gain(n_out - 1) - _gain(n_out))
        total = state["total"] + change
        full = state["seen"] + 1 >= window
        return F.struct(moved.alias("counts"), total.alias("total"), (state["seen"] + 1).alias("seen"), F.when(full, F.least(state["least"], total)).otherwise(state["least"]).alias("least"))

    codes = F.transform(_characters(part), lambda c: place(F.instr(F.lit(SYMBOLS), c)))
    steps = let(codes, lambda c: F.arrays_zip(c.alias("enters"), F.slice(F.concat(F.array_repeat(F.lit(None).cast("struct<at:int,shift:int>"), window), c), F.lit(1), F.size(c)).alias("leaves")))
    begin = F.struct(F.array_repeat(zero, longs).alias("counts"), F.lit(0.0).alias("total"), F.lit(0).alias("seen"), F.lit(1e9).alias("least"))
    least = F.aggregate(steps, begin, step, lambda state: state["least"])
    return F.when(F.length(part) >= window, F.log2(F.lit(float(window))) - least / window)


def _characters(part: Column) -> Column:
    return F.regexp_extract_all(part, F.lit("(?s)."), 0)


def largest_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits per character, of the windows of value; null where it is shorter.

    A long value is cut into segments, so time is linear.
    """
    return F.array_max(F.transform(_overlapping(value, window), lambda s: _entropy(s, window)))


def reaches(value: Column, bits: Column, window: int = WINDOW) -> Column:
    """Whether largest_entropy(value) is bits or more; a segment with too few different characters for it isn't looked at."""
    return F.exists(_overlapping(value, window), lambda s: (F.log2(F.size(F.array_distinct(_characters(s)))) >= bits - 1e-9) & F.coalesce(_entropy(s, window) >= bits, F.lit(False)))


def class_of(value: Column) -> Column:
    return F.when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hexadecimal").when(value.rlike("^[A-Za-z0-9]+$"), "alphanumeric").otherwise("base64")


def scan(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """docs (doc_id, text) with found, an array of (kind, start, stop) by start and kind, and the columns in keep.

    A null text counts as empty and has no spans; repeated rows and rows without an id are scanned alike.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select("doc_id", *keep, text.alias("_text"))
    t = F.col("_text")
    base = docs
    for kind, pattern, value in (("assign", ASSIGN, 1), ("access", ACCESS, 0), ("hex", HEX, 0)):
        base = base.withColumn(f"_{kind}", _placed(t, pattern, kind, t.rlike(HINTS[kind]), value))
    base = base.withColumn("_assign", F.filter("_assign", lambda x: F.length(x["value"]) >= 6))
    base = base.withColumn("_candidate", _placed(t, CANDIDATE, "entropy", t.rlike("[A-Za-z0-9+/_=-]{20}")))
    base = base.drop("_text").withColumn("_base", F.concat("_assign", "_access", "_hex"))
    likely = F.filter("_candidate", lambda c: c["match"].rlike("[0-9]") & c["match"].rlike("[A-Za-z]") & ~c["match"].rlike(ALLOW))
    base = base.withColumn("_likely", likely)
    base = base.withColumn("_open", F.when(F.size("_likely") > 0, _uncovered(F.col("_likely"), F.col("_base"))).otherwise(F.col("_likely")))

    def passes(c: Column) -> Column:
        kind = class_of(c["match"])
        bits = F.when(kind == "hexadecimal", THRESHOLDS["hexadecimal"]).when(kind == "alphanumeric", THRESHOLDS["alphanumeric"]).otherwise(THRESHOLDS["base64"])
        return let(bits, lambda b: reaches(c["match"], b))  # the class is told once, not for each segment

    base = base.withColumn("_high", F.filter("_open", passes))
    every = F.concat("_base", "_high")
    rank = lambda kind: F.array_position(F.array(*map(F.lit, (*BASE, "entropy"))), kind)
    order = lambda spans: F.transform(F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s["kind"]).alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind")))), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return base.select("doc_id", *keep, order(every).alias("found"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of what scan returns."""
    base = F.filter("found", lambda s: s["kind"] != "entropy")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span of text replaced by mark, and n_chars, where there is one, set to the new length.

    Spans that overlap are replaced as one. Null texts and all other columns stay as they are.
    """
    found = scan(docs.select("doc_id", "text", F.struct("*").alias("_row")), ("_row",))
    text = F.col("_row")["text"]

    some = F.size("found") > 0

    def between(spans: Column) -> Column:
        """The gaps before the spans that begin outside those before them, and the gap after the last."""
        reach = prefixes(F.transform(spans, lambda s: s["stop"]), F.greatest)
        gap = lambda at, s: F.when(s["start"] >= at, F.struct(at.alias("start"), s["start"].alias("stop")))
        return F.filter(let(reach, lambda r: F.transform(spans, lambda s, i: gap(F.coalesce(F.get(r, i - 1), F.lit(0)), s))), lambda g: g.isNotNull())

    def cut(every: Column) -> Callable[[Column], Column]:
        def text_of(g: Column) -> Column:
            inside = F.transform(F.sequence(F.floor(g["start"] / SEGMENT).cast("int"), F.floor(g["stop"] / SEGMENT).cast("int")), lambda i: F.substring(F.coalesce(F.get(every, i), F.lit("")), F.greatest(g["start"] - i * SEGMENT, F.lit(0)) + F.lit(1), g["stop"] - F.greatest(g["start"], i * SEGMENT)))
            return F.array_join(inside, "")

        return text_of

    end = F.struct(F.length(text).alias("start"), F.length(text).alias("stop"))
    gaps = let(F.concat(F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))), F.array(end)), between)
    clean = let(segments(text, SEGMENT), lambda every: F.array_join(F.transform(gaps, cut(every)), mark))
    found = found.withColumn("_clean", F.when(some, clean))
    new = {"text": F.when(some, F.col("_clean")).otherwise(text)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(some, F.length("_clean")).otherwise(F.col("_row")["n_chars"])
    return found.select(*(new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col("_row")[c].alias(c) for c in docs.columns))
