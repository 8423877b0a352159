"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, ``://``, plus signs, digits, and cues of
identifiers and of postal addresses. From each anchor a small deterministic parser expands to both sides and validates what it finds. Spans
are in code points, with an exclusive end.

Base kinds, each as the leftmost matches of its pattern that don't overlap, failing ones dropped without another try:
email, ip (parts at most 255), card (12 to 19 digits that pass Luhn), phone (9 to 15 digits).
Further kinds: login (user and password in a URL), iban (checked mod 97), account (digits after a cue), address (after
a cue, a house number, one to six words and a word for a street, each with a capital letter).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from envflow.llm.common import small_batches

BASE = ("email", "ip", "card", "phone")
MORE = ("login", "iban", "account", "address")
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\v\f/?#\"'<>")
#: Cues of an account number, in lower case; a text may have them in any.
CUES = ("account number", "account no", "account:", "acct no", "acct:", "a/c no", "routing number", "member id", "customer id", "iban")
#: Cues of a postal address, and the words that end its street, in lower case.
PLACES = ("address:", "address is", "lives at", "living at", "resides at", "ship to", "deliver to")
STREETS = frozenset(("street", "st", "avenue", "ave", "road", "rd", "lane", "ln", "boulevard", "blvd", "drive", "dr", "court", "ct", "square", "place", "way", "terrace"))
#: Words that may stand between a cue and its number.
_BETWEEN = frozenset(" :#.=")


def anchors():
    """The automaton; its values are kinds of anchors and, for cues, their lengths."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for sign in ("@", "://", "+", *sorted(_DIGITS)):
        found.add_word(sign, ("digit" if sign in _DIGITS else sign, len(sign)))
    for cue in CUES:
        found.add_word(cue, ("cue", len(cue)))
    for cue in PLACES:
        found.add_word(cue, ("place", len(cue)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """text with A-Z in lower case, of the same length: bytes know no other letters."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters that begins at at."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at at, none of it before floor."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end + 1 < len(text) and text[end] == "." and text[end + 1] in _LABEL:
        end, labels = _run(text, end + 1, _LABEL), labels + 1
    return (start, end) if labels else None


def ip_at(text: str, at: int) -> tuple[int, bool] | None:
    """(end, valid) of four dotted numbers from the first digit at at."""
    parts, end = [], at
    for i in range(4):
        if i:
            if end + 1 >= len(text) or text[end] != "." or text[end + 1] not in _DIGITS:
                return None
            end += 1
        stop = _run(text, end, _DIGITS)
        parts.append(text[end:stop])
        end = stop
    return end, all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in parts))


def card_at(text: str, at: int) -> int | None:
    """The end of digits, each after one blank or hyphen at most, from the digit at at; none for a single digit."""
    end, n = at + 1, len(text)
    while end < n:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    return end if end > at + 1 else None


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def phone_at(text: str, at: int) -> int | None:
    """The end of a number from the plus sign at at."""
    if at + 1 >= len(text) or text[at + 1] not in _DIGITS:
        return None
    end = _run(text, at + 2, _PHONE)
    while end > at + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    return end if end > at + 3 else None


def digits_of(part: str) -> str:
    return "".join(c for c in part if c in _DIGITS)


def login_at(text: str, at: int) -> tuple[int, int] | None:
    """user:password before the at-sign of a URL whose ``://`` ends at at."""
    end = at
    while end < len(text) and text[end] not in _URL_END:
        if text[end] == "@":
            return (at, end) if ":" in text[at:end] and end > at + 2 else None
        end += 1
    return None


def iban_valid(value: str) -> bool:
    plain = value.replace(" ", "").upper()
    if not 15 <= len(plain) <= 34 or not plain[:2].isalpha() or not plain[2:4].isdigit():
        return False
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def account_at(text: str, at: int) -> tuple[str, int, int] | None:
    """What follows a cue that ends at at: an IBAN, or 6 to 17 digits with hyphens or blanks between."""
    start = at
    while start < len(text) and start - at < 4 and text[start] in _BETWEEN:
        start += 1
    end = start
    while end < len(text) and end - start < 42 and (text[end] in _ALNUM or text[end] == " "):
        end += 1
    for stop in range(end, start + 14, -1):
        if text[stop - 1] in _ALNUM and iban_valid(text[start:stop]):
            return "iban", start, stop
    if start < len(text) and text[start] in _DIGITS:
        stop = card_at(text, start) or start + 1
        if 6 <= len(digits_of(text[start:stop])) <= 17 and (stop == len(text) or text[stop] not in _ALNUM):
            return "account", start, stop
    return None


def address_at(text: str, at: int) -> tuple[int, int] | None:
    """The house number, words and street after a cue that ends at at: one to six words before the word for a street, all capitalised."""
    start = at
    while start < len(text) and start - at < 4 and text[start] in _BETWEEN:
        start += 1
    end = _run(text, start, _DIGITS)
    if not 1 <= end - start <= 6:
        return None
    if end < len(text) and text[end] in _ALNUM:
        end += 1  # a house number may have a letter
    for turn in range(7):
        if end + 1 >= len(text) or text[end] != " " or not text[end + 1].isupper():
            return None
        word, end = end + 1, end + 2
        while end < len(text) and end - word < 40 and (text[end].isalpha() or text[end] in "'-"):
            end += 1
        if turn and lowered(text[word:end]) in STREETS and (end == len(text) or not text[end].isalnum()):
            return start, end
    return None


def find(text: str, automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then by kind as listed."""
    spans, past = [], dict.fromkeys((*BASE, "account", "address"), 0)
    for last, (sign, width) in automaton.iter(lowered(text)):
        at = last - width + 1
        if sign == "digit":
            if at >= past["card"]:
                end = card_at(text, at)
                past["card"] = end or at + 1
                if end and 12 <= len(digits := digits_of(text[at:end])) <= 19 and luhn(digits):
                    spans.append(("card", at, end))
            if at >= past["ip"]:
                found = ip_at(text, at)
                # a number that begins no address hides its own later digits: from there it fails the same way
                past["ip"] = found[0] if found else _run(text, at, _DIGITS)
                if found and found[1]:
                    spans.append(("ip", at, found[0]))
        elif sign == "@":
            if at >= past["email"] and (found := email_at(text, at, past["email"])):
                past["email"] = found[1]
                spans.append(("email", *found))
        elif sign == "+":
            if at >= past["phone"] and (end := phone_at(text, at)):
                past["phone"] = end
                if 9 <= len(digits_of(text[at:end])) <= 15:
                    spans.append(("phone", at, end))
        elif sign == "://":
            if found := login_at(text, last + 1):
                spans.append(("login", *found))
        elif sign == "place":
            if at >= past["address"] and (found := address_at(text, last + 1)):
                past["address"] = found[1]
                spans.append(("address", *found))
        elif at >= past["account"] and (found := account_at(text, last + 1)):
            past["account"] = found[2]
            spans.append(found)
    order = {k: i for i, k in enumerate((*BASE, *MORE))}
    return sorted(spans, key=lambda s: (s[1], order[s[0]], s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, found.

    found is a list of (kind, start, end); spans is the same as text, and base_sha256 is over the base kinds alone.
    A null text counts as empty and has no spans. Repeated rows are scanned alike; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "found"]
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            each = [find(t.as_py() or "", automaton) for t in batch.column("text")]
            base = [[s for s in spans if s[0] in BASE] for spans in each]
            counts = [pa.array([sum(s[0] == k for s in spans) for spans in base], pa.int64()) for k in BASE]
            sha = pa.array([hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base], pa.string())
            found = pa.array([[{"kind": k, "start": a, "stop": b} for k, a, b in spans] for spans in each], item)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, sha, pa.array(list(map(joined, each)), pa.string()), found], names=names)

    schema = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, found array<struct<kind:string,start:bigint,stop:bigint>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
