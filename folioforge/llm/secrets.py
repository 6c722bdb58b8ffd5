"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

The patterns' matches are located with built-in functions: a text is split at the matches, and the running lengths of
the parts and matches are the spans (in code points, end exclusive); lengths are summed up in blocks, so the work is
linear in the matches but for the square of the number of blocks.  Candidates for the entropy scan are the long runs of a
character class (CLASSES); a window slides over each, its counts (five bits each, twelve to a number) and its sum of
c * log2(c) changed by the one character that leaves and the one that enters, and the span goes from the first window over
the class's threshold to the last.  What is on the allow-list is suppressed: placeholders and fillers (FILLERS) end a run
where they stand, and the rest of it is still scanned; runs of words or numbers alone (ALLOWED) are no candidates.
Everything is an expression on the row: no shuffle, no Python.

Defined cases: null text counts as empty, and has no spans; repeated rows are scanned alike; a text may be one long
candidate or have hundreds of thousands of matches; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import literal_array, own_columns

# The base patterns. A short value fails the match, which is consumed all the same, so its length is
# tested after matching; runs of one class can have the least length in the pattern.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12


class CharacterClass(NamedTuple):
    """Runs of letters at least window long; entropy in bits a character over window characters."""

    kind: str
    pattern: str
    alphabet: str
    window: int
    threshold: float


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    CharacterClass("entropy_hex", r"[0-9A-Fa-f]{20,}", _DIGITS + "abcdefABCDEF", 20, 3.0),
    CharacterClass("entropy_base64", r"[A-Za-z0-9+/_-]{24,}", _UPPER + _LOWER + _DIGITS + "+/_-", 24, 4.0),
)
#: Candidates that match are no secrets: words and numbers alone.
ALLOWED = r"^[A-Za-z+/_-]*$|^[0-9+/_-]*$"
#: Placeholders, counting and alphabetical fillers; in either case.
FILLERS = ("placeholder", "changeme", "redacted", "xxxxxxxx", "01234567", "12345678", "abcdefgh", "example", "sample", "dummy")
#: Lengths that are summed up at once.
BLOCK = 256
#: Bits of a window's count, and counts in a number.
COUNT_BITS, PACKED = 5, 12


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once: as the argument of a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(lengths: Column) -> Column:
    """The sums of an array's numbers up to each one."""
    sums = "struct<at:int,sums:array<int>>"
    none = F.struct(F.lit(0).alias("at"), F.array().alias("sums")).cast(sums)

    def add(s: Column, n: Column) -> Column:
        return F.struct((s["at"] + n).alias("at"), F.concat(s["sums"], F.array(s["at"] + n)).alias("sums"))

    def start(s: Column, block: Column) -> Column:
        return F.struct((s["at"] + block["at"]).alias("at"), F.concat(s["sums"], F.array(s["at"])).alias("sums"))

    def joined(n: Column) -> Column:
        taken = lambda b: F.transform(F.sequence(b * BLOCK, F.least(F.size(n), (b + 1) * BLOCK) - 1), lambda i: F.get(n, i))  # noqa: E731  slice would copy all of it
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(taken(b), none, add))
        return bound(blocks, lambda bs: F.flatten(F.zip_with(bs, F.aggregate(bs, none, start)["sums"], lambda block, at: F.transform(block["sums"], lambda x: x + at))))

    return bound(lengths, lambda n: F.when(F.size(n) > 0, joined(n)).otherwise(F.array().cast("array<int>")))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, hit>> of the leftmost non-overlapping matches."""
    parts, hits = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.slice(parts, F.lit(1), F.size(hits)), hits, lambda p, h: F.char_length(p) + F.char_length(h))
    found = F.zip_with(hits, running(steps), lambda h, end: F.struct((end - F.char_length(h)).alias("start"), end.alias("end"), h.alias("hit")))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<start:int,end:int,hit:string>>"))


def without_fillers(text: Column) -> Column:
    """The text with spaces in place of FILLERS, so that other places stay where they are."""
    masked = text
    for n in sorted({len(f) for f in FILLERS}, reverse=True):
        masked = F.regexp_replace(masked, "(?i:" + "|".join(f for f in FILLERS if len(f) == n) + ")", " " * n)
    return F.when(text.rlike("(?i:" + "|".join(FILLERS) + ")"), masked).otherwise(text)


def hot_range(candidate: Column, kind: CharacterClass) -> Column:
    """struct<first, last>: from the first to the end of the last window over the threshold; null fields if none is."""
    w, numbers = kind.window, -(-len(kind.alphabet) // PACKED)
    assert w < 1 << COUNT_BITS
    table = literal_array([0.0, *(c * math.log2(c) for c in range(1, w + 1))], "double")
    codes = F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(kind.alphabet)) - 1)
    state = "struct<" + "".join(f"c{j}:bigint," for j in range(numbers)) + "sum:double,first:int,last:int>"
    begin = F.struct(*(F.lit(0).cast("long").alias(f"c{j}") for j in range(numbers)), F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    term = lambda count: F.get(table, count.cast("int"))
    place = lambda code: F.pmod(code, F.lit(PACKED)) * COUNT_BITS

    def count_of(s: Column, code: Column) -> Column:
        packed = F.get(F.array(*(s[f"c{j}"] for j in range(numbers))), F.floor(code / PACKED).cast("int"))
        return F.call_function("shiftright", packed, place(code)).bitwiseAND(F.lit((1 << COUNT_BITS) - 1))

    def moved(s: Column, new: Column, old: Column, i: Column) -> Column:
        stays = F.coalesce(new == old, F.lit(False))
        gone = F.when(old.isNull(), F.lit(0.0)).otherwise(bound(count_of(s, old), lambda c: term(c - 1) - term(c)))
        come = bound(count_of(s, new), lambda c: term(c + 1) - term(c))
        unit = lambda code, j: F.when(F.floor(code / PACKED) == j, F.call_function("shiftleft", F.lit(1).cast("long"), place(code))).otherwise(F.lit(0))
        total = F.when(stays, s["sum"]).otherwise(s["sum"] + gone + come)

        def after(total: Column) -> Column:
            hot = (i >= w - 1) & (F.lit(math.log2(w)) - total / w >= kind.threshold)
            return F.struct(
                *(F.when(stays, s[f"c{j}"]).otherwise(s[f"c{j}"] + unit(new, j) - F.coalesce(unit(old, j), F.lit(0))).alias(f"c{j}") for j in range(numbers)),
                total.alias("sum"), F.when(hot & s["first"].isNull(), i - (w - 1)).otherwise(s["first"]).alias("first"), F.when(hot, i + 1).otherwise(s["last"]).alias("last"),
            ).cast(state)

        return bound(total, after)

    def scanned(c: Column) -> Column:
        step = lambda s, i: moved(s, F.get(c, i), F.when(i >= w, F.get(c, i - w)), i)
        return F.aggregate(F.sequence(F.lit(0), F.size(c) - 1), begin.cast(state), step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    return bound(codes, scanned)


def _spans(found: Column, rank: int, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))


def _hot_spans(kind: CharacterClass) -> Column:
    ranges = F.transform(kind.kind, lambda m: F.struct(m["start"].alias("at"), hot_range(m["hit"], kind).alias("hot")))
    found = F.filter(ranges, lambda x: x["hot"]["first"].isNotNull())
    return F.transform(found, lambda x: F.struct((x["at"] + x["hot"]["first"]).alias("start"), (x["at"] + x["hot"]["last"]).alias("end")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    text = F.col("text")
    rows = own_columns(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", without_fillers(text).alias("unfilled"))
    rows = rows.select(
        "doc_id",
        F.filter(located(text, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["hit"], ASSIGN, 2)) >= ASSIGN_LEAST).alias("assign"),
        located(text, ACCESS).alias("access"),
        located(text, HEX).alias("hex"),
        *(F.filter(located(F.col("unfilled"), c.pattern), lambda m: ~m["hit"].rlike(ALLOWED)).alias(c.kind) for c in CLASSES),
    )
    hot = {c.kind: _hot_spans(c) for c in CLASSES}
    base = F.concat(*(_spans(F.col(k), i, k) for i, k in enumerate(("assign", "access", "hex"))))
    more = F.concat(base, *(_spans(v, 3 + i, k) for i, (k, v) in enumerate(hot.items())))
    return rows.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(more).alias("spans"),
    )
