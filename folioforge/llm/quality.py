"""Quality rules as a bitmask ledger.

Every text is measured once; every rule is evaluated once on the measurements and leaves a bit.  The ledger, measurements
and bits with the version of the rules, is a table (:func:`store`, :func:`stored`).  Policies are versioned sets of rules: a
verdict is one bitwise AND of the stored ledger with the policy's mask, so a new policy or an ablation needs no second look
at any text.  :func:`ablation` counts, for every rule, what it fails and what it alone fails, from the
histogram of the bit patterns.

Measurements need the words of a text and its repeated 8-word windows; they are taken in Arrow batches, a document at a
time.  Windows are told apart exactly, by ranks of pairs of words, of pairs of these and so on.  Defined cases: null text has
no words; repeated rows are measured alike; a very long text is measured whole, in some hundred bytes a word; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, own_columns, ship_package

WINDOW = 8
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MEASURES = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"

#: Version of RULES, which goes with every row of a ledger.
RULES_VERSION = 1
#: Rule name -> failing condition on the measurements; a rule's bit is its place here, and new rules are appended.
RULES = {
    "too_few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 14 * n_words",
    "symbols": "10 * n_symbols > 6 * n_words",
    "duplicate_lines": "n_dup_lines >= 3 and 8 * n_dup_lines > n_words",
}
#: Policy version -> the rules that it enforces.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "short_words", "long_words", "symbols", "duplicate_lines"),
}


def measure_text(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes are split at ASCII white space only
    n = len(words)
    ascii_blank = len(data) - len(data.translate(None, b" \t\n\r\x0b\x0c"))
    symbols = len(data) - len(data.translate(None, SYMBOLS.encode()))
    lines = [x for x in data.split(b"\n") if x.split(None, 1)]
    repeated = 0
    if n >= WINDOW:
        import numpy as np

        number: dict[bytes, int] = {}
        rank = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        kinds = len(number)
        for step in (1, 2, 4):  # ranks of two words, of four, of eight
            rank = np.unique(rank[:-step] * kinds + rank[step:], return_inverse=True)[1]
            kinds = int(rank.max()) + 1
        if kinds < len(rank):
            starts = np.flatnonzero(np.bincount(rank)[rank] > 1)
            inside = np.bincount(starts, minlength=n + 1) - np.bincount(starts + WINDOW, minlength=n + 1)
            repeated = int((np.cumsum(inside) > 0).sum())
    return n, len(text) - ascii_blank, symbols, len(lines) - len(set(lines)), repeated


def measurements(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the measurements."""

    ship_package(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [c.split()[0] for c in MEASURES.split(", ")]
        for batch in batches:
            rows = [measure_text(t or "") for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names)

    return own_columns(docs, "doc_id", "text").mapInArrow(run, MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and fail_bits: bit i is set if the rule in place i of RULES fails."""
    bits = sum((F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())), F.lit(0))
    return measurements(docs).withColumn("fail_bits", bits.cast("long")).withColumn("rules_version", F.lit(RULES_VERSION))


def store(docs: DataFrame, path: str) -> None:
    """Writes the ledger of docs."""
    ledger(docs).write.option("compression", "zstd").parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored ledger; one of other rules, whose bits mean something else, is an error when it is read."""
    rows = spark.read.parquet(path)
    message = F.lit(f"the ledger at {path} is not of rules version {RULES_VERSION}")
    return rows.withColumn("rules_version", F.when(F.col("rules_version") == RULES_VERSION, F.col("rules_version")).otherwise(F.raise_error(message).cast("int")))


def mask(policy: str) -> int:
    return sum(1 << list(RULES).index(rule) for rule in POLICIES[policy])


def passes(policy: str, bits: Column | str = "fail_bits") -> Column:
    """The verdict of a policy on the ledger's bits."""
    return (F.col(bits) if isinstance(bits, str) else bits).bitwiseAND(F.lit(mask(policy))) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """By rule of the policy: fails (documents that fail it) and fails_alone (that the policy would keep without it)."""
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(mask(policy) & (1 << list(RULES).index(r))).alias("bit")) for r in POLICIES[policy])))
    each = patterns.select("bits", "n", rules.alias("r")).select("n", "bits", "r.rule", F.col("r.bit").cast("long").alias("bit"))
    count = lambda hit: F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(count(F.col("bits").bitwiseAND(F.col("bit")) != 0)("fails"), count(F.col("bits") == F.col("bit"))("fails_alone"))


def verdicts(rows: DataFrame, policy: str) -> DataFrame:
    """A ledger with base_failed and kept."""
    base = ~passes("base")
    return rows.select("*", base.alias("base_failed"), (~base & passes(policy)).alias("kept"), F.lit(policy).alias("policy"))


def judged(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger of docs, stored in the shared folder, with the policy's verdicts."""
    scratch = Scratch(docs.sparkSession, "quality")
    store(docs, f"{scratch.root}/ledger")
    return scratch.keep(verdicts(stored(docs.sparkSession, f"{scratch.root}/ledger"), policy))


def policy_ablation(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """What each rule of the policy fails, from the stored ledger of docs."""
    scratch = Scratch(docs.sparkSession, "quality")
    store(docs, f"{scratch.root}/ledger")
    return scratch.keep(ablation(stored(docs.sparkSession, f"{scratch.root}/ledger"), policy))
