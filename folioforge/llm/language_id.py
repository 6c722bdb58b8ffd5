"""Language identification by rank-order profiles (Cavnar and Trenkle 1994).

A language's profile is the ranked list of its most frequent letter n-grams (1 to 3 letters, words padded with a
space); a document's is built the same way from its whole text.  The out-of-place distance sums, over the document's
n-grams, how far each one's rank is from its rank in the language's profile (the profile size if it isn't there); the
nearest language wins, ties by name.  score is the winner's lead: 1 - distance / the distance of the runner-up's, or
1 - distance / worst if only one language was learned.

Profiles are fitted on a bounded sample of the labelled rows: about ``sample_per_language`` whole documents a language,
taken by a hash of doc_id; n-gram counts are summed by Spark, and only the profiles (``profile_size`` n-grams a
language) reach the driver.

Defined cases: null text, or one without a letter, is ``und`` with score 0, as is everything if no labelled row was
there to learn from; rows that repeat are decided alike; a very long text is counted whole, slice by slice, and takes some
ten times its bytes; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import own_columns, ship_package, small

UNDETERMINED = "und"


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id has fold 0, so it is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


_OTHERS = re.compile(r"[\W\d_]+")


#: Characters whose n-grams are counted at once; a longer text is counted slice by slice.
SLICE = 1 << 20


def _letters(text: str) -> str:
    """Lower case; every run of others than letters is one space, and there is one at each end; empty without a letter."""
    kept = _OTHERS.sub(" ", text.lower()).strip()
    return f" {kept} " if any(map(str.isalpha, kept)) else ""


def grams(text: str):
    """(codes, counts) of the n-grams of a text; a code has 21 bits a letter, and the length above them by their number."""
    import numpy as np

    letters = _letters(text)
    found, counted = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(letters), SLICE):  # n-grams that begin in the slice
        p = np.frombuffer(letters[lo : lo + SLICE + 2].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        two = (p[:-1] << 21) | p[1:]
        three = (two[:-1] << 21) | p[2:]
        codes, counts = np.unique(np.concatenate([p[:SLICE], two[:SLICE], three[:SLICE]]), return_counts=True)
        found.append(codes)
        counted.append(counts)
    codes, at = np.unique(np.concatenate(found), return_inverse=True)
    counts = np.bincount(at, np.concatenate(counted), len(codes)).astype(np.int64)
    blank = (codes == 32) | (codes == (32 << 21 | 32))
    return codes[~blank], counts[~blank]


def ranked(codes, counts, size: int):
    """The codes of the size most frequent n-grams, most frequent first, ties by code."""
    import numpy as np

    if len(codes) > size:  # those that tie with the last stay for the sort
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        near = counts >= least
        codes, counts = codes[near], counts[near]
    return codes[np.lexsort((codes, -counts))][:size]


def profiles(labelled: DataFrame, profile_size: int = 400, sample_per_language: int = 1500) -> dict[str, list[int]]:
    """Language -> ranked n-gram codes, from rows (doc_id, text, lang) that may be learned from."""
    ship_package(labelled.sparkSession)
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rate = rows.groupBy("lang").agg((F.lit(sample_per_language) / F.count(F.lit(1))).alias("rate")).withColumnRenamed("lang", "of")
    luck = F.xxhash64("doc_id", F.lit(11)).bitwiseAND(F.lit((1 << 32) - 1)) / float(1 << 32)
    # A row a language; broadcast, as else the texts would be shuffled by language.
    sample = rows.join(small(rate, 64), F.col("lang") == F.col("of")).filter(luck < F.col("rate")).select("lang", "text")

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by.setdefault(lang, []).append(grams(text))
            for lang, found in by.items():
                codes = np.concatenate([c for c, _ in found])
                sums = np.concatenate([n for _, n in found])
                distinct, at = np.unique(codes, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(distinct), pa.string()), pa.array(distinct), pa.array(np.bincount(at, sums, len(distinct)).astype(np.int64))], ["lang", "code", "n"]
                )

    counted = sample.mapInArrow(run, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = counted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).filter(F.col("rank") <= profile_size)
    out: dict[str, list[int]] = {}
    for row in best.orderBy("lang", "rank").collect():
        out.setdefault(row["lang"], []).append(row["code"])
    return out


class Classifier:
    def __init__(self, learned: dict[str, list[int]], profile_size: int):
        import numpy as np

        self.size = profile_size
        self.names = sorted(learned)
        self.codes = np.unique(np.array([c for x in learned.values() for c in x], np.int64))
        self.ranks = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for i, name in enumerate(self.names):
            self.ranks[i, np.searchsorted(self.codes, learned[name])] = np.arange(len(learned[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        import numpy as np

        if not text or not self.names:
            return UNDETERMINED, 0.0
        codes, counts = grams(text)
        if not len(codes):
            return UNDETERMINED, 0.0
        codes = ranked(codes, counts, self.size)
        at = np.searchsorted(self.codes, codes)
        at[(at < len(self.codes)) & (self.codes[np.minimum(at, len(self.codes) - 1)] != codes)] = len(self.codes)
        rank = self.ranks[:, at]
        apart = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(codes)))).sum(axis=1)
        order = np.argsort(apart, kind="stable")
        worst = apart[order[1]] if len(order) > 1 else self.size * len(codes)
        return self.names[order[0]], float(1 - apart[order[0]] / worst) if worst else 0.0


def identify(docs: DataFrame, profile_size: int = 400, sample_per_language: int = 1500) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, text_hash; learned from the folds other than 0."""
    base = own_columns(docs, "doc_id", "text", "lang")
    learned = profiles(base.filter(fold(F.col("doc_id")) != 0), profile_size, sample_per_language)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = Classifier(learned, profile_size)
        for batch in batches:
            found = [model.predict(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64()), batch.column(3)], ["doc_id", "held_out", "lang_pred", "score", "text_hash"]
            )

    rows = base.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, text_hash bigint")


def identified_documents(docs: DataFrame, profile_size: int = 400, sample_per_language: int = 1500) -> DataFrame:
    """The documents that have a language, with all their columns: those predicted ``und`` go, and where lang is null it
    becomes the predicted one."""
    base = own_columns(docs, "doc_id", "text", "lang")
    learned = profiles(base.filter(fold(F.col("doc_id")) != 0), profile_size, sample_per_language)
    names = docs.columns

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        model = Classifier(learned, profile_size)
        for batch in batches:
            texts = batch.column(names.index("text")).to_pylist() if "text" in names else [None] * batch.num_rows
            found = pa.array([model.predict(t)[0] for t in texts], pa.string())
            if "lang" in names:
                at = names.index("lang")
                batch = batch.set_column(at, batch.schema.field(at), pc.coalesce(batch.column(at), found))
            yield batch.filter(pc.not_equal(found, UNDETERMINED))

    return docs.mapInArrow(run, docs.schema)
