"""Exact deduplication over an extendible-hash index on shared files.

Index entries are the distinct 64-bit hashes of the texts, pre-aggregated per task, so a text with a third of all rows is
one entry.  The index is built and used in three steps:

1. Directory (:func:`directory`).  Entries are counted by the leading bits of their hash; starting with one bucket, an
   overfull one is split by its next bit and the directory doubled as often as that needs, until no bucket holds more than
   its capacity.  Buckets that are still overfull at the bits counted so far are counted again by more bits, up to SLOT_BITS.
   The directory is a file (slot, bucket, owner).
2. Index files.  Every entry goes to its bucket's owner, the task of a contiguous range of buckets, which writes them in the
   order of bucket and hash to a folder of its own (hash, bucket, rows, best row).
3. Chains.  Rows find their bucket by the directory, and its owner's entry by the hash.  An entry of one row is settled.
   Where it has more, the texts of its rows are merged byte by byte, first in the task that reads them and then by the
   bucket's owner; texts that only share the hash are chained as entries of their own, told apart by their SHA-256.

A row's class is what the index files say of it: a row whose chain isn't there is a class of its own.  Only counts by slot and
the directory reach the driver, never a hash of a document.  A bucket holds ``capacity`` entries, or the MOST_BUCKETS-th part
of all if that is more, so the directory is bounded and a slot has bits enough for every bucket but those of hashes that
agree in all SLOT_BITS leading bits, which stay whole.

Defined cases: null text counts as empty; equal means byte-identical; of equal texts the largest doc_id stays (null sorts below
all; of rows that repeat doc_id and text, one stays); a very long text is read whole, in memory once in a task; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, drop_rows, own_columns, small

#: The capacity is such that the directory has about so many buckets at most.
MOST_BUCKETS = 1 << 16
#: Bits of a slot at most, and those by which buckets that are still overfull are counted anew.
SLOT_BITS, STEP = 20, 4


def directory(count: Callable[[int, int, list[int]], Mapping[int, int]], capacity: int, depth: int) -> list[tuple[int, int]]:
    """The buckets (local depth, leading bits), in the order of their hashes.

    count(depth, start, prefixes): entries by their leading ``depth`` bits, of those whose ``start`` leading bits are among
    the prefixes.
    """
    done, start = [], 0
    open_: list[tuple[int, int]] = [(0, 0)]
    depth = min(depth, SLOT_BITS)
    counts = count(depth, 0, [0])
    while open_:
        sums = [dict(counts)]  # by depth, from ``depth`` up to ``start``
        for _ in range(depth - start):
            up: dict[int, int] = {}
            for prefix, n in sums[-1].items():
                up[prefix >> 1] = up.get(prefix >> 1, 0) + n
            sums.append(up)
        again = []
        while open_:
            d, prefix = open_.pop()
            if sums[depth - d].get(prefix, 0) <= capacity or d == SLOT_BITS:
                done.append((d, prefix))
            elif d < depth:  # split: one bit more tells its two halves apart
                open_ += [(d + 1, 2 * prefix), (d + 1, 2 * prefix + 1)]
            else:
                again.append((d, prefix))
        if again:
            start, depth, open_ = depth, min(SLOT_BITS, depth + STEP), again
            counts = count(depth, start, [p for _, p in again])
    return sorted(done, key=lambda b: b[1] << (SLOT_BITS - b[0]))


def index_key(text: Column) -> Column:
    """The 64-bit key of a text in the index; different texts may share it."""
    return F.xxhash64(text)


def leading(h: Column | str, bits: int) -> Column:
    """The leading bits of a hash, as a number."""
    return F.shiftrightunsigned(h, 64 - bits).cast("long") if bits else F.lit(0).cast("long")


class Index(NamedTuple):
    """The directory's file (slot, bucket, owner), the bits of a slot, and the owners' files (owner, bucket, h, n, best)."""

    directory: DataFrame
    bits: int
    entries: DataFrame

    def bucket_of(self, rows: DataFrame) -> DataFrame:
        """rows (h, ...) with bucket and owner, by the directory."""
        slots = small(self.directory, 24)
        return rows.join(slots, leading("h", self.bits) == slots["slot"]).drop("slot")


def build_index(rows: DataFrame, scratch: Scratch, capacity: int) -> Index:
    """The index of rows (h, doc_id, rid)."""
    spark = rows.sparkSession
    entries = scratch.table(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "rid")).alias("best")))
    total = entries.count()
    capacity = max(capacity, total // MOST_BUCKETS)

    def constant(values: list, kind: str) -> DataFrame:
        return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(values)), f"array<struct<{kind}>>")))

    def count(depth: int, start: int, prefixes: list[int]) -> dict[int, int]:
        some = constant([{"prefix": p} for p in prefixes], "prefix:bigint")
        e = entries.join(small(some, 16), leading("h", start) == F.col("prefix"), "left_semi") if start else entries
        return {r[0]: r[1] for r in e.groupBy(leading("h", depth)).count().collect()}

    buckets = directory(count, capacity, max(1, (2 * total // capacity).bit_length()))
    bits = max(d for d, _ in buckets)
    owners = max(1, min(len(buckets), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    spans = [{"lo": p << (bits - d), "hi": (p + 1 << (bits - d)) - 1, "bucket": n, "owner": n * owners // len(buckets)} for n, (d, p) in enumerate(buckets)]
    spans = constant(spans, "lo:bigint,hi:bigint,bucket:int,owner:int")
    slots = scratch.table(spans.select(F.explode(F.sequence("lo", "hi")).alias("slot"), "bucket", "owner"))
    index = Index(slots, bits, entries)
    owned = index.bucket_of(entries).repartition(owners, "owner").sortWithinPartitions("owner", "bucket", "h")
    return index._replace(entries=scratch.table(owned, partition_by=["owner"]))


def classes(texts: DataFrame, rows: DataFrame, index: Index, scratch: Scratch) -> DataFrame:
    """(owner, bucket, h, only, n, best) of the index's entries with several rows; one row a text, told by its SHA-256 in
    ``only``, where an entry's texts differ."""
    key = ["owner", "bucket", "h"]
    chains = index.entries.filter("n > 1")
    wanted = small(chains.select("h"), 16)
    # Equal texts are merged in the task that reads them; the bucket's owner compares what is left, byte by byte.
    read = index.bucket_of(texts.join(wanted, "h", "left_semi")).select(*key, "text")
    chained = scratch.table(read.groupBy(*key).agg(F.size(F.collect_set("text")).alias("texts")))
    owned = chains.join(chained, key)
    mixed = small(owned.filter("texts > 1").select(*key), 24)
    # Hash collisions; as a rule there are none.
    apart = index.bucket_of(rows).join(mixed, key, "left_semi").groupBy(*key, "sha").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "rid")).alias("best"))
    one = owned.filter("texts = 1").select(*key, F.lit(None).cast("binary").alias("only"), "n", "best")
    return scratch.table(one.unionByName(apart.select(*key, F.col("sha").alias("only"), "n", "best")))


def exact_groups(docs: DataFrame, capacity: int = 64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, text_hash (xxhash64 of the text)."""
    scratch = Scratch(docs.sparkSession, "exact_dedup")
    texts = own_columns(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", index_key(F.col("text")))
    rows = scratch.table(texts.select("doc_id", "h", F.unhex(F.sha2("text", 256)).alias("sha"), F.monotonically_increasing_id().alias("rid")))
    index = build_index(rows, scratch, capacity)
    found = classes(texts.select("h", "text"), rows, index, scratch).withColumnsRenamed({"h": "of", "bucket": "of_bucket"}).drop("owner")
    looked_up = index.bucket_of(rows)
    here = (F.col("bucket") == F.col("of_bucket")) & (F.col("h") == F.col("of")) & (F.col("only").isNull() | (F.col("only") == F.col("sha")))
    joined = looked_up.join(found, here, "left")
    alone = F.col("n").isNull()
    return scratch.keep(
        joined.select(
            "doc_id",
            F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
            (alone | (F.col("best.rid") == F.col("rid"))).alias("kept"),
            F.lower(F.hex("sha")).alias("text_sha256"),
            F.col("h").alias("text_hash"),
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that exact deduplication keeps, with all their columns."""
    return drop_rows(docs, exact_groups(docs), F.col("kept"))
