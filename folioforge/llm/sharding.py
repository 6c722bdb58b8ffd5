"""Sharding into ranges of equal bytes with sampled splitters.

Documents are ordered by (hash of the text, doc_id).  A size-weighted sample of the keys (its expected size is a
parameter) gives quantile boundaries of many small ranges, ``ranges_per_shard`` a shard and at least one for every
``rows_per_range`` rows; ranges found overfull, as one text may have a third of all rows, are subdivided by a hash of the
text, and the rows of texts above ``together`` by a hash of doc_id.  One aggregate counts the bytes and rows of every
range; the running sums of that table (on the driver: two numbers for every ``rows_per_range`` rows) place each range,
and a window inside a range places its rows, so no task sorts more than one small range.  A document goes to the shard in
which its middle byte lies; the rows of one text go together, by their common middle, unless they are more than
``together`` of a shard: such a text may be more than a shard, and shards stay equal only if it is cut at their ends.

Defined cases: null text has size 1; rows that repeat a doc_id are placed one after the other; a very long text is one row,
which no law can split, and only its hashes and size are kept; fewer documents than shards leave shards empty; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, literal_array, own_columns


def position(key: Column, sorted_array: Column, n: int) -> Column:
    """How many of the n sorted values are at most key (binary search)."""
    steps = []
    while (1 << len(steps)) <= n:
        steps.append(1 << len(steps))
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*map(F.lit, reversed(steps))),
        F.lit(0),
        lambda at, step: F.when((at + step <= n) & (F.get(sorted_array, at + step - 1) <= key), at + step).otherwise(at),
    )


def splitters(rows: DataFrame, total: int, ranges: int, sample: int) -> list[int]:
    """At most ranges - 1 boundaries of k from a sample of about ``sample`` rows drawn in proportion to their size."""
    if ranges < 2:
        return []
    rate = sample / total
    luck = (F.xxhash64("doc_id", "k", F.lit(17)).bitwiseAND(F.lit((1 << 40) - 1))) / float(1 << 40)
    drawn = rows.filter(luck < F.col("size") * rate).select("k", F.greatest(F.col("size").cast("double"), F.lit(1 / rate)).alias("weight"))
    run = F.sum("weight").over(Window.partitionBy().orderBy("k", "weight"))
    cell = F.floor(run * ranges / (F.sum("weight").over(Window.partitionBy()) * (1 + 1e-9)))
    return sorted({r[0] for r in drawn.select("k", cell.alias("cell")).filter("cell > 0").groupBy("cell").agg(F.min("k")).select("min(k)").collect()})


def shard_by_bytes(docs: DataFrame, shards: int = 16, ranges_per_shard: int = 16, rows_per_range: int = 1 << 16, sample_per_range: int = 8, together: float = 0.02) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot (gapless in the shard), grown_shard (null)."""
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce("text", F.lit(""))
    rows = scratch.table(
        own_columns(docs, "doc_id", "text").select(
            "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("k"), F.monotonically_increasing_id().alias("rid")
        )
    )
    total, n = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    ranges = max(shards * ranges_per_shard, -(-n // rows_per_range))
    bounds = splitters(rows, total, ranges, ranges * sample_per_range) if total else []
    ranged = rows.withColumn("range", position(F.col("k"), literal_array(bounds, "bigint"), len(bounds)))

    # Overfull ranges are subdivided; range number -> first number of its parts and how many they are.
    ranges = len(bounds) + 1
    limit, most_rows = 2 * total / ranges, 2 * n / ranges
    parts = [1] * ranges
    for r in ranged.groupBy("range").agg(F.sum("size"), F.count(F.lit(1))).collect():
        if ranges > 1:
            parts[r[0]] = max(1, round(2 * r[1] / limit) if r[1] > limit else 1, round(2 * r[2] / most_rows) if r[2] > most_rows else 1)
    first = [sum(parts[:i]) for i in range(ranges)]
    split = [r for r, k in enumerate(parts) if k > 1]
    apart = ranged.filter(F.col("range").isin(split)).groupBy("k").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > together * total / shards)
    hot = [r[0] for r in apart.select("k").collect()] if split else []  # fewer than shards / together
    spread = F.when(F.col("k").isin(hot), F.xxhash64("doc_id", "rid")).otherwise(F.xxhash64("k", F.lit(29))) if hot else F.xxhash64("k", F.lit(29))
    part = F.pmod(spread, F.element_at(literal_array(parts, "int"), F.col("range") + 1).cast("long"))
    celled = ranged.withColumn("cell", (F.element_at(literal_array(first, "int"), F.col("range") + 1) + part).cast("int")).drop("range")

    bytes_before, rows_before, b, m = [], [], 0, 0
    found = {r[0]: (r[1], r[2]) for r in celled.groupBy("cell").agg(F.sum("size"), F.count(F.lit(1))).collect()}
    for cell in range(sum(parts)):
        bytes_before.append(b)
        rows_before.append(m)
        b, m = b + found.get(cell, (0, 0))[0], m + found.get(cell, (0, 0))[1]

    line = Window.partitionBy("cell").orderBy("k", "doc_id", "rid").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy("cell", "k")
    at = celled.withColumn("after", F.sum("size").over(line)).withColumn("number", F.row_number().over(Window.partitionBy("cell").orderBy("k", "doc_id", "rid")))
    at = at.withColumn("group_bytes", F.sum("size").over(group)).withColumn("group_start", F.min(F.col("after") - F.col("size")).over(group))
    whole = F.col("group_bytes") <= together * total / shards
    middle = F.when(whole, F.col("group_start") + F.col("group_bytes") / 2).otherwise(F.col("after") - F.col("size") / 2)
    of_cell = lambda values: F.element_at(literal_array(values, "bigint"), F.col("cell") + 1)
    shard = F.least(F.lit(shards - 1), F.floor((of_cell(bytes_before) + middle) * shards / F.lit(max(1, total))).cast("int"))
    placed = scratch.table(at.select("doc_id", "size", "text_crc32", shard.alias("shard"), (of_cell(rows_before) + F.col("number") - 1).alias("place")))
    starts = dict(placed.groupBy("shard").agg(F.min("place")).collect())
    begin = F.element_at(literal_array([starts.get(s, 0) for s in range(shards)], "bigint"), F.col("shard") + 1)
    return scratch.keep(
        placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("place") - begin).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
