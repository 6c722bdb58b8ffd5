"""Small groups of equal texts stay together beside a hot text."""

from collections import defaultdict

from pyspark.sql import functions as F

from folioforge.llm import sharding


def test_small_groups_beside_a_hot_text_stay_together(spark):
    i = F.col("id")
    text = F.when(i % 3 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("t"), (i / 3).cast("long") % 500))
    df = spark.range(3000).select(i.alias("doc_id"), text.alias("text"))
    for rows_per_range in (16, 400, 1000):
        shards, sizes = defaultdict(set), defaultdict(int)
        for r in sharding.shard_by_bytes(df, rows_per_range=rows_per_range, together=0.15).collect():
            shards[r["text_crc32"]].add(r["shard"])
            sizes[r["text_crc32"]] += r["size"]
        total = sum(sizes.values())
        assert all(len(shards[k]) == 1 for k in shards if sizes[k] <= 0.15 * total / 16), rows_per_range
        assert sorted(set().union(*shards.values())) == list(range(16))
