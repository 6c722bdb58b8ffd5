"""Mixing sources to target weights with hash-threshold histograms.

A document's hash (60 bits of the MD5 of its id) decides whether it is in a mix: it is if the hash is below its
source's threshold.  So the mixes of growing budgets are nested, and reruns agree.  The threshold of a budget comes
from histograms of tokens by source and hash bucket (12 bits): the running sum tells the boundary bucket, and only the
rows of that bucket are counted again by the next 12 bits, four times in all.  Nothing is sorted but the histograms,
which have at most 4096 rows a source; a source with a third of all rows is pre-aggregated like any other.

A source whose target exceeds its size is taken whole once or more, and by threshold once more for the rest.

Defined cases: null text has size 0; a null source is a source of its own, last in order; null doc_ids share one
hash; rows that repeat a doc_id are decided alike; a very long text is one row, taken or not; an empty table gives no rows;
other columns are ignored, and kept as they are by mixed_documents.  A row a source passes through windows without a key and
through one broadcast or join: it is meant for up to some hundred thousands of sources.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, own_columns, small, unused, word_count

BITS, LEVELS, HASH_BITS = 12, 4, 60


def document_hash(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def capped_targets(sizes: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """Adds target to (source, source_size): the total shared by weight, at most cap times the size, the excess reshared.

    Sources in code point order (null last) get the weights in turn.  Resharing until none is above its cap is the same
    as capping the sources of least size per weight, one after the other, while their share of the rest is above it.
    """
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1) % len(weights) + 1).cast("int"))
    w = sizes.withColumn("weight", weight.cast("long")).withColumn("most", cap * F.col("source_size"))
    order = everything.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total, weigh = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    rest = (total - F.coalesce(F.sum("most").over(before), F.lit(0))).cast("double") / (weigh - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    w = w.withColumn("capped", rest * F.col("weight") > F.col("most"))
    w = w.withColumn("all_size", total).withColumn("all_weight", weigh)
    gone, gone_weight = (F.sum(F.when(F.col("capped"), F.col(c)).otherwise(0)).over(everything) for c in ("most", "weight"))
    share = (F.col("all_size") - gone).cast("double") / (F.col("all_weight") - gone_weight) * F.col("weight")
    return w.select("source", "source_size", F.when(F.col("capped"), F.col("most").cast("double")).otherwise(share).alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds prefix and level_in to budgets (source, rest, ...): documents whose first 48 hash bits are below prefix, or
    equal to it if level_in, have about rest tokens of the source; the nearer of the two sums is taken."""
    state = scratch.table(budgets.withColumns({"prefix": F.lit(0).cast("long"), "base": F.lit(0).cast("long"), "inside": F.lit(0).cast("long")}))
    for level in range(1, LEVELS + 1):
        keep = HASH_BITS - BITS * level
        here = rows.withColumn("bucket", F.shiftright("h", keep)).withColumnRenamed("source", "row_source")
        open_ = state.filter("rest > 0").select("source", "rest", "prefix", "base")
        counted = here.join(open_, F.col("row_source").eqNullSafe(F.col("source")) & (F.shiftright("bucket", BITS) == F.col("prefix")))
        sums = counted.groupBy("source", "bucket").agg(F.sum("size").alias("inside"), F.first("rest").alias("rest"), F.first("base").alias("was"))
        line = Window.partitionBy("source").orderBy("bucket")
        run = sums.withColumn("base", F.col("was") + F.sum("inside").over(line) - F.col("inside"))
        found = run.filter("base < rest and base + inside >= rest").select(F.col("source").alias("at"), "bucket", F.col("base").alias("new_base"), F.col("inside").alias("new_inside"))
        state = scratch.table(
            state.join(found, state["source"].eqNullSafe(found["at"]), "left").select(
                *(state[c] for c in state.columns if c not in ("prefix", "base", "inside")),
                F.coalesce("bucket", F.shiftleft("prefix", BITS)).alias("prefix"),
                F.coalesce("new_base", "base").alias("base"),
                F.coalesce("new_inside", F.lit(0)).cast("long").alias("inside"),
            )
        )
    return state.withColumn("level_in", (F.col("rest") > 0) & (F.col("inside") > 0) & (F.col("base") + F.col("inside") - F.col("rest") <= F.col("rest") - F.col("base")))


def _plan(docs: DataFrame, weights: Sequence[int], cap: int, size: Callable[[Column], Column], scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, h) of every document, and (of, source_size, target, epochs, rest, prefix, level_in) by source."""
    base = own_columns(docs, "doc_id", "text", "source")
    rows = scratch.table(base.select("doc_id", "source", size(F.col("text")).alias("size"), document_hash(F.col("doc_id")).alias("h")))
    sizes = scratch.table(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    budgets = capped_targets(sizes, weights, cap)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    budgets = budgets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    return rows, thresholds(rows, budgets, scratch).withColumnRenamed("source", "of")


def _copies(h: Column) -> Column:
    first = F.shiftright(h, HASH_BITS - BITS * LEVELS)
    extra = (F.col("rest") > 0) & ((first < F.col("prefix")) | ((first == F.col("prefix")) & F.col("level_in")))
    return F.col("epochs") + extra.cast("int")


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3, size: Callable[[Column], Column] = word_count) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken (words), copies (times taken)."""
    scratch = Scratch(docs.sparkSession, "mixing")
    rows, plan = _plan(docs, weights, cap, size, scratch)
    out = rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("copies", _copies(F.col("h")))
    return scratch.keep(out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The documents of the mix with all their columns, each in as many rows as it is taken.

    Texts stay where they are: only the plan, a row a source, is joined to them.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    _, plan = _plan(docs, weights, cap, word_count, scratch)
    plan = scratch.keep(plan.select("of", "epochs", "rest", "prefix", "level_in"))
    source = docs["source"] if "source" in docs.columns else F.lit(None).cast("string")
    key = docs["doc_id"] if "doc_id" in docs.columns else F.lit(None).cast("bigint")
    # Under names that the documents don't have.
    names = {c: unused(docs, f"plan_{c}") for c in plan.columns}
    plan = plan.withColumnsRenamed(names)
    first = F.shiftright(document_hash(key), HASH_BITS - BITS * LEVELS)
    p = lambda c: F.col(names[c])
    copies = p("epochs") + ((p("rest") > 0) & ((first < p("prefix")) | ((first == p("prefix")) & p("level_in")))).cast("int")
    joined = docs.join(small(plan, 64), source.eqNullSafe(p("of"))).filter(copies > 0)
    own = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*own, F.explode(F.sequence(F.lit(1), copies)).alias(unused(docs, "copy"))).select(*own)
