"""Section trees as rows (doc_id, section_id, parent_id, level, span_start, span_end, path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def own_blocks(blocks: DataFrame, spans: DataFrame) -> DataFrame:
    """Blocks (section_id, doc_index, ...) that no subsection span (parent_id, span_start, span_end) of their section
    covers; a block without a place is covered by none.  An anti join on the section, with the range as its residue."""
    s = spans.select(F.col("parent_id").alias("__section"), F.col("span_start").alias("__from"), F.col("span_end").alias("__to"))
    covered = (F.col("section_id") == F.col("__section")) & (F.col("doc_index") >= F.col("__from")) & (F.col("doc_index") < F.col("__to"))
    return blocks.join(s, covered, "left_anti")


def section_tree(headings: DataFrame) -> DataFrame:
    """Sections of headings (doc_id, pos, level, title) in document order: each spans up to the next heading that is not
    deeper (null at the end), and its parent is the nearest shallower heading before it."""
    line = Window.partitionBy("doc_id").orderBy("pos")
    before, after = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(1, Window.unboundedFollowing)
    parent = F.lit(None).cast("bigint")
    stop = F.lit(None).cast("bigint")
    for level in range(1, 5):
        nearest = F.greatest(F.lit(-1), *(F.coalesce(F.last(F.when(F.col("level") == k, F.col("pos")), ignorenulls=True).over(before), F.lit(-1)) for k in range(1, level)), *([F.lit(-1)] if level == 1 else []))
        parent = F.when((F.col("level") == level) & (nearest >= 0), nearest.cast("bigint")).otherwise(parent)
        stop = F.when(F.col("level") == level, F.min(F.when(F.col("level") <= level, F.col("pos"))).over(after).cast("bigint")).otherwise(stop)
    return headings.select("doc_id", F.col("pos").cast("bigint").alias("section_id"), parent.alias("parent_id"), "level", F.col("pos").cast("bigint").alias("span_start"), stop.alias("span_end"), "title")
