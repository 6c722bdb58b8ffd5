"""List groups: islands of list-styled paragraphs, their titles and their text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LIST_TITLE_STYLE, format_list, is_list_style, strip, text_or_empty


def list_islands(paragraphs: DataFrame) -> DataFrame:
    """Rows of paragraphs (doc_id, doc_index, ord, text, style, ...) that belong to a list of two or more, with group.

    A list ends at a paragraph of another style and where doc_index jumps; rows without one come last."""
    line = Window.partitionBy("doc_id").orderBy(F.col("doc_index").asc_nulls_last(), "ord")
    p = paragraphs.withColumn("__list", is_list_style(F.col("style")))
    # The jump is measured from the last index that the list has; other paragraphs between end it anyway.
    last = F.last(F.when(F.col("__list"), F.col("doc_index")), ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, -1))
    starts = ~F.col("__list") | ~F.coalesce(F.lag("__list").over(line), F.lit(False)) | F.coalesce(F.col("doc_index") > last + 1, F.lit(False))
    p = p.withColumn("group", F.sum(starts.cast("int")).over(line.rowsBetween(Window.unboundedPreceding, 0))).filter("__list")
    group = Window.partitionBy("doc_id", "group")
    p = p.withColumn("__n", F.count(F.lit(1)).over(group)).withColumn("first_index", F.first("doc_index").over(group.orderBy(F.col("doc_index").asc_nulls_last(), "ord")))
    return p.filter((F.col("__n") > 1) & F.col("first_index").isNotNull()).drop("__n", "__list")


def list_titles(firsts: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Adds title to rows (doc_id, first_index): of the two paragraphs before it, the nearer that is a list title."""
    text = strip(text_or_empty(F.col("text")))
    image = F.coalesce(F.col("image_included"), F.lit(False)) if "image_included" in paragraphs.columns else F.lit(False)
    fits = (text != "") & ~image & ~text.startswith("[image:") & (strip(text_or_empty(F.col("style"))) == LIST_TITLE_STYLE)
    last = paragraphs.filter(F.col("doc_index").isNotNull()).groupBy("doc_id", "doc_index").agg(F.max_by(F.when(fits, text), "ord").alias("title")).filter("title is not null")
    reach = last.select("doc_id", F.explode(F.array(F.struct(F.lit(1).alias("by")), F.struct(F.lit(2).alias("by")))).alias("x"), "doc_index", "title")
    reach = reach.select("doc_id", (F.col("doc_index") + F.col("x.by")).alias("first_index"), F.col("x.by").alias("by"), "title")
    nearest = reach.groupBy("doc_id", "first_index").agg(F.min_by("title", "by").alias("title"))
    return firsts.join(nearest, ["doc_id", "first_index"], "left").withColumn("title", text_or_empty(F.col("title")))


def list_components(paragraphs: DataFrame) -> DataFrame:
    """One row per list: doc_id, doc_index, text, style, source_doc_indices, emphasized, math_texts, image_included."""
    p = list_islands(paragraphs)
    have = set(paragraphs.columns)
    strings = F.array().cast("array<string>")
    array = lambda name, empty: F.coalesce(F.col(name), empty) if name in have else empty
    image = F.coalesce(F.col("image_included"), F.lit(False)) if "image_included" in have else F.lit(False)
    all_ = F.array_sort(
        F.collect_list(
            F.struct(
                F.col("doc_index").isNull().alias("none"), "doc_index", "ord", F.col("text").alias("text"),
                array("source_doc_indices", F.array().cast("array<int>")).alias("sources"), array("emphasized", strings).alias("emphasized"), array("math_texts", strings).alias("math_texts"),
            )
        )
    )
    g = p.groupBy("doc_id", "group", "first_index").agg(all_.alias("all"), F.bool_or(image).alias("image_included"))
    g = list_titles(g, paragraphs)
    items = F.transform(F.filter("all", lambda x: F.coalesce(x["text"], F.lit("")) != ""), lambda x: x["text"])
    flat = lambda name: F.flatten(F.transform("all", lambda x: x[name]))
    indices = F.concat(F.transform("all", lambda x: x["doc_index"].cast("int")), flat("sources"))
    return g.select(
        "doc_id", F.col("first_index").alias("doc_index"), format_list(F.col("title"), items).alias("text"), F.lit("List Bullet").alias("style"),
        F.array_sort(F.array_distinct(F.filter(indices, lambda i: i.isNotNull()))).alias("source_doc_indices"), flat("emphasized").alias("emphasized"), flat("math_texts").alias("math_texts"), "image_included",
    )


def consumed(paragraphs: DataFrame) -> DataFrame:
    """doc_id, doc_index of the paragraphs that became part of a list."""
    return list_islands(paragraphs).filter(F.col("doc_index").isNotNull()).select("doc_id", "doc_index").distinct()


