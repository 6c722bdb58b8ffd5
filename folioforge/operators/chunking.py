"""Section-aware chunking of ordered elements, as windows over the elements of a document.

Elements are rows (doc_id, doc_index, kind_rank, ord, kind, text, style, media_id, page_number): kind is paragraph,
table or image.  A heading of level 2 to 4 opens a chunk; before the first such heading, the first paragraph after a
level-1 heading does.  A chunk's path is the titles in force where it opens.  Windows partition by document, so a
document is one task's work and documents are spread freely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import heading_level, is_blank, media_ids, section_intro, strip, text_or_empty

KINDS = {"paragraph": 0, "table": 1, "image": 2}
LEVELS = 4


def union_elements(paragraphs: DataFrame, tables: DataFrame, images: DataFrame) -> DataFrame:
    """The elements of paragraphs (doc_id, doc_index, text, style), tables (doc_id, doc_index, tid) and images (doc_id,
    doc_index, rId); elements without a place in the body are left out.  ord tells apart what shares a place."""

    def part(df: DataFrame, kind: str, text: str | None, media: str | None) -> DataFrame:
        col = lambda name: F.col(name).cast("string") if name else F.lit(None).cast("string")
        page = F.col("page_number").cast("int") if "page_number" in df.columns else F.lit(None).cast("int")
        order = F.col("ord").cast("long") if "ord" in df.columns else F.lit(0).cast("long")
        style = F.col("style") if kind == "paragraph" else F.lit(None).cast("string")
        return df.filter(F.col("doc_index").isNotNull()).select(
            "doc_id", F.col("doc_index").cast("long").alias("doc_index"), F.lit(KINDS[kind]).alias("kind_rank"), order.alias("ord"), F.lit(kind).alias("kind"),
            col(text).alias("text"), style.alias("style"), col(media).alias("media_id"), page.alias("page_number"),
        )

    return part(paragraphs, "paragraph", "text", None).unionByName(part(tables, "table", None, "tid")).unionByName(part(images, "image", None, "rId"))


def order_of(elements: DataFrame):
    return Window.partitionBy("doc_id").orderBy("doc_index", "kind_rank", "ord")


def running_titles(elements: DataFrame, strict: bool = False) -> DataFrame:
    """Adds level (null if no heading) and titles: by level the title in force, null where a shallower one came later."""
    line = order_of(elements)
    so_far = line.rowsBetween(Window.unboundedPreceding, 0)
    e = elements.withColumn("level", F.when(F.col("kind") == "paragraph", heading_level(F.col("style"), F.col("text"), strict))).withColumn("pos", F.row_number().over(line))
    title = F.struct(F.col("pos").alias("pos"), strip(text_or_empty(F.col("text"))).alias("title"))
    e = e.withColumns({f"h{n}": F.last(F.when(F.col("level") == n, title), ignorenulls=True).over(so_far) for n in range(1, LEVELS + 1)})
    valid: list[Column] = []
    for n in range(1, LEVELS + 1):
        above = F.greatest(F.lit(0), *(F.coalesce(F.col(f"h{k}.pos"), F.lit(0)) for k in range(1, n)), *([F.lit(0)] if n == 1 else []))
        valid.append(F.when(F.col(f"h{n}.pos") > above, F.col(f"h{n}.title")))
    return e.withColumn("titles", F.array(*valid)).drop(*(f"h{n}" for n in range(1, LEVELS + 1)))


def with_chunks(elements: DataFrame, strict: bool = False) -> DataFrame:
    """Adds chunk_seq (0 before the first chunk), opens, and the section_path of elements that open a chunk."""
    e = running_titles(elements, strict)
    so_far = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.coalesce(F.col("level") >= 2, F.lit(False))
    body = F.col("level").isNull() & (F.col("kind") == "paragraph")
    e = e.withColumn("n_open", F.sum(opens.cast("int")).over(so_far)).withColumn("n_top", F.sum(F.coalesce((F.col("level") == 1).cast("int"), F.lit(0))).over(so_far))
    early = body & (F.col("n_open") == 0) & (F.col("n_top") > 0)
    e = e.withColumn("n_early", F.sum(early.cast("int")).over(so_far))
    e = e.withColumn("opens", opens | (early & (F.col("n_early") == 1)))
    e = e.withColumn("chunk_seq", F.sum(F.col("opens").cast("int")).over(so_far).cast("int"))
    path = F.filter(F.when(F.col("level").isNull(), F.slice("titles", 1, 1)).otherwise(F.col("titles")), lambda t: t.isNotNull())
    return e.withColumn("section_path", F.when(F.col("opens"), path)).drop("n_open", "n_top", "n_early")


def chunk(elements: DataFrame, stem: Column | str = "doc_id", file_name: Column | str = "doc_id", strict: bool = False) -> DataFrame:
    """One row per chunk: doc_id, chunk_seq, Context, Context_id, media flags and ids, section, page and file."""
    e = with_chunks(elements, strict).filter("chunk_seq > 0")
    part = (
        F.when(F.col("level").isNotNull(), F.lit(None))
        .when(F.col("kind") == "paragraph", F.when(~is_blank(F.col("text")), F.col("text")))
        .when(F.coalesce(F.col("media_id"), F.lit("")) != "", F.concat(F.when(F.col("kind") == "table", F.lit("[Table:")).otherwise(F.lit("[Image:")), "media_id", F.lit("]")))
    )
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(part.isNotNull(), F.struct("pos", part.alias("part"))))), lambda x: x["part"]), "\n\n")
    page = F.min(F.when(F.col("level").isNull(), F.col("page_number")))
    as_col = lambda c: F.col(c).cast("string") if isinstance(c, str) else c
    g = e.groupBy("doc_id", "chunk_seq").agg(body.alias("body"), F.max("section_path").alias("Section_path"), page.alias("Page_number"))
    intro = section_intro(F.col("Section_path"))
    g = g.withColumn("Context", F.concat_ws("\n\n", F.nullif(intro, F.lit("")), F.nullif("body", F.lit(""))))
    images, tables = media_ids(F.col("Context"), "Image"), media_ids(F.col("Context"), "Table")
    return g.select(
        "doc_id", "chunk_seq", "Context", F.format_string("%s::chunk_%04d", as_col(stem), F.col("chunk_seq")).alias("Context_id"),
        (F.size(images) > 0).alias("Is_image"), images.alias("Image_ids"), (F.size(tables) > 0).alias("Is_table"), tables.alias("Table_ids"),
        "Section_path", F.size(F.filter("Section_path", lambda t: t != "")).alias("Section_length"), "Page_number", as_col(file_name).alias("File_name"),
    )
