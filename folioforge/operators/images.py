"""Images: their place and context, the cache of read texts, captions, and media file names."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import inject_captions, is_blank, normalize_caption, strip, suffix


def image_places(images: DataFrame, uses: DataFrame) -> DataFrame:
    """images (doc_id, rId, ...) with doc_index (the first use in document order) and doc_indices from uses (doc_id, rId, ord, doc_index)."""
    at = uses.groupBy("doc_id", "rId").agg(F.min_by("doc_index", "ord").alias("doc_index"), F.array_sort(F.collect_set("doc_index")).alias("doc_indices"))
    return images.join(at, ["doc_id", "rId"], "left").withColumn("doc_indices", F.coalesce("doc_indices", F.array().cast("array<bigint>")))


def in_tables(images: DataFrame, cells: DataFrame) -> DataFrame:
    """Adds is_in_table: whether a cell (doc_id, images) of the document has the image."""
    there = cells.select("doc_id", F.explode("images").alias("rId")).distinct().withColumn("is_in_table", F.lit(True))
    return images.join(there, ["doc_id", "rId"], "left").withColumn("is_in_table", F.coalesce("is_in_table", F.lit(False)))


def image_context(images: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Adds is_in_paragraph and preceding_text to images (doc_id, rId, doc_index): the text of the image's own paragraph if
    that has its token, else that of the paragraph right before."""
    last = paragraphs.filter(F.col("doc_index").isNotNull() & (F.coalesce("text", F.lit("")) != "")).groupBy("doc_id", "doc_index").agg(F.max_by("text", "ord").alias("own_text"))
    out = images.join(last, ["doc_id", "doc_index"], "left")
    out = out.join(last.select("doc_id", (F.col("doc_index") + 1).alias("doc_index"), F.col("own_text").alias("text_before")), ["doc_id", "doc_index"], "left")
    own = F.coalesce(F.position(F.concat(F.lit("[image:"), "rId", F.lit("]")), F.col("own_text")) > 0, F.lit(False))
    return out.withColumn("is_in_paragraph", own).withColumn("preceding_text", F.when(own, F.col("own_text")).otherwise(F.col("text_before"))).drop("own_text", "text_before")


def uncached(images: DataFrame, cache: DataFrame) -> DataFrame:
    """The images (content_sha256, ...) that the cache (content_sha256, ...) has no entry for: those still to be read."""
    return images.join(cache.select("content_sha256").distinct(), "content_sha256", "left_anti")


def with_cached(images: DataFrame, cache: DataFrame) -> DataFrame:
    """images with ocr_text and llm_text from the cache, by content hash."""
    return images.join(cache.select("content_sha256", "ocr_text", "llm_text").dropDuplicates(["content_sha256"]), "content_sha256", "left")


def read_images(images: DataFrame, model: Callable[[], Callable[[bytes], str | None]], out: str = "ocr_text") -> DataFrame:
    """Applies a model to the PNG images (content BINARY): model() is called once a task and gives the function of the
    bytes; other images, and those on which it fails, get null.  The content column is replaced by the text."""
    rest = [f for f in images.schema.fields if f.name not in ("content", out)]

    def run(batches: Iterator) -> Iterator:
        call = None
        for pdf in batches:
            texts = []
            for name, data in zip(pdf["filename"], pdf["content"], strict=True):
                text = None
                if data is not None and str(name or "").lower().endswith(".png"):
                    try:
                        call = call or model()
                        text = call(bytes(data))
                    except Exception:  # one unreadable image is no reason to fail  # noqa: BLE001
                        text = None
                texts.append(text)
            yield pdf[[f.name for f in rest]].assign(**{out: texts})

    from pyspark.sql import types as T

    return images.mapInPandas(run, T.StructType([*rest, T.StructField(out, T.StringType())]))


def png_only(images: DataFrame) -> DataFrame:
    name = F.coalesce(F.nullif("filename", F.lit("")), F.regexp_extract("saved_path", r"([^/]*)$", 1))
    return images.filter(suffix(name) == ".png")


def caption_map(summaries: DataFrame) -> DataFrame:
    """By document: captions, a map from lower-case image id to text, of summaries (doc_id, ord, rId, llm_text); the last of an id counts."""
    s = summaries.filter(F.col("rId").isNotNull() & (F.col("rId") != "") & ~is_blank(F.col("llm_text")))
    s = s.groupBy("doc_id", F.lower(strip(F.col("rId"))).alias("rid")).agg(F.max_by(strip(F.col("llm_text")), "ord").alias("text"))
    return s.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("rid", "text")))).alias("captions"))


def inject(chunks: DataFrame, summaries: DataFrame) -> DataFrame:
    """chunks (doc_id, Context, ...) with captions after their image markers; nothing else changes."""
    out = chunks.join(caption_map(summaries), "doc_id", "left")
    return out.withColumn("Context", F.when(F.col("captions").isNull(), F.col("Context")).otherwise(inject_captions(F.col("Context"), F.col("captions")))).drop("captions").select(*chunks.columns)


def described(summaries: DataFrame) -> DataFrame:
    """llm_text of raw captions: "image description: ..." without lead-ins, null if nothing is left."""
    text = normalize_caption(F.col("llm_text"))
    return summaries.withColumn("llm_text", F.when(F.coalesce(text, F.lit("")) != "", F.concat(F.lit("image description: "), text)))


def media_names(images: DataFrame) -> DataFrame:
    """Adds media_name: the file name, from its second use in a document on with _1, _2, ... before the suffix."""
    n = F.row_number().over(Window.partitionBy("doc_id", "filename").orderBy("ord")) - 1
    stem, ext = F.regexp_extract("filename", r"^(.+?)(\.[^.]*)?$", 1), F.regexp_extract("filename", r"^(.+?)(\.[^.]*)?$", 2)
    return images.withColumn("media_name", F.when(n == 0, F.col("filename")).otherwise(F.concat(stem, F.lit("_"), n.cast("string"), ext)))


def sample_images(images: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n random images; a sample is what is asked for here."""
    return images.orderBy(F.rand(seed)).limit(n)
