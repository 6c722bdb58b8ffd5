"""Whole documents as JSON: sections with their own blocks, versions, and pretty files for other tools."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sections import own_blocks

IMAGE = "struct<filename:string,doc_index:int,saved_path:string,ocr_text:string,is_in_table:boolean,is_in_paragraph:boolean,preceding_text:string,llm_text:string>"


def payload(sections: DataFrame, blocks: DataFrame, metadata: DataFrame | None = None, version: str = "0.0.0") -> DataFrame:
    """By document: json of version, metadata (if given) and sections with the ids of the blocks that no subsection has.

    sections are section_tree's rows, blocks (doc_id, doc_index, block_id); sections stay flat and name their parents.
    """
    inside = (F.col("b.doc_id") == F.col("s.doc_id")) & (F.col("b.doc_index") >= F.col("s.span_start")) & (F.col("s.span_end").isNull() | (F.col("b.doc_index") < F.col("s.span_end")))
    of = blocks.alias("b").join(sections.alias("s"), inside).select("b.doc_id", F.struct("b.doc_id", "s.section_id").alias("section_id"), "b.doc_index", "b.block_id")
    spans = sections.filter("parent_id is not null").select(F.struct("doc_id", F.col("parent_id").alias("section_id")).alias("parent_id"), "span_start", F.coalesce("span_end", F.lit((1 << 62))).alias("span_end"))
    ids = own_blocks(of, spans).groupBy("doc_id", F.col("section_id.section_id").alias("section_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_index", "block_id"))), lambda x: x["block_id"]).alias("block_ids"))
    s = sections.join(ids, ["doc_id", "section_id"], "left").withColumn("block_ids", F.coalesce("block_ids", F.array().cast("array<string>")))
    s = s.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section_id", "parent_id", "level", "title", "span_start", "span_end", "block_ids"))).alias("sections"))
    if metadata is None:
        return s.select("doc_id", F.to_json(F.struct(F.lit(version).alias("version"), "sections")).alias("json"))
    rest = [c for c in metadata.columns if c != "doc_id"]
    s = s.join(metadata.select("doc_id", F.struct(*rest).alias("metadata")), "doc_id", "left")
    return s.select("doc_id", F.to_json(F.struct(F.lit(version).alias("version"), "metadata", "sections")).alias("json"))


def parse_images(rows: DataFrame, column: str = "json") -> DataFrame:
    """Image records from JSON text; their id may be named rId or rid."""
    # Names of columns don't tell rId from rid; paths in JSON do.
    rid = F.coalesce(F.get_json_object(column, "$.rId"), F.get_json_object(column, "$.rid"))
    i = rows.select("*", F.from_json(column, IMAGE).alias("i"))
    return i.select(*(c for c in rows.columns if c != column), rid.alias("rId"), *(F.col(f"i.{n}") for n in ("filename", "doc_index", "saved_path", "ocr_text", "llm_text")))


def write_pretty(rows: DataFrame, path: str) -> None:
    """The rows of one document as an indented JSON array in one local file, for tools that read such files."""
    with open(path, "w", encoding="utf-8") as f:
        json.dump([json.loads(r) for r in rows.toJSON().toLocalIterator()], f, ensure_ascii=False, indent=2)
