"""JSON documents, JSON lines, chunk files and file picking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import file_name, file_stem, is_blank, safe_version

METADATA = "struct<id:string,external_id:string,general_info:struct<filename:string,filename_stem:string,filename_versioned:string>>"
JSONL = f"context string, content string, text string, body string, unique_id string, id string, metadata {METADATA}"
CHUNK = (
    "Context string, Context_id string, Is_image boolean, Image_ids array<string>, Is_table boolean, Table_ids array<string>, "
    "Section_path array<string>, Section_length int, Page_number int, File_name string"
)


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file (an array is a row an element), with the file's path as doc_id."""
    return spark.read.option("multiLine", True).schema(schema).json(path).withColumn("doc_id", F.input_file_name())


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], version: str = "") -> DataFrame:
    """content, unique_id and metadata of JSON lines; malformed lines are dropped.

    The id is the first there is of unique_id, id and metadata.id; lines without one are numbered within their file, and
    those alone count.  metadata.general_info gets the file's stem and versioned name.
    """
    rows = spark.read.schema(JSONL).option("mode", "DROPMALFORMED").json(list(paths) if not isinstance(paths, str) else paths)
    numbered = rows.withColumn("path", F.input_file_name()).withColumn("line", F.monotonically_increasing_id())
    return resolve_ids(numbered, version, F.shiftright("line", 33))  # the scan's tasks, which are stretches of a file


def resolve_ids(rows: DataFrame, version: str = "", block: Column | None = None) -> DataFrame:
    """rows (path, line, context, content, unique_id, id, metadata) with ids resolved.

    block: number of the stretch of lines that a line is in, ascending with them; lines are counted by stretch, and the
    few counts of the stretches summed up, so no task has to hold a whole file.
    """
    given = F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in ("unique_id", "id", "metadata.id")))
    stem = file_stem(file_name(F.col("path")))
    versioned = F.concat_ws("_", stem, safe_version(F.lit(version)))
    r = rows.withColumn("given", given).withColumn("stem", stem).withColumn("versioned", versioned).withColumn("block", block if block is not None else F.lit(0))
    r = r.withColumn("lacks", F.col("given").isNull())
    counts = r.filter("lacks").groupBy(F.col("path").alias("of"), F.col("block").alias("of_block")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("of").orderBy("of_block").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("of", "of_block", F.coalesce(before, F.lit(0)).alias("before"))
    r = r.withColumn("here", F.row_number().over(Window.partitionBy("path", "block", "lacks").orderBy("line")))
    r = r.join(counts, F.col("lacks") & (F.col("path") == F.col("of")) & (F.col("block") == F.col("of_block")), "left")
    number = F.coalesce("before", F.lit(0)) + F.col("here")
    uid = F.coalesce("given", F.concat("versioned", F.format_string("_%06d", number)))
    info = F.struct(F.col("metadata.general_info.filename").alias("filename"), F.col("stem").alias("filename_stem"), F.col("versioned").alias("filename_versioned"))
    meta = F.struct(F.col("metadata.id").alias("id"), F.col("metadata.external_id").alias("external_id"), info.alias("general_info"))
    return r.select("path", "line", F.coalesce(F.nullif("context", F.lit("")), "content", F.lit("")).alias("content"), uid.alias("unique_id"), meta.alias("metadata"))


def read_texts(spark: SparkSession, paths: str | Sequence[str], text_field: str = "context", limit: int | None = None) -> DataFrame:
    """text of JSON lines: the first non-empty of text_field, text, context, body; limit is the caller's wish."""
    schema = JSONL if text_field in ("context", "content", "text", "body") else f"{JSONL}, `{text_field}` string"
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(list(paths) if not isinstance(paths, str) else paths)
    out = rows.select(F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in (text_field, "text", "context", "body")), F.lit("")).alias("text"))
    return out if limit is None else out.limit(limit)


def find_chunk_files(spark: SparkSession, base: str) -> list[str]:
    """The enriched chunk files below base, sorted; if there is none at all, the plain ones; an error if neither is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found, files = {"_chunked_with_imgsum.json": [], "_chunked.json": []}, fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        for end, names in found.items():
            if name.endswith(end):
                names.append(name)
    for names in found.values():
        if names:
            return sorted(names)
    raise FileNotFoundError(f"no chunk files below {base}")


def read_chunks(spark: SparkSession, base: str) -> DataFrame:
    """Documents to be indexed: text (Context) and metadata (all else); blank ones are left out."""
    rows = spark.read.option("multiLine", True).schema(CHUNK).json(find_chunk_files(spark, base))
    return chunk_documents(rows)


def chunk_documents(chunks: DataFrame) -> DataFrame:
    rest = [c for c in chunks.columns if c != "Context"]
    return chunks.filter(~is_blank(F.col("Context"))).select(F.col("Context").alias("text"), F.struct(*rest).alias("metadata"))


def newest(files: DataFrame, suffix: str = "_sanitized.json") -> DataFrame:
    """Of files (path, modificationTime), the newest that ends in suffix; of any .json if there is none."""
    ranked = files.filter(F.col("path").endswith(".json")).withColumn("fits", F.col("path").endswith(suffix))
    return ranked.agg(F.max_by("path", F.struct("fits", "modificationTime", "path")).alias("path")).filter("path is not null")


def pick_one(files: DataFrame, hint: str) -> DataFrame:
    """The one file that a hint means: its path, else the only one of that name, else the only one of that stem."""
    name = file_name(F.col("path"))
    rank = F.when(F.col("path") == hint, 1).when(name == hint, 2).when(file_stem(name) == hint, 3)
    ranked = files.withColumn("rank", rank).filter("rank is not null")
    best = ranked.withColumn("best", F.min("rank").over(Window.partitionBy())).filter("rank = best")
    return best.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy())).filter("n = 1").select("path")


def output_name(sanitized: str, kind: str) -> str:
    """The file that a stage writes for a sanitized one: kind is chunked, image_llm or chunked_with_imgsum."""
    stem = sanitized.removesuffix(".json")
    return f"{stem.removesuffix('_sanitized')}_{kind}.json"
