"""Incremental ingest: new files as a stream, parsed, chunked and upserted into a collection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.collection import Collection


def new_files(spark: SparkSession, path: str, pattern: str = "*.docx", max_files: int = 100) -> DataFrame:
    """Files that appear below path, with their bytes; at most max_files a batch."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", max_files).load(path)
    return files.filter(~F.regexp_extract("path", r"([^/]*)$", 1).startswith("~$"))


def distinct_content(files: DataFrame, delay: str = "1 day") -> DataFrame:
    """The first file of each content; content seen longer than delay ago is forgotten, which bounds the state."""
    return files.withColumn("content_sha256", F.sha2("content", 256)).withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["content_sha256"])


def ingest(files: DataFrame, to_points: Callable[[DataFrame], DataFrame], collection: Collection, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Upserts the points of every batch.  A batch that is run again upserts the same keys, so the result is the same."""

    def batch(rows: DataFrame, _: int) -> None:
        collection.upsert(to_points(rows))

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
