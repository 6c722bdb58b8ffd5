"""What the operators of this subpackage share: scratch tables in the shared folder, key filters, components."""

from __future__ import annotations

import contextlib
import json
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship_package  # noqa: F401  for the operators

#: A word: a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: A side is broadcast explicitly only if its rows, counted, stay within this many bytes.
BROADCAST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.  Where it is unset, a session in one process (as in
    tests) gets a folder of its own; on a cluster that is an error, as no local folder would be shared."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="folioforge-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs the reading of files, not a recomputation."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def table(self, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """The final rows, as a checkpoint; drops the scratch tables.  The checkpoint's files stay until the shared folder is
        emptied, or, with spark.cleaner.referenceTracking.cleanCheckpoints, until nothing refers to the rows any more."""
        kept = df.checkpoint()
        self.drop()
        return kept

    def drop(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most so many rows for what is written meanwhile: a batch is whole in the JVM's buffers, which double, and in
    the Python worker's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows if before is None or int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def literal_array(values: Sequence, kind: str) -> Column:
    """A constant array column; parsed from JSON, so that its length doesn't blow up generated code."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Marks a table for broadcast if its counted rows stay within BROADCAST_BYTES; else Spark shuffles both sides."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Null-safe equality of columns of the same names."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def words(text: Column) -> Column:
    """The words of a text; null or blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unused(docs: DataFrame, name: str) -> str:
    """The name, longer by underscores until the rows have no such column."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_columns(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra ones can't clash; missing ones are null."""
    kinds = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string"}
    return docs.select(*(F.col(f"`{n}`").cast(kinds[n]).alias(n) if n in docs.columns else F.lit(None).cast(kinds[n]).alias(n) for n in names))


def drop_rows(docs: DataFrame, decisions: DataFrame, kept: Column) -> DataFrame:
    """docs without the rows that ``decisions`` (doc_id, text_hash = xxhash64 of the text, ...) don't keep.

    Rows that repeat another's doc_id and text count as one document: one of them stays if it is kept.
    Only the keys of dropped rows travel; texts don't.
    """
    keyed = decisions.groupBy("doc_id", "text_hash").agg(F.max(kept).alias("kept"), F.count(F.lit(1)).alias("n"))
    gone = keyed.filter(~F.col("kept")).select("doc_id", "text_hash")
    again = keyed.filter(F.col("kept") & (F.col("n") > 1)).select("doc_id", "text_hash")
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    on = lambda t: docs["doc_id"].eqNullSafe(t["doc_id"]) & (key == t["text_hash"])
    gone = small(gone, 48)
    out = docs.join(gone, on(gone), "left_anti")
    if again.isEmpty():
        return out
    again = small(again, 48)
    on = lambda t: out["doc_id"].eqNullSafe(t["doc_id"]) & (F.xxhash64(F.coalesce(out["text"], F.lit(""))) == t["text_hash"])
    return out.join(again, on(again), "left_anti").unionByName(out.join(again, on(again), "left_semi").dropDuplicates(["doc_id", "text"]))


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the smallest node of its component.

    Alternating large-star and small-star steps (Kiveris et al., SoCC 2014): every step is one pre-aggregated
    minimum and one join, so no node's neighbours meet in one row, and the number of rounds is logarithmic.
    Each round's edges are a table in the shared folder.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        # e: rows (u, v) with v < u
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        # Written, so that both sides of the join are shuffled: a node of many neighbours is then split at run time.
        least = scratch.table(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        moved = both.join(least, "u")
        if large:
            moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        return moved.filter("u > v").distinct()

    now = scratch.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    print_of = lambda e: e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = print_of(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        now = scratch.table(star(star(now, True), False))
        after = print_of(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
