"""Command line: parse Word files to chunks, or show what a stored result holds.

    python -m folioforge.cli run INPUT OUTPUT [--captions FILE]
    python -m folioforge.cli run INPUT OUTPUT --one NAME        only the file that NAME means (path, name or stem)
    python -m folioforge.cli index CHUNKS OUTPUT [--name N] [--language L] [--version V] [--file-names A,B]
    python -m folioforge.cli inspect OUTPUT {paragraphs,tables,lists,images,chunks,all,ls} [--json]
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import indexing
from .config import Settings
from .functions.text import file_name, file_stem
from .operators import chunking, images, lists, paragraphs, tables
from .sources import docx, files

COMPONENTS = ("paragraphs", "tables", "lists", "images", "chunks")


def process(docs: DataFrame, captions: DataFrame | None = None) -> dict[str, DataFrame]:
    """All components of parsed documents (docx.read_docx), by name; captions are (doc_id, ord, rId, llm_text)."""
    p = paragraphs.merge_plain(paragraphs.clean_paragraphs(docx.paragraphs(docs)))
    cells = docx.cells(docs)
    found = images.image_context(images.in_tables(docx.images(docs), cells), p)
    t = tables.sanitized_tables(docx.tables(docs), cells, p)
    elements = chunking.union_elements(p, t.select("doc_id", "doc_index", "tid"), found.select("doc_id", "doc_index", "rId", "ord"))
    name = file_name(F.col("doc_id"))
    chunks = chunking.chunk(elements, file_stem(name), name)
    if captions is not None:
        chunks = images.inject(chunks, captions)
    return {"paragraphs": p, "tables": t, "lists": lists.list_components(p), "images": found, "chunks": chunks}


def run(spark: SparkSession, source: str, target: str, captions: str | None = None, one: str | None = None) -> None:
    """Writes every component below target as a table; files that can't be parsed are listed in ``errors``."""
    docs = docx.read_docx(spark, source)
    if one is not None:
        docs = docs.join(files.pick_one(docs.select(F.col("doc_id").alias("path")), one), F.col("doc_id") == F.col("path"), "left_semi")
    docs = docs.persist()
    rows = spark.read.option("multiLine", True).schema("doc_id string, rId string, llm_text string").json(captions) if captions else None
    if rows is not None:
        rows = rows.withColumn("ord", F.monotonically_increasing_id())
    for name, df in process(docs.filter("success"), rows).items():
        df.write.mode("overwrite").parquet(f"{target}/{name}")
    docs.filter("not success").select("doc_id", "error").write.mode("overwrite").parquet(f"{target}/errors")
    docs.unpersist()


def component_counts(parts: Mapping[str, DataFrame]) -> DataFrame:
    """(component, n) of tables by name."""
    return reduce(DataFrame.unionByName, [df.agg(F.lit(name).alias("component"), F.count(F.lit(1)).alias("n")) for name, df in parts.items()])


def stored(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The components that are below target, in any store that Spark reads."""
    path = lambda n: spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{n}")
    return {n: spark.read.parquet(f"{target}/{n}") for n in COMPONENTS if path(n).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(n))}


def inspected(spark: SparkSession, target: str, what: str, as_json: bool = False) -> Iterator[str]:
    """Lines of: which components there are, counts of all, or the count or (as JSON, row by row) the rows of one."""
    parts = stored(spark, target)
    if what == "ls":
        yield from (f"{n}: {'yes' if n in parts else 'no'}" for n in COMPONENTS)
    elif what == "all":
        counts = {r["component"]: r["n"] for r in component_counts(parts).collect()} if parts else {}
        counts = {n: counts[n] for n in parts}
        yield from [json.dumps(counts)] if as_json else (f"{n}: {c}" for n, c in counts.items())
    elif as_json:
        yield from parts[what].toJSON().toLocalIterator()
    else:
        yield str(parts[what].count())


def inspect(spark: SparkSession, target: str, what: str, as_json: bool = False) -> str:
    return "\n".join(inspected(spark, target, what, as_json))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    r = commands.add_parser("run")
    r.add_argument("input")
    r.add_argument("output")
    r.add_argument("--captions")
    r.add_argument("--one")
    x = commands.add_parser("index")
    x.add_argument("chunks")
    x.add_argument("output")
    for option in ("name", "language", "version", "file-names"):
        x.add_argument(f"--{option}")
    i = commands.add_parser("inspect")
    i.add_argument("output")
    i.add_argument("what", choices=(*COMPONENTS, "all", "ls"))
    i.add_argument("--json", action="store_true")
    a = parser.parse_args(argv)
    spark = SparkSession.builder.appName("folioforge").getOrCreate()
    if a.command == "run":
        run(spark, a.input, a.output, a.captions, a.one)
    elif a.command == "index":
        settings = Settings.of_environment(name=a.name, language=a.language, version=a.version, file_names=a.file_names)
        print(indexing.build_index(spark, a.chunks, a.output, settings).path)
    else:
        for line in inspected(spark, a.output, a.what, a.json):
            print(line)


if __name__ == "__main__":
    main()
