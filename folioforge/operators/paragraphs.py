"""Paragraph clean-up: run coalescing, plain-paragraph merging, and the alignment of two readings of a document.

Paragraphs are rows (doc_id, doc_index, ord, text, style, runs, source_doc_indices, emphasized, math_texts,
image_included); runs is an array of (text, b, i, u, rStyle, sz, color, image_rids).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound, glued, is_blank, join_lines, join_tokens, normalize_run, strip
from ..shipping import ship_package
from .layout import whole_tables

RUN = "struct<text:string,b:boolean,i:boolean,u:boolean,rStyle:string,sz:double,color:string,image_rids:array<string>>"
FORMAT = ("b", "i", "u", "rStyle", "sz", "color")


def coalesce_runs(runs: Column) -> Column:
    """Neighbouring runs of one format as one; empty runs go.  The array stays in its row: no shuffle, and linear work: the
    places where the format changes cut the array into stretches, and each stretch is one run.  Runs are read where they
    are, as every array that is made of them copies them whole."""
    clean = F.filter(F.transform(runs, lambda r: r.withField("text", normalize_run(r["text"]))), lambda r: r["text"] != "")
    no_rids = F.array().cast("array<string>")

    def one(c: Column, begin: Column, end: Column) -> Column:
        each = lambda name: F.transform(F.sequence(begin, end - 1), lambda i: F.get(c, i)[name])
        rids = F.array_distinct(F.flatten(F.transform(each("image_rids"), lambda r: F.coalesce(r, no_rids))))
        first = F.get(c, begin)
        whole = first.withField("text", glued(each("text"), run_rules=True)).withField("image_rids", rids)
        return F.when(end - begin > 1, whole).otherwise(first)

    def cut(c: Column) -> Column:
        same = lambda i: reduce(and_, (F.get(c, i)[f].eqNullSafe(F.get(c, i - 1)[f]) for f in FORMAT))
        changes = F.filter(F.sequence(F.lit(0), F.size(c) - 1), lambda i: (i == 0) | ~same(i))
        return bound(changes, lambda starts: F.transform(starts, lambda i, k: one(c, i, F.coalesce(F.get(starts, k + 1), F.size(c)))))

    return bound(clean, lambda c: F.when(F.size(c) > 0, cut(c)).otherwise(F.array().cast(f"array<{RUN}>")))


def clean_paragraphs(paragraphs: DataFrame) -> DataFrame:
    """Coalesces runs and takes text, emphasized, image_included and source_doc_indices from them; a paragraph without
    runs stays as it is."""
    has = F.size(F.coalesce("runs", F.array().cast(f"array<{RUN}>"))) > 0
    p = paragraphs.withColumn("runs", F.when(has, coalesce_runs(F.col("runs"))).otherwise(F.col("runs"))).withColumn("__has", has)
    text = strip(join_tokens(F.transform("runs", lambda r: r["text"]), run_rules=True))
    bold = F.filter(F.transform(F.filter("runs", lambda r: r["b"]), lambda r: strip(r["text"])), lambda t: t != "")
    image = F.exists("runs", lambda r: F.size(F.coalesce(r["image_rids"], F.array().cast("array<string>"))) > 0)
    on = F.col("__has")
    indices = F.coalesce("source_doc_indices", F.array().cast("array<int>"))
    p = p.withColumns(
        {
            "text": F.when(on, text).otherwise(F.col("text")),
            "emphasized": F.when(on, bold).otherwise(F.col("emphasized")),
            "image_included": F.when(on, image).otherwise(F.col("image_included")),
            "source_doc_indices": F.when(on & (F.size(indices) == 0) & F.col("doc_index").isNotNull(), F.array(F.col("doc_index").cast("int"))).otherwise(indices),
        }
    )
    return p.drop("__has")


def plain(text: Column, style: Column) -> Column:
    return style.isNull() & ~is_blank(text)


def merge_plain(paragraphs: DataFrame, split_at: Column | None = None) -> DataFrame:
    """Neighbouring plain paragraphs as one.  Neighbours in the list of paragraphs: a table between two doesn't part them,
    unless split_at (true on a row that must not join its predecessor) says so."""
    line = Window.partitionBy("doc_id").orderBy("ord")
    p = paragraphs.withColumn("__plain", plain(F.col("text"), F.col("style")))
    breaks = ~F.col("__plain") | ~F.coalesce(F.lag("__plain").over(line), F.lit(False))
    if split_at is not None:
        breaks |= split_at
    p = p.withColumn("island", F.sum(breaks.cast("int")).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    gathered = F.array_sort(F.collect_list(F.struct("ord", "text", "doc_index", "source_doc_indices", "emphasized", "math_texts", "runs")))
    g = p.groupBy("doc_id", "island").agg(
        gathered.alias("all"), F.bool_or(F.coalesce("image_included", F.lit(False))).alias("image_included"), F.min_by("style", "ord").alias("style"), F.min_by("doc_index", "ord").alias("doc_index"), F.min("ord").alias("ord")
    )
    many = F.size("all") > 1
    field = lambda name: F.flatten(F.transform("all", lambda x: F.coalesce(x[name], F.array())))
    sources = F.array_distinct(F.flatten(F.transform("all", lambda x: F.when(F.size(F.coalesce(x["source_doc_indices"], F.array().cast("array<int>"))) > 0, x["source_doc_indices"]).otherwise(F.array(x["doc_index"].cast("int"))))))
    return g.select(
        "doc_id", "ord", "doc_index",
        F.when(many, join_lines(F.transform("all", lambda x: x["text"]))).otherwise(F.get("all", F.lit(0))["text"]).alias("text"),
        "style", F.filter(sources, lambda x: x.isNotNull()).alias("source_doc_indices"),
        F.filter(F.flatten(F.transform("all", lambda x: F.coalesce(x["emphasized"], F.array().cast("array<string>")))), lambda t: ~many | (t != "")).alias("emphasized"),
        F.filter(F.flatten(F.transform("all", lambda x: F.coalesce(x["math_texts"], F.array().cast("array<string>")))), lambda t: ~many | (t != "")).alias("math_texts"),
        F.flatten(F.transform("all", lambda x: F.coalesce(x["runs"], F.array().cast(f"array<{RUN}>")))).alias("runs"), "image_included",
    )


def _squeeze(text: str | None) -> str:
    return "".join((text or "").split()).lower()


def align(left: list[str | None], right: list[str | None]) -> list[int | None]:
    """For each right text the left one it is matched with, in order: matches never cross.

    Two texts match if, without white space and case, one contains the other, or if the left one has an image token.  A
    right text looks from behind the last match up to the first left text that matches, or that a right text further
    on equals (its last occurrence tells that), as that one is not to be passed over; left texts passed over are gone.
    """
    sought, offered = [_squeeze(t) for t in right], [_squeeze(t) for t in left]
    wildcard = ["[image:" in (t or "") for t in left]
    last = {key: j for j, key in enumerate(sought)}
    hits: list[int | None] = [None] * len(sought)
    begin = 0
    for j, key in enumerate(sought):
        if not key:
            continue
        match = lambda i: wildcard[i] or offered[i] in key or key in offered[i]  # noqa: B023, E731
        stop = next((i for i in range(begin, len(offered)) if offered[i] and (match(i) or last.get(offered[i], -1) > j)), None)
        if stop is not None and match(stop):
            hits[j] = stop
        begin = len(offered) if stop is None else stop + (hits[j] is not None)
    return hits


def merge_sources(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of second (doc_id, ord, doc_index, text) with the ord and text of the row of first that each is matched with.

    Greedy matching in order is a walk over a document, so Python does it; documents come to it in batches of many, put
    together by a window with one shuffle of both readings.
    """
    ship_package(first.sparkSession)
    kind = dict(second.dtypes)["doc_id"]
    side = lambda df, n, index: df.select("doc_id", F.lit(n).alias("side"), F.col("ord").cast("bigint").alias("ord"), index.cast("bigint").alias("doc_index"), "text")
    both = side(first, 0, F.lit(None)).unionByName(side(second, 1, F.col("doc_index")))
    both = both.withColumn("first", F.row_number().over(Window.partitionBy("doc_id").orderBy("side", "ord")) == 1)
    schema = f"doc_id {kind}, ord bigint, doc_index bigint, text string, matched_ord bigint, matched_text string"
    return both.mapInArrow(_matched, schema)


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in whole_tables(batches, "first"):
        begins = [i for i, b in enumerate(t["first"].to_pylist()) if b]
        sides, texts = t["side"].to_pylist(), t["text"].to_pylist()
        rows: list[int] = []
        matched: list[int | None] = []
        for lo, hi in zip(begins, [*begins[1:], len(t)]):
            middle = next((i for i in range(lo, hi) if sides[i]), hi)
            rows += range(middle, hi)
            matched += [None if h is None else lo + h for h in align(texts[lo:middle], texts[middle:hi])]
        own, other = t.select(["doc_id", "ord", "doc_index", "text"]).take(pa.array(rows, pa.int64())), t.select(["ord", "text"]).take(pa.array(matched, pa.int64()))
        out = pa.table([*own.columns, *other.columns], names=["doc_id", "ord", "doc_index", "text", "matched_ord", "matched_text"])
        yield from out.combine_chunks().to_batches()
