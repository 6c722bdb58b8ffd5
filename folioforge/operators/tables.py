"""Table grids: from rows of cells with spans to a full grid, its headers, HTML and header/value pairs.

Cells are rows (doc_id, tid, r, cell_no, text, colspan, vmerge, images, styled).  Tables are laid out once (:mod:`.layout`), one
row per table with its anchors and places as arrays, from which everything else is taken without another shuffle or join; a
grid has one row per (row, column).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bound, html_escape, part_of, split_words, strip, text_or_empty, with_image_tokens
from ..shipping import ship_package
from . import layout

KEY = ("doc_id", "tid")
ROW = (*KEY, "r")
ANCHOR = "struct<r:int,cell_no:{cell_no},c:int,text:string,colspan:int,vmerge:string,rowspan:int,images:array<string>,styled:boolean>"
PLACE = "struct<r:int,c:int,text:string,images:array<string>,styled:boolean,colspan:int,rowspan:int>"


def laid_out(cells: DataFrame, want: tuple[str, ...] = ("anchors", "places"), vmerge_default: str | None = "restart", fill_merged_text: bool = False) -> DataFrame:
    """One row per table: doc_id, tid, n_rows, n_cols, and what is wanted of

    anchors, every cell with its first column and spans, by row and cell.  vmerge_default: what an empty vmerge means
    ("restart", or "continue" as the file format has it).  A vertical span goes on over the rows in which all of the
    cell's columns are continued.

    places, every (r, c), by row and column.  A continued cell keeps its own text, but takes images and style from the cell
    that it continues; with fill_merged_text, its text too.  Places without a cell are blank.  colspan and rowspan are
    null unless a cell that isn't continued begins there.
    """
    ship_package(cells.sparkSession)
    no_images = F.array().cast("array<string>")
    text = F.when(F.coalesce(F.size("images"), F.lit(0)) <= 0, strip(text_or_empty(F.col("text")))).otherwise(with_image_tokens(F.col("text"), F.coalesce("images", no_images)))
    c = cells.select(
        *ROW, "cell_no", text.alias("text"), F.greatest(F.lit(1), F.coalesce("colspan", F.lit(1))).cast("int").alias("colspan"),
        F.when(F.col("vmerge") == "", F.lit(vmerge_default)).otherwise(F.col("vmerge")).cast("string").alias("vmerge"), "images", "styled",
    )
    # The window puts a table's cells together and in order, with no shuffle if they are together already.
    c = c.withColumn("__first", F.row_number().over(Window.partitionBy(*KEY).orderBy("r", "cell_no")) == 1)
    kinds = dict(c.dtypes)
    arrays = {"anchors": ANCHOR.format(cell_no=kinds["cell_no"]), "places": PLACE}
    schema = ", ".join([*(f"{n} {kinds[n]}" for n in KEY), "n_rows int, n_cols int", *(f"{n} array<{arrays[n]}>" for n in arrays if n in want)])

    def run(batches):
        for tables in layout.whole_tables(batches, "__first"):
            yield layout.lay_out(tables, "__first", KEY, want, fill_merged_text)

    return c.mapInArrow(run, schema)


def anchors(cells: DataFrame, vmerge_default: str | None = "restart") -> DataFrame:
    """Every cell's first column and spans, as of laid_out: doc_id, tid, r, cell_no, c, text, colspan, vmerge, rowspan, images, styled, n_rows, n_cols."""
    return laid_out(cells, ("anchors",), vmerge_default).select(*KEY, "n_rows", "n_cols", F.inline("anchors"))


def grid(cells: DataFrame, fill_merged_text: bool = False, vmerge_default: str | None = "restart") -> DataFrame:
    """The places of tables as rows, as of laid_out: doc_id, tid, r, c, text, images, styled, colspan, rowspan, n_rows, n_cols.

    cells may be anchors, too; they are laid out again.
    """
    return laid_out(cells, ("places",), vmerge_default, fill_merged_text).select(*KEY, "n_rows", "n_cols", F.inline("places"))


def regrouped(grid_rows: DataFrame) -> DataFrame:
    """One row per table again, with its places."""
    names = ("r", "c", "text", "images", "styled", "colspan", "rowspan")
    g = grid_rows.groupBy(*KEY).agg(F.max("n_rows").alias("n_rows"), F.max("n_cols").alias("n_cols"), F.array_sort(F.collect_list(F.struct("r", "c", F.struct(*names).alias("of")))).alias("places"))
    return g.withColumn("places", F.transform("places", lambda x: x["of"]))


def _flag(axis: str) -> Column:
    """Whether the first row (axis r) or column (c) is all styled, with no cell of three words or more."""
    return F.forall(F.filter("places", lambda x: x[axis] == 0), lambda x: x["styled"] & (F.size(split_words(x["text"])) < 3))


def with_headers(laid: DataFrame) -> DataFrame:
    """Adds is_rowheader and is_colheader."""
    return laid.withColumns({"is_rowheader": _flag("r"), "is_colheader": _flag("c")})


def headers(grid_rows: DataFrame) -> DataFrame:
    """By table: is_rowheader, is_colheader, n_rows, n_cols."""
    return with_headers(regrouped(grid_rows)).select(*KEY, "is_rowheader", "is_colheader", "n_rows", "n_cols")


def _with_flags(use: Callable[[Column, Column], Column]) -> Column:
    """use(is_rowheader, is_colheader), with both worked out once a table, not at every call of a lambda that uses them."""
    return bound(F.struct(_flag("r").alias("row"), _flag("c").alias("col")), lambda f: use(f["row"], f["col"]))


def _by_row(use: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(0), F.col("n_rows") - 1), use)


def html() -> Column:
    """A laid-out table as HTML, with spans, header cells and shading; continued cells are covered by the one they continue."""
    attribute = lambda name, value: F.when(value > 1, F.concat(F.lit(f' {name}="'), value.cast("string"), F.lit('"'))).otherwise(F.lit(""))

    def cell(x: Column, row: Column, col: Column) -> Column:
        tag = F.when((row & (x["r"] == 0)) | (col & (x["c"] == 0)), F.lit("th")).otherwise(F.lit("td"))
        shade = F.when(x["styled"], F.lit(' style="background-color: #f2f2f2;"')).otherwise(F.lit(""))
        return F.concat(F.lit("    <"), tag, attribute("rowspan", x["rowspan"]), attribute("colspan", x["colspan"]), shade, F.lit(">"), html_escape(x["text"]), F.lit("</"), tag, F.lit(">"))

    def line(r: Column, row: Column, col: Column) -> Column:
        shown = F.filter(part_of(F.col("places"), r * F.col("n_cols"), (r + 1) * F.col("n_cols")), lambda x: x["colspan"].isNotNull())
        return F.array_join(F.concat(F.array(F.lit("  <tr>")), F.transform(shown, lambda x: cell(x, row, col)), F.array(F.lit("  </tr>"))), "\n")

    body = _with_flags(lambda row, col: F.array_join(_by_row(lambda r: line(r, row, col)), "\n"))
    return F.concat(F.lit("<table>\n"), body, F.lit("\n</table>"))


def render_html(anchored: DataFrame, grid_rows: DataFrame) -> DataFrame:
    """By table: table_html, from the rows of its grid, which have the spans; anchored is the DataFrame that they are of."""
    return regrouped(grid_rows).select(*KEY, html().alias("table_html"))


def value_rows(laid: DataFrame) -> DataFrame:
    """Header/value pairs: doc_id, tid, r, entries array<struct<c, header, cell>> for every data row with a value."""

    def entries(texts: Column, row: Column, col: Column, r: Column) -> Column:
        at = lambda i: F.get("places", i)
        start = r * F.col("n_cols")
        header_cell = lambda i: (row & (r == 0)) | (col & (i == start))
        data = F.filter(F.sequence(start, start + F.col("n_cols") - 1), lambda i: at(i)["colspan"].isNotNull() & (F.get(texts, i) != "") & ~header_cell(i))
        some = lambda on, i: F.when(on & (F.get(texts, i) != ""), F.get(texts, i))
        header = lambda i: strip(F.concat_ws(" | ", some(col, start), some(row, i - start)))
        return F.transform(data, lambda i: F.struct((i - start).alias("c"), header(i).alias("header"), F.get(texts, i).alias("cell")))

    stripped = F.transform("places", lambda x: strip(x["text"]))
    rows = _with_flags(lambda row, col: bound(stripped, lambda texts: _by_row(lambda r: F.struct(r.alias("r"), entries(texts, row, col, r).alias("entries")))))
    return laid.select(*KEY, F.inline(F.filter(rows, lambda x: F.size(x["entries"]) > 0)))


def context_rows(anchored: DataFrame, grid_rows: DataFrame) -> DataFrame:
    """value_rows of the tables of a grid's rows; anchored is the DataFrame that they are of."""
    return value_rows(regrouped(grid_rows))


def sanitized_tables(tables: DataFrame, cells: DataFrame, paragraphs: DataFrame, **options) -> DataFrame:
    """One row per table (tables: doc_id, tid, doc_index, has_borders) with its grid, anchors, headers, HTML and the text of the paragraph before it."""
    laid = with_headers(laid_out(cells, vmerge_default=options.get("vmerge_default", "restart"), fill_merged_text=options.get("fill_merged_text", False)))
    place = lambda x: F.struct(*(x[n].alias(n) for n in ("text", "images", "styled")))
    data = _by_row(lambda r: F.transform(part_of(F.col("places"), r * F.col("n_cols"), (r + 1) * F.col("n_cols")), place))
    all_ = F.transform("anchors", lambda x: F.struct(*(x[n].alias(n) for n in ("r", "c", "text", "colspan", "vmerge", "rowspan"))))
    laid = laid.select(*KEY, "is_rowheader", "is_colheader", "n_rows", "n_cols", data.alias("data"), all_.alias("anchors"), html().alias("table_html"))
    return preceding_text(tables.join(laid, list(KEY)), paragraphs).withColumnsRenamed({"n_rows": "rows", "n_cols": "cols"})


def preceding_text(tables: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Adds preceding_text to rows (doc_id, doc_index, ...): the text of the paragraph right before, if it is one."""
    before = paragraphs.filter(F.col("doc_index").isNotNull()).groupBy("doc_id", "doc_index").agg(F.max_by("text", "ord").alias("preceding_text"))
    return tables.join(before.withColumn("doc_index", F.col("doc_index") + 1), ["doc_id", "doc_index"], "left")
