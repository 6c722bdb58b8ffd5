"""The queries on the document operators over the shared tables, each with DuckDB SQL where SQL can express it.

The tables have no Word documents in them, so elements are derived by rule: a line of a document is a paragraph, whose
style and number come from a hash of its place (:func:`lines`); a conversation is a document, whose turns are elements;
an order is a table, whose line items are rows.  They run over whole tables and whole texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import cli
from ..functions import models
from ..functions import text as T
from ..operators import bm25, chunking, collection, images, lists, paragraphs, sections, tables, vectors
from ..sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ---- derived inputs, in both languages ------------------------------------------------------------------------------

#: Styles of lines by (31 * doc_id + line) % 13; other lines have none.
STYLES = {0: "Heading 1", 1: " heading 2", 2: "List Bullet", 3: "List Bullet", 4: "List Number", 7: "소제목2", 8: "List Number", 9: "List Bullet"}
#: What such lines begin with.
PREFIXES = {0: "Chapter 3 ", 5: "1.2 ", 6: "chapter 12 ", 10: "4.3.2.1.0 ", 11: "7 "}

LINES = f"""
raw_lines AS (SELECT doc_id, unnest(range(len(l))) AS doc_index, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
coded AS (SELECT doc_id, doc_index, line, (31 * doc_id + doc_index) % 13 AS k FROM raw_lines),
lines AS (SELECT doc_id, doc_index, k,
  CASE k {' '.join(f"WHEN {k} THEN '{v}'" for k, v in PREFIXES.items())} ELSE '' END || line AS text,
  CASE k {' '.join(f"WHEN {k} THEN '{v}'" for k, v in STYLES.items())} END AS style FROM coded)
"""
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_LEVEL = r"""CASE WHEN contains(lower(coalesce(style, '')), 'heading 1') THEN 1 WHEN contains(lower(coalesce(style, '')), 'heading 2') THEN 2
  WHEN contains(coalesce(style, ''), '소제목2') THEN 4 WHEN regexp_matches(TXT, '^(?i:chapter)\s+\d+\b') THEN 1
  WHEN regexp_matches(TXT, '^\d+(\.\d+)*\s') THEN least(4, len(string_split(regexp_extract(TXT, '^(\d+(\.\d+)*)\s', 1), '.'))) END""".replace("TXT", _STRIP.format("text"))
_CLEAN = r"regexp_replace(regexp_replace({}, '^(?i:chapter)\s+\d+\s+', ''), '^\d+(\.\d+)*\s+', '')"


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, doc_index, ord, text, style of the lines of documents, marked by rule."""
    docs = table(spark, folder, "documents").filter("text is not null")
    raw = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("doc_index", "line"))
    k = F.pmod(F.col("doc_id") * 31 + F.col("doc_index"), F.lit(13))
    pick = lambda values: F.coalesce(*(F.when(k == i, F.lit(v)) for i, v in values.items()))
    return raw.select("doc_id", F.col("doc_index").cast("long").alias("doc_index"), F.col("doc_index").cast("long").alias("ord"), F.concat(T.text_or_empty(pick(PREFIXES)), "line").alias("text"), pick(STYLES).alias("style"))


#: Roles of conversations as styles.
ROLES = {"system": "heading 1", "user": "heading 2"}
TURNS = """
turns AS (SELECT conv_id AS doc_id, turn AS doc_index, text, CASE role WHEN 'system' THEN 'heading 1' WHEN 'user' THEN 'heading 2' END AS style,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos FROM conversations)
"""


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as paragraphs."""
    c = table(spark, folder, "conversations")
    style = F.coalesce(*(F.when(F.col("role") == role, F.lit(style)) for role, style in ROLES.items()))
    none = lambda name: F.lit(None).cast("string").alias(name)
    p = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("doc_index"), "text", style.alias("style"), F.lit(0).alias("ord"))
    return chunking.union_elements(p, p.limit(0).select("doc_id", "doc_index", none("tid")), p.limit(0).select("doc_id", "doc_index", none("rId")))


CELLS = """
items AS (SELECT l_orderkey AS doc_id, 't' AS tid, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) - 1 AS r,
  l_partkey, CAST(l_quantity AS BIGINT) AS q, l_returnflag, l_linestatus FROM lineitem),
cells AS (
  SELECT doc_id, tid, r, 0 AS cell_no, l_returnflag AS text, 1 AS colspan, CAST(NULL AS VARCHAR) AS vmerge, r = 0 OR l_partkey % 2 = 0 AS styled FROM items
  UNION ALL SELECT doc_id, tid, r, 1, 'q' || q, 1 + l_partkey % 2, CASE q % 3 WHEN 0 THEN 'restart' WHEN 1 THEN 'continue' END, r = 0 FROM items
  UNION ALL SELECT doc_id, tid, r, 2, CASE WHEN l_partkey % 5 = 0 THEN 'a b <' || l_linestatus || '>' ELSE 'p' || l_partkey END, 1, NULL, r = 0 FROM items),
placed AS (SELECT *, CAST(coalesce(sum(colspan) OVER (PARTITION BY doc_id, r ORDER BY cell_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS c FROM cells),
sized AS (SELECT *, max(r) OVER (PARTITION BY doc_id) + 1 AS nr, max(c + colspan) OVER (PARTITION BY doc_id) AS nc FROM placed),
own AS (SELECT doc_id, r, unnest(range(c, c + colspan)) AS col, text, styled, vmerge, c, colspan FROM sized),
every AS (SELECT doc_id, nr, nc, r, unnest(range(nc)) AS col FROM (SELECT doc_id, nr, nc, unnest(range(nr)) AS r FROM (SELECT DISTINCT doc_id, nr, nc FROM sized))),
ends AS (SELECT e.doc_id, e.nr, e.r, e.col, coalesce(min(CASE WHEN coalesce(o.vmerge, '') <> 'continue' THEN e.r END) OVER (PARTITION BY e.doc_id, e.col ORDER BY e.r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), e.nr) AS stop
  FROM every e LEFT JOIN own o USING (doc_id, r, col)),
anchors AS (SELECT s.doc_id, s.r, s.cell_no, s.c, s.text, s.colspan, s.vmerge, s.styled, s.nr, s.nc, CASE WHEN s.vmerge = 'restart' THEN x.stop - s.r ELSE 1 END AS rowspan
  FROM sized s JOIN (SELECT o.doc_id, o.r, o.c, min(n.stop) AS stop FROM own o JOIN ends n USING (doc_id, r, col) GROUP BY ALL) x USING (doc_id, r, c)),
below AS (SELECT doc_id, r AS from_r, unnest(range(r + 1, r + rowspan)) AS r, c, colspan, text, styled FROM anchors WHERE rowspan > 1),
cover AS (SELECT doc_id, r, col, arg_max(text, from_r) AS text, arg_max(styled, from_r) AS styled FROM (SELECT *, unnest(range(c, c + colspan)) AS col FROM below) GROUP BY ALL),
grid AS (SELECT e.doc_id, e.r, e.col, e.nr, e.nc, coalesce(o.text, v.text, '') AS text, coalesce(v.styled, o.styled, false) AS styled
  FROM every e LEFT JOIN own o USING (doc_id, r, col) LEFT JOIN cover v ON v.doc_id = e.doc_id AND v.r = e.r AND v.col = e.col)
"""


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as tables: three cells a line item, the second wide for odd parts and merged by quantity."""
    # Renamed first, so that rows stay together by doc_id after this window, with no shuffle of the cells.
    items = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "doc_id")
    order = Window.partitionBy("doc_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    q, part = F.col("l_quantity").cast("long"), F.col("l_partkey")
    none = F.lit(None).cast("string")
    r = (F.row_number().over(order) - 1).alias("r")

    def cell(no: int, text, span, merge, styled):
        return F.struct(F.lit(no).alias("cell_no"), text.alias("text"), span.cast("int").alias("colspan"), merge.alias("vmerge"), styled.alias("styled"))

    # r is a window, so cells that use it are made in a second step.
    i = items.select("doc_id", r, part.alias("part"), q.alias("q"), "l_returnflag", "l_linestatus")
    part, q = F.col("part"), F.col("q")
    three = F.array(
        cell(0, F.col("l_returnflag"), F.lit(1), none, (F.col("r") == 0) | (part % 2 == 0)),
        cell(1, F.concat(F.lit("q"), q), 1 + part % 2, F.when(q % 3 == 0, "restart").when(q % 3 == 1, "continue"), F.col("r") == 0),
        cell(2, F.when(part % 5 == 0, F.concat(F.lit("a b <"), "l_linestatus", F.lit(">"))).otherwise(F.concat(F.lit("p"), part)), F.lit(1), none, F.col("r") == 0),
    )
    return i.select("doc_id", F.lit("t").alias("tid"), "r", F.inline(three)).withColumn("images", F.array().cast("array<string>"))


# ---- headings and chunks --------------------------------------------------------------------------------------------


@query(f"WITH {LINES} SELECT doc_id, doc_index, CAST({_LEVEL} AS INTEGER) AS level FROM lines")
def heading_level(spark, folder):
    return lines(spark, folder).select("doc_id", "doc_index", T.heading_level(F.col("style"), F.col("text")).alias("level"))


@query(f"WITH {LINES} SELECT doc_id, doc_index, {_STRIP.format(_CLEAN.format(_STRIP.format('text')))} AS title FROM lines")
def heading_clean(spark, folder):
    return lines(spark, folder).select("doc_id", "doc_index", T.clean_heading(F.col("text")).alias("title"))


_INTRO = """CASE len(t) WHEN 0 THEN '' WHEN 1 THEN 'This content is about the section ' || t[1] || '.'
 WHEN 2 THEN 'This content is about the section ' || t[1] || ', and more specifically it belongs to ' || t[2] || '.'
 WHEN 3 THEN 'This content is about the section ' || t[1] || ', and more specifically it belongs to ' || t[2] || ', focusing on ' || t[3] || '.'
 ELSE 'This content is about the section ' || t[1] || ', and more specifically it belongs to ' || t[2] || ', under the subsection ' || t[3] || ', with a detailed reference to ' || t[4] || '.' END"""


@query(
    f"""WITH p AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '')[1:(doc_id % 6)] AS path FROM documents WHERE text IS NOT NULL),
    q AS (SELECT doc_id, list_transform(path, lambda x: {_STRIP.format(_CLEAN.format(_STRIP.format('x')))}) AS t FROM p) SELECT doc_id, {_INTRO} AS intro FROM q"""
)
def section_intro(spark, folder):
    docs = table(spark, folder, "documents").filter("text is not null")
    path = F.slice(F.filter(F.split("text", "\n"), lambda x: x != ""), F.lit(1), F.pmod("doc_id", F.lit(6)).cast("int"))
    return docs.select("doc_id", T.section_intro(path).alias("intro"))


_RUNNING = (
    TURNS
    + f""", leveled AS (SELECT *, CAST({_LEVEL} AS INTEGER) AS level, {_STRIP.format('text')} AS title FROM turns),
h AS (SELECT *, """
    + ", ".join(
        f"last_value(CASE WHEN level = {n} THEN pos END IGNORE NULLS) OVER w AS p{n}, last_value(CASE WHEN level = {n} THEN title END IGNORE NULLS) OVER w AS t{n}" for n in range(1, 5)
    )
    + """ FROM leveled WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
titled AS (SELECT *, [CASE WHEN p1 > 0 THEN t1 END, CASE WHEN p2 > coalesce(p1, 0) THEN t2 END, CASE WHEN p3 > greatest(coalesce(p1, 0), coalesce(p2, 0)) THEN t3 END,
  CASE WHEN p4 > greatest(coalesce(p1, 0), coalesce(p2, 0), coalesce(p3, 0)) THEN t4 END] AS titles FROM h),
flags AS (SELECT *, coalesce(level >= 2, false) AS opens0, sum(CASE WHEN level >= 2 THEN 1 ELSE 0 END) OVER w AS n_open, sum(CASE WHEN level = 1 THEN 1 ELSE 0 END) OVER w AS n_top FROM titled
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
early AS (SELECT *, level IS NULL AND n_open = 0 AND n_top > 0 AS e FROM flags),
opened AS (SELECT *, opens0 OR (e AND sum(CASE WHEN e THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 1) AS opens FROM early),
seq AS (SELECT *, CAST(sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS chunk_seq FROM opened)"""
)


@query(f"WITH {_RUNNING} SELECT doc_id, doc_index, array_to_string(list_filter(titles, lambda x: x IS NOT NULL), ' > ') AS path FROM seq")
def section_path_state(spark, folder):
    return chunking.running_titles(turns(spark, folder)).select("doc_id", "doc_index", F.array_join("titles", " > ").alias("path"))


@query(f"WITH {_RUNNING} SELECT doc_id, doc_index, opens, chunk_seq FROM seq")
def chunk_boundaries(spark, folder):
    return chunking.with_chunks(turns(spark, folder)).select("doc_id", "doc_index", "opens", "chunk_seq")


@query(
    f"""WITH {_RUNNING},
    g AS (SELECT doc_id, chunk_seq, coalesce(string_agg(CASE WHEN level IS NULL AND {_STRIP.format('text')} <> '' THEN text END, chr(10) || chr(10) ORDER BY pos), '') AS body,
      max(CASE WHEN opens THEN list_filter(CASE WHEN level IS NULL THEN titles[1:1] ELSE titles END, lambda x: x IS NOT NULL) END) AS path FROM seq WHERE chunk_seq > 0 GROUP BY ALL),
    i AS (SELECT *, list_transform(list_filter(path, lambda x: x <> ''), lambda x: {_STRIP.format(_CLEAN.format('x'))}) AS t FROM g)
    SELECT doc_id, chunk_seq, doc_id || '::chunk_' || lpad(CAST(chunk_seq AS VARCHAR), 4, '0') AS context_id, len(t) AS section_length, array_to_string(path, ' > ') AS section_path,
      concat_ws(chr(10) || chr(10), nullif({_INTRO}, ''), nullif(body, '')) AS context FROM i"""
)
def chunk_documents(spark, folder):
    c = chunking.chunk(turns(spark, folder))
    return c.select("doc_id", "chunk_seq", F.col("Context_id").alias("context_id"), F.col("Section_length").cast("long").alias("section_length"), F.array_join("Section_path", " > ").alias("section_path"), F.col("Context").alias("context"))


@query(
    r"""WITH m AS (SELECT conv_id, turn, text || ' [Image:r' || turn % 3 || '] [image:x] [Table:t' || conv_id % 4 || '] [Image:r' || conv_id % 3 || ']' AS t FROM conversations)
    SELECT conv_id, turn, 'r' || turn % 3 || CASE WHEN turn % 3 = conv_id % 3 THEN '' ELSE ',r' || conv_id % 3 END AS image_ids, array_to_string(regexp_extract_all(t, '\[Table:([^\]]+)\]', 1), ',') AS table_ids FROM m"""
)
def media_id_extract(spark, folder):
    c = table(spark, folder, "conversations")
    mod = lambda name, n: F.pmod(name, F.lit(n)).cast("string")
    t = F.concat("text", F.lit(" [Image:r"), mod("turn", 3), F.lit("] [image:x] [Table:t"), mod("conv_id", 4), F.lit("] [Image:r"), mod("conv_id", 3), F.lit("]"))
    return c.select("conv_id", "turn", F.array_join(T.media_ids(t, "Image"), ",").alias("image_ids"), F.array_join(T.media_ids(t, "Table"), ",").alias("table_ids"))


@query(
    """WITH u AS (SELECT doc_id % 50 AS doc_id, doc_id // 50 AS doc_index, 0 AS kind_rank, 'paragraph' AS kind, doc_id AS ord FROM documents
      UNION ALL SELECT page_id % 50, page_id // 50, 1, 'table', page_id FROM pages UNION ALL SELECT item_id % 50, item_id // 50, 2, 'image', item_id FROM benchmark)
    SELECT doc_id, doc_index, kind, ord, row_number() OVER (PARTITION BY doc_id ORDER BY doc_index, kind_rank, ord) AS pos FROM u"""
)
def element_union_sort(spark, folder):
    part = lambda name, key: table(spark, folder, name).select(F.pmod(key, F.lit(50)).alias("doc_id"), F.floor(F.col(key) / 50).alias("doc_index"), F.col(key).alias("ord"), F.col(key).cast("string").alias("media"))
    p = part("documents", "doc_id").withColumns({"text": F.col("media"), "style": F.lit(None).cast("string")})
    e = chunking.union_elements(p, part("pages", "page_id").withColumnRenamed("media", "tid"), part("benchmark", "item_id").withColumnRenamed("media", "rId"))
    return e.select("doc_id", "doc_index", "kind", "ord", F.row_number().over(chunking.order_of(e)).cast("long").alias("pos"))


# ---- tokens and paragraphs ------------------------------------------------------------------------------------------

_WORDS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"


def _closely(run_rules: bool) -> str:
    before = ".,;:!?)]}%" if run_rules else ".,;:!?)]}%'"
    after = "([{/'\""
    quote = lambda s: s.replace("'", "''")
    rule = (
        f"contains('{quote(after)}', right(a, 1)) OR contains('{quote(before)}', left(b, 1)) OR (regexp_matches(a, '\\p{{Nd}}$') AND (regexp_matches(b, '^\\p{{Nd}}') OR contains('%)]', left(b, 1))))"
        " OR (contains('.-/', right(a, 1)) AND regexp_matches(b, '^\\p{Nd}')) OR (right(a, 1) = '-' AND regexp_matches(b, '^\\p{L}'))"
    )
    rule += "" if run_rules else " OR (regexp_matches(a, '\\p{L}$') AND regexp_matches(b, '^\\p{Nd}'))"
    return f"lambda a, b: CASE WHEN {rule} THEN a || b ELSE a || ' ' || b END"


@query(f"WITH {LINES}, w AS (SELECT doc_id, doc_index, {_WORDS} AS w FROM lines) SELECT doc_id, doc_index, CASE WHEN len(w) = 0 THEN '' ELSE list_reduce(w, {_closely(False)}) END AS joined FROM w")
def token_concat(spark, folder):
    return lines(spark, folder).select("doc_id", "doc_index", T.join_tokens(T.split_words(F.col("text")), clean=True).alias("joined"))


@query(
    f"""WITH {LINES}, w AS (SELECT doc_id, doc_index, {_WORDS} AS w FROM lines),
    e AS (SELECT doc_id, doc_index, unnest(w) AS word, unnest(range(len(w))) AS i FROM w),
    s AS (SELECT *, length(word) % 2 AS b, CASE WHEN length(word) % 2 IS DISTINCT FROM lag(length(word) % 2) OVER (PARTITION BY doc_id, doc_index ORDER BY i) THEN 1 ELSE 0 END AS f FROM e),
    g AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, doc_index ORDER BY i) AS island FROM s),
    r AS (SELECT doc_id, doc_index, island, b, list_reduce(list(word ORDER BY i), {_closely(True)}) AS t FROM g GROUP BY ALL)
    SELECT doc_id, doc_index, count(*) AS n_runs, string_agg(t || '/' || b, '|' ORDER BY island) AS runs FROM r GROUP BY ALL"""
)
def run_merge(spark, folder):
    none = lambda kind: F.lit(None).cast(kind)
    off = F.lit(False)
    run = lambda w: F.struct(
        w.alias("text"), (F.char_length(w) % 2 == 1).alias("b"), off.alias("i"), off.alias("u"), none("string").alias("rStyle"), none("double").alias("sz"), none("string").alias("color"), F.array().cast("array<string>").alias("image_rids")
    )
    # Lines without runs are told by their text: a filter on the runs would be pushed below them and work them out twice.
    some = lines(spark, folder).filter(~T.is_blank(F.replace(F.col("text"), F.lit("\u200b"), F.lit(""))))
    r = some.select("doc_id", "doc_index", paragraphs.coalesce_runs(F.transform(T.split_words(F.col("text")), run)).alias("r"))
    shown = F.transform("r", lambda x: F.concat(x["text"], F.lit("/"), x["b"].cast("int").cast("string")))
    return r.select("doc_id", "doc_index", F.size("r").cast("long").alias("n_runs"), F.array_join(shown, "|").alias("runs"))


def _paragraphs(spark, folder) -> DataFrame:
    strings = F.array().cast("array<string>")
    return lines(spark, folder).select(
        "*", F.array().cast(f"array<{paragraphs.RUN}>").alias("runs"), F.array(F.col("doc_index").cast("int")).alias("source_doc_indices"), strings.alias("emphasized"), strings.alias("math_texts"), F.lit(False).alias("image_included")
    )


@query(
    f"""WITH {LINES}, p AS (SELECT *, style IS NULL AND {_STRIP.format('text')} <> '' AS plain FROM lines),
    b AS (SELECT *, sum(CASE WHEN plain AND coalesce(lag_plain, false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY doc_index) AS island
      FROM (SELECT *, lag(plain) OVER (PARTITION BY doc_id ORDER BY doc_index) AS lag_plain FROM p))
    SELECT doc_id, min(doc_index) AS doc_index, CASE WHEN count(*) = 1 THEN any_value(text) ELSE string_agg({_STRIP.format('text')}, chr(10) ORDER BY doc_index) END AS text,
      any_value(style) AS style, string_agg(CAST(doc_index AS VARCHAR), ',' ORDER BY doc_index) AS sources FROM b GROUP BY doc_id, island"""
)
def plain_merge(spark, folder):
    m = paragraphs.merge_plain(_paragraphs(spark, folder))
    return m.select("doc_id", "doc_index", "text", "style", F.array_join(F.transform("source_doc_indices", lambda i: i.cast("string")), ",").alias("sources"))


_ISLANDS = f"""{LINES}, f AS (SELECT *, coalesce(style IN ('List Bullet', 'List Number'), false) AS is_list FROM lines),
    s AS (SELECT *, CASE WHEN is_list AND coalesce(lag(is_list) OVER (PARTITION BY doc_id ORDER BY doc_index), false) THEN 0 ELSE 1 END AS starts FROM f),
    g AS (SELECT *, sum(starts) OVER (PARTITION BY doc_id ORDER BY doc_index) AS grp FROM s),
    i AS (SELECT *, count(*) OVER (PARTITION BY doc_id, grp) AS n, min(doc_index) OVER (PARTITION BY doc_id, grp) AS first_index FROM g WHERE is_list)"""


@query(f"WITH {_ISLANDS} SELECT doc_id, doc_index, first_index FROM i WHERE n > 1")
def list_islands(spark, folder):
    return lists.list_islands(lines(spark, folder)).select("doc_id", "doc_index", "first_index")


@query(
    f"""WITH {_ISLANDS}, t AS (SELECT doc_id, doc_index, {_STRIP.format('text')} AS title FROM lines WHERE style = '소제목2' AND {_STRIP.format('text')} <> ''),
    x AS (SELECT DISTINCT doc_id, first_index FROM i WHERE n > 1)
    SELECT x.doc_id, x.first_index, coalesce(a.title, b.title, '') AS title FROM x LEFT JOIN t a ON a.doc_id = x.doc_id AND a.doc_index = x.first_index - 1 LEFT JOIN t b ON b.doc_id = x.doc_id AND b.doc_index = x.first_index - 2"""
)
def list_title(spark, folder):
    p = lines(spark, folder)
    return lists.list_titles(lists.list_islands(p).select("doc_id", "first_index").distinct(), p).select("doc_id", "first_index", "title")


@query(
    f"""WITH {_ISLANDS}, t AS (SELECT doc_id, doc_index, {_STRIP.format('text')} AS title FROM lines WHERE style = '소제목2' AND {_STRIP.format('text')} <> ''),
    k AS (SELECT doc_id, first_index, doc_index, {_STRIP.format('text')} AS s, row_number() OVER (PARTITION BY doc_id, first_index ORDER BY doc_index) AS n FROM i WHERE n > 1 AND text <> ''),
    l AS (SELECT doc_id, first_index, string_agg(chr(CAST(96 + n AS INTEGER)) || '. ' || s, chr(10) ORDER BY doc_index) AS body FROM k WHERE s <> '' GROUP BY ALL)
    SELECT x.doc_id, x.first_index AS doc_index, concat_ws(chr(10), '제목: ' || coalesce(a.title, b.title), l.body) AS text
    FROM (SELECT DISTINCT doc_id, first_index FROM i WHERE n > 1) x LEFT JOIN l ON l.doc_id = x.doc_id AND l.first_index = x.first_index
    LEFT JOIN t a ON a.doc_id = x.doc_id AND a.doc_index = x.first_index - 1 LEFT JOIN t b ON b.doc_id = x.doc_id AND b.doc_index = x.first_index - 2"""
)
def list_format(spark, folder):
    return lists.list_components(lines(spark, folder)).select("doc_id", "doc_index", "text")


@query(f"WITH {LINES} SELECT l.doc_id, l.doc_index, p.text AS preceding_text FROM lines l LEFT JOIN lines p ON p.doc_id = l.doc_id AND p.doc_index = l.doc_index - 1 WHERE l.k = 5")
def preceding_text(spark, folder):
    p = lines(spark, folder)
    t = p.filter(F.pmod(F.col("doc_id") * 31 + F.col("doc_index"), F.lit(13)) == 5).select("doc_id", "doc_index")
    return tables.preceding_text(t, p).select("doc_id", "doc_index", "preceding_text")


@query(
    f"""WITH {LINES}, p AS (SELECT doc_id, doc_index, text || CASE WHEN k = 9 THEN ' [image:rId' || doc_index || ']' ELSE '' END AS text FROM lines),
    i AS (SELECT doc_id, doc_index, 'rId' || doc_index AS rid FROM lines WHERE k IN (9, 10))
    SELECT i.doc_id, i.doc_index, i.rid, coalesce(contains(o.text, '[image:' || rid || ']'), false) AS is_in_paragraph,
      CASE WHEN coalesce(contains(o.text, '[image:' || rid || ']'), false) THEN o.text ELSE b.text END AS preceding_text
    FROM i LEFT JOIN p o ON o.doc_id = i.doc_id AND o.doc_index = i.doc_index AND o.text <> '' LEFT JOIN p b ON b.doc_id = i.doc_id AND b.doc_index = i.doc_index - 1 AND b.text <> ''"""
)
def image_context(spark, folder):
    k = F.pmod(F.col("doc_id") * 31 + F.col("doc_index"), F.lit(13))
    rid = F.concat(F.lit("rId"), F.col("doc_index"))
    p = lines(spark, folder).withColumn("text", F.concat("text", F.when(k == 9, F.concat(F.lit(" [image:"), rid, F.lit("]"))).otherwise("")))
    i = p.filter(k.isin(9, 10)).select("doc_id", "doc_index", rid.alias("rId"))
    return images.image_context(i, p).select("doc_id", "doc_index", F.col("rId").alias("rid"), "is_in_paragraph", "preceding_text")


# ---- images, sections -----------------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey AS doc_id, 'r' || (o_custkey % 7 + 1) AS rid, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = o_custkey % 7 + 1) AS is_in_table FROM orders"""
)
def image_in_table_semi(spark, folder):
    i = table(spark, folder, "orders").select(F.col("o_orderkey").alias("doc_id"), F.concat(F.lit("r"), F.pmod("o_custkey", F.lit(7)) + 1).alias("rId"))
    c = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.array(F.concat(F.lit("r"), "l_linenumber")).alias("images"))
    return images.in_tables(i, c).select("doc_id", F.col("rId").alias("rid"), "is_in_table")


@query("SELECT page_id, sha256(html) AS content_sha256 FROM pages WHERE sha256(html) NOT IN (SELECT sha256(html) FROM pages WHERE page_id % 2 = 0)")
def ocr_cache_anti(spark, folder):
    p = table(spark, folder, "pages").select("page_id", models.content_hash(F.col("html")).alias("content_sha256"))
    return images.uncached(p, p.filter("page_id % 2 = 0")).select("page_id", "content_sha256")


@query(
    """WITH b AS (SELECT user_id AS section_id, event_id % 1000 AS doc_index, event_id FROM events), s AS (SELECT section_id, doc_index AS lo, doc_index + 40 AS hi FROM b WHERE event_id % 10 = 0)
    SELECT section_id, event_id, doc_index FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.section_id = b.section_id AND b.doc_index >= s.lo AND b.doc_index < s.hi)"""
)
def section_block_range_anti(spark, folder):
    b = table(spark, folder, "events").select(F.col("user_id").alias("section_id"), F.pmod("event_id", F.lit(1000)).alias("doc_index"), "event_id")
    s = b.filter("event_id % 10 = 0").select(F.col("section_id").alias("parent_id"), F.col("doc_index").alias("span_start"), (F.col("doc_index") + 40).alias("span_end"))
    return sections.own_blocks(b, s)


@query(
    f"""WITH {LINES}, h AS (SELECT doc_id, doc_index AS pos, CAST({_LEVEL} AS INTEGER) AS level FROM lines), x AS (SELECT * FROM h WHERE level IS NOT NULL)
    SELECT a.doc_id, a.pos AS section_id, a.level, (SELECT max(b.pos) FROM x b WHERE b.doc_id = a.doc_id AND b.pos < a.pos AND b.level < a.level) AS parent_id,
      (SELECT min(b.pos) FROM x b WHERE b.doc_id = a.doc_id AND b.pos > a.pos AND b.level <= a.level) AS span_end FROM x a"""
)
def section_tree(spark, folder):
    h = lines(spark, folder).select("doc_id", F.col("doc_index").alias("pos"), T.heading_level(F.col("style"), F.col("text")).alias("level"), F.col("text").alias("title")).filter("level is not null")
    return sections.section_tree(h).select("doc_id", "section_id", "level", "parent_id", "span_end")


@query(
    """SELECT doc_id, image, filename, CASE WHEN n = 0 THEN filename ELSE 'image' || doc_id % 3 || '_' || n || '.png' END AS media_name FROM (
      SELECT doc_id % 200 AS doc_id, doc_id AS image, 'image' || (doc_id % 200) % 3 || '.png' AS filename, row_number() OVER (PARTITION BY doc_id % 200 ORDER BY doc_id) - 1 AS n FROM documents)"""
)
def media_names(spark, folder):
    d = table(spark, folder, "documents").select(F.pmod("doc_id", F.lit(200)).alias("doc_id"), F.col("doc_id").alias("ord"))
    d = d.withColumn("filename", F.concat(F.lit("image"), F.pmod("doc_id", F.lit(3)), F.lit(".png")))
    return images.media_names(d).select("doc_id", F.col("ord").alias("image"), "filename", "media_name")


# ---- tables ---------------------------------------------------------------------------------------------------------


@query(f"WITH {CELLS} SELECT doc_id, r, col AS c, text, styled FROM grid")
def table_grid(spark, folder):
    return tables.grid(cells(spark, folder)).select("doc_id", F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), "text", "styled")


@query(f"WITH {CELLS} SELECT doc_id, r, c, CAST(colspan AS BIGINT) AS colspan, CAST(rowspan AS BIGINT) AS rowspan FROM anchors")
def table_anchors(spark, folder):
    long = lambda name: F.col(name).cast("long").alias(name)
    return tables.anchors(cells(spark, folder)).select("doc_id", *map(long, ("r", "c", "colspan", "rowspan")))


_HEADERS = r"""heads AS (SELECT doc_id, bool_and(styled) FILTER (r = 0) AND NOT bool_or(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) >= 3) FILTER (r = 0) AS is_rowheader,
   bool_and(styled) FILTER (col = 0) AND NOT bool_or(len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) >= 3) FILTER (col = 0) AS is_colheader FROM grid GROUP BY doc_id)"""


@query(f"WITH {CELLS}, {_HEADERS} SELECT doc_id, is_rowheader, is_colheader FROM heads")
def table_header(spark, folder):
    return tables.with_headers(tables.laid_out(cells(spark, folder), ("places",))).select("doc_id", "is_rowheader", "is_colheader")


@query(
    f"""WITH {CELLS}, {_HEADERS},
    html AS (SELECT a.doc_id, a.r, a.c, CASE WHEN (is_rowheader AND a.r = 0) OR (is_colheader AND a.c = 0) THEN 'th' ELSE 'td' END AS tag,
      CASE WHEN rowspan > 1 THEN ' rowspan="' || rowspan || '"' ELSE '' END || CASE WHEN colspan > 1 THEN ' colspan="' || colspan || '"' ELSE '' END || CASE WHEN g.styled THEN ' style="background-color: #f2f2f2;"' ELSE '' END AS attrs,
      replace(replace(replace(g.text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS t
      FROM anchors a JOIN grid g ON g.doc_id = a.doc_id AND g.r = a.r AND g.col = a.c JOIN heads h ON h.doc_id = a.doc_id WHERE coalesce(a.vmerge, '') <> 'continue' AND a.c < a.nc),
    rows_ AS (SELECT e.doc_id, e.r, concat_ws(chr(10), '  <tr>', (SELECT string_agg('    <' || tag || attrs || '>' || t || '</' || tag || '>', chr(10) ORDER BY c) FROM html x WHERE x.doc_id = e.doc_id AND x.r = e.r), '  </tr>') AS line
      FROM (SELECT DISTINCT doc_id, r FROM every) e)
    SELECT doc_id, '<table>' || chr(10) || string_agg(line, chr(10) ORDER BY r) || chr(10) || '</table>' AS table_html FROM rows_ GROUP BY doc_id"""
)
def table_html(spark, folder):
    return tables.laid_out(cells(spark, folder), ("places",)).select("doc_id", tables.html().alias("table_html"))


@query(
    f"""WITH {CELLS}, {_HEADERS},
    v AS (SELECT a.doc_id, a.r, a.c, g.text AS cell, concat_ws(' | ', CASE WHEN is_colheader THEN nullif(rh.text, '') END, CASE WHEN is_rowheader THEN nullif(ch.text, '') END) AS header
      FROM anchors a JOIN grid g ON g.doc_id = a.doc_id AND g.r = a.r AND g.col = a.c JOIN heads h ON h.doc_id = a.doc_id
      JOIN grid rh ON rh.doc_id = a.doc_id AND rh.r = a.r AND rh.col = 0 JOIN grid ch ON ch.doc_id = a.doc_id AND ch.r = 0 AND ch.col = a.c
      WHERE coalesce(a.vmerge, '') <> 'continue' AND g.text <> '' AND NOT (is_rowheader AND a.r = 0) AND NOT (is_colheader AND a.c = 0))
    SELECT doc_id, r, string_agg(header || '=' || cell, ';' ORDER BY c) AS entries FROM v GROUP BY doc_id, r"""
)
def table_context_rows(spark, folder):
    e = tables.value_rows(tables.laid_out(cells(spark, folder), ("places",)))
    return e.select("doc_id", F.col("r").cast("long").alias("r"), F.array_join(F.transform("entries", lambda x: F.concat(x["header"], F.lit("="), x["cell"])), ";").alias("entries"))


# ---- captions -------------------------------------------------------------------------------------------------------


@query(
    f"""WITH r AS (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN 'system' || chr(10) || 'x' || chr(10) || 'assistant' || chr(10) || text WHEN 1 THEN 'assistant: ' || text ELSE text END AS t FROM conversations),
    a AS (SELECT conv_id, turn, {_STRIP.format('t')} AS t FROM r),
    b AS (SELECT conv_id, turn, CASE WHEN position(chr(10) || 'assistant' || chr(10) IN t) > 0 THEN {_STRIP.format("substr(t, position(chr(10) || 'assistant' || chr(10) IN t) + 11)")} ELSE t END AS t FROM a),
    c AS (SELECT conv_id, turn, CASE WHEN position('assistant' || chr(10) IN t) > 0 THEN {_STRIP.format("substr(t, position('assistant' || chr(10) IN t) + 10)")} ELSE t END AS t FROM b)
    SELECT conv_id, turn, CASE WHEN position('assistant:' IN t) > 0 THEN {_STRIP.format("substr(t, position('assistant:' IN t) + 10)")} ELSE t END AS caption FROM c"""
)
def caption_clean(spark, folder):
    t = F.expr("case turn % 3 when 0 then concat('system\\nx\\nassistant\\n', text) when 1 then concat('assistant: ', text) else text end")
    return table(spark, folder, "conversations").select("conv_id", "turn", T.clean_caption(t).alias("caption"))


@query(
    r"""WITH r AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'Here is: - ' WHEN 1 THEN 'this is ' WHEN 2 THEN 'HERE''S,. ' ELSE '' END || text AS t FROM conversations)
    SELECT conv_id, turn, regexp_replace(t, '(?is)^(?:here is|here''s|this is|here are|here''re)[:,\-. \t]*', '') AS caption FROM (SELECT conv_id, turn, regexp_replace(t, '^\s+|\s+$', '', 'g') AS t FROM r)"""
)
def caption_normalize(spark, folder):
    lead = F.expr("case turn % 4 when 0 then 'Here is: - ' when 1 then 'this is ' when 2 then \"HERE'S,. \" else '' end")
    return table(spark, folder, "conversations").select("conv_id", "turn", T.normalize_caption(F.concat(lead, "text")).alias("caption"))


@query(
    """WITH s AS (SELECT conv_id, 'rid' || turn AS rid, text AS cap FROM conversations WHERE turn % 2 = 0)
    SELECT c.conv_id, c.turn, 'a [Image:rId' || c.turn || ']' || coalesce(' ' || trim(s.cap, ' ' || chr(10)), '') || ' b [image:RID' || c.turn || ']' || coalesce(' ' || trim(s.cap, ' ' || chr(10)), '') || ' [Image:none] ' || c.text AS context
    FROM conversations c LEFT JOIN s ON s.conv_id = c.conv_id AND s.rid = 'rid' || c.turn"""
)
def caption_inject(spark, folder):
    c = table(spark, folder, "conversations")
    context = F.concat(F.lit("a [Image:rId"), "turn", F.lit("] b [image:RID"), "turn", F.lit("] [Image:none] "), "text")
    chunks = c.select(F.col("conv_id").alias("doc_id"), "turn", context.alias("Context"))
    s = c.filter("turn % 2 = 0").select(F.col("conv_id").alias("doc_id"), F.concat(F.lit("rId"), "turn").alias("rId"), F.col("turn").alias("ord"), F.col("text").alias("llm_text"))
    return images.inject(chunks, s).select(F.col("doc_id").alias("conv_id"), "turn", F.col("Context").alias("context"))


# ---- BM25 -----------------------------------------------------------------------------------------------------------

EN = """
w AS (SELECT doc_id, regexp_extract_all(lower(text), '[A-Za-z0-9_]+') AS w FROM documents WHERE text IS NOT NULL),
toks AS (SELECT doc_id, w || list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1]) AS t FROM w),
e AS (SELECT doc_id, unnest(t) AS term FROM toks),
tot AS (SELECT count(*) FILTER (len(t) > 0) AS n, CAST(sum(len(t)) AS DOUBLE) / count(*) FILTER (len(t) > 0) AS avgdl FROM toks),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM e GROUP BY term),
vocab AS (SELECT term, df, ln((n - df + 0.5) / (df + 0.5) + 1.0) AS idf, row_number() OVER (ORDER BY term) - 1 AS idx FROM df, tot WHERE df >= 2 AND df <= floor(CAST(0.9 AS DOUBLE) * n) AND ln((n - df + 0.5) / (df + 0.5) + 1.0) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM e JOIN vocab USING (term) GROUP BY ALL),
wt AS (SELECT doc_id, term, idx, idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * sum(tf) OVER (PARTITION BY doc_id) / avgdl)) AS weight FROM tf JOIN vocab USING (term), tot)
"""


def _texts(spark, folder) -> DataFrame:
    """Every document with a text: language en picks the tokenizer only."""
    return table(spark, folder, "documents").filter("text is not null")


@query("WITH " + EN + " SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5 FROM toks")
def en_tokens(spark, folder):
    t = bm25.tokenized(_texts(spark, folder), "en")
    return t.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5"))


@query(
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array('데이터A 분석 ' || text, '\\s+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, array_to_string(['데이터A', '데이', '이터', '분석', '분석'] || w[3:], ' ') AS tokens FROM w"""
)
def ko_tokens(spark, folder):
    d = table(spark, folder, "documents").filter("text is not null")
    return d.select("doc_id", F.array_join(T.korean_tokens(F.concat(F.lit("데이터A 분석 "), "text")), " ").alias("tokens"))


@query("WITH " + EN + " SELECT term, df FROM df")
def bm25_df(spark, folder):
    return bm25.document_frequencies(bm25.tokenized(_texts(spark, folder), "en"))


@query("WITH " + EN + " SELECT term, df, idx, round(idf, 6) AS idf FROM vocab")
def bm25_vocab(spark, folder):
    v = bm25.fit(_texts(spark, folder)).vocab
    return v.select("term", "df", F.col("idx").cast("long").alias("idx"), F.round("idf", 6).alias("idf"))


@query("WITH " + EN + " SELECT doc_id, term, round(weight, 6) AS weight FROM wt")
def bm25_weights(spark, folder):
    docs = _texts(spark, folder)
    m = bm25.fit(docs)
    return bm25.weights(bm25.counted(docs, "en"), m.vocab, m.meta, m.params).select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query("WITH " + EN + " SELECT doc_id, count(term) AS n_terms, coalesce(min(idx), -1) AS first_idx, coalesce(max(idx), -1) AS last_idx FROM toks LEFT JOIN wt USING (doc_id) GROUP BY doc_id")
def bm25_transform(spark, folder):
    docs = _texts(spark, folder)
    s = bm25.transform(docs, bm25.fit(docs))
    idx = F.col("sparse.indices")
    at = lambda i: F.coalesce(F.get(idx, i), F.lit(-1)).cast("long")
    return s.select("doc_id", F.size(idx).cast("long").alias("n_terms"), at(F.lit(0)).alias("first_idx"), at(F.size(idx) - 1).alias("last_idx"))


@query(
    "WITH " + EN + """, q AS (SELECT item_id AS query_id, unnest(list_distinct(regexp_extract_all(lower(text), '[A-Za-z0-9_]+'))) AS term FROM benchmark),
    s AS (SELECT query_id, doc_id, sum(weight) AS score FROM q JOIN wt USING (term) GROUP BY ALL),
    k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM s)
    SELECT query_id, doc_id, rank, round(score, 6) AS score FROM k WHERE rank <= 10"""
)
def bm25_search(spark, folder):
    docs = _texts(spark, folder)
    m = bm25.fit(docs)
    w = bm25.weights(bm25.counted(docs, "en"), m.vocab, m.meta, m.params)
    q = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), F.explode(F.array_distinct(T.english_tokens(F.col("text"), bigrams=False))).alias("term")).withColumn("weight", F.lit(1.0))
    s = bm25.scores(w, q).withColumn("score", F.round("score", 6))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")).cast("long")
    return s.withColumn("rank", rank).filter("rank <= 10").select("query_id", "doc_id", "rank", "score")


# ---- vectors --------------------------------------------------------------------------------------------------------


def _top(metric: str, k: int = 10):
    def run(spark, folder):
        e = table(spark, folder, "embeddings")
        q = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
        return vectors.top_k(e, q, metric, k).select("query_id", "vec_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))

    return run


def _top_sql(score: str, order: str) -> str:
    return f"""WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS a FROM embeddings WHERE vec_id % 20 = 0), e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS b FROM embeddings),
    s AS (SELECT query_id, vec_id, {score} AS score FROM q, e), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score {order}, vec_id) AS rank FROM s)
    SELECT query_id, vec_id, rank, round(score, 6) AS score FROM k WHERE rank <= 10"""


for _name, _metric, _score, _order in (
    ("cosine_topk", "cosine", "list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))", "DESC"),
    ("dot_topk", "dot", "list_dot_product(a, b)", "DESC"),
    ("euclid_topk", "euclid", "list_distance(a, b)", "ASC"),
):
    QUERIES[_name], SQL[_name] = _top(_metric), _top_sql(_score, _order)


@query(
    """WITH e AS (SELECT vec_id, vec_id // 5 AS doc_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    b AS (SELECT q.doc_id AS query_id, q.vec_id, d.doc_id, max(list_dot_product(q.v, d.v)) AS s FROM e q, e d WHERE q.doc_id % 20 = 0 GROUP BY ALL),
    s AS (SELECT query_id, doc_id, sum(s) AS score FROM b GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
    SELECT query_id, doc_id, rank, round(score, 6) AS score FROM k WHERE rank <= 10"""
)
def maxsim_topk(spark, folder):
    e = table(spark, folder, "embeddings")
    d = e.groupBy(F.floor(F.col("vec_id") / 5).alias("doc_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))), lambda x: x["embedding"]).alias("vectors"))
    q = d.filter("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), F.col("vectors").alias("query"))
    return vectors.top_k(d, q, "max_sim", 10, "doc_id", "vectors").select("query_id", "doc_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@query(
    _top_sql("list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))", "DESC")
    .replace("SELECT query_id, vec_id, rank, round(score, 6) AS score FROM k WHERE rank <= 10", "")
    .rstrip()
    + """, k2 AS (SELECT q.query_id, e.vec_id, row_number() OVER (PARTITION BY q.query_id ORDER BY list_distance(a, b), e.vec_id) AS rank FROM q, e),
    u AS (SELECT query_id, vec_id, rank FROM k WHERE rank <= 50 UNION ALL SELECT query_id, vec_id, rank FROM k2 WHERE rank <= 50)
    SELECT query_id, vec_id, round(sum(1.0 / (60 + rank)), 6) AS score FROM u GROUP BY ALL"""
)
def hybrid_rrf(spark, folder):
    r = [_top(m, 50)(spark, folder) for m in ("cosine", "euclid")]
    return vectors.fuse(r, "vec_id").select("query_id", "vec_id", F.round("score", 6).alias("score"))


# ---- documents, collections -----------------------------------------------------------------------------------------


@query(
    """WITH r AS (SELECT 'c' || conv_id % 3 AS f, conv_id, turn, CASE WHEN turn % 4 = 0 THEN 'u' || conv_id WHEN turn % 4 = 1 THEN 'i' || conv_id WHEN turn % 4 = 2 THEN 'm' || conv_id END AS given, text FROM conversations)
    SELECT conv_id, turn, coalesce(given, f || '_v1_' || lpad(CAST(row_number() OVER (PARTITION BY f, given IS NULL ORDER BY conv_id, turn) AS VARCHAR), 6, '0')) AS unique_id, text AS content FROM r"""
)
def jsonl_id_resolution(spark, folder):
    c = table(spark, folder, "conversations")
    by = lambda n, p: F.when(F.col("turn") % 4 == n, F.concat(F.lit(p), "conv_id"))
    meta = F.struct(by(2, "m").alias("id"), F.lit(None).cast("string").alias("external_id"), F.lit(None).cast("struct<filename:string,filename_stem:string,filename_versioned:string>").alias("general_info"))
    line = F.struct("conv_id", "turn")
    rows = c.select(
        F.concat(F.lit("/x/c"), F.pmod("conv_id", F.lit(3)), F.lit(".jsonl")).alias("path"), line.alias("line"), F.lit("").alias("context"), F.col("text").alias("content"), by(0, "u").alias("unique_id"), by(1, "i").alias("id"), meta.alias("metadata")
    )
    return files.resolve_ids(rows).select("line.conv_id", "line.turn", "unique_id", "content")


@query("SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'new' ELSE source END AS source FROM documents")
def collection_upsert(spark, folder):
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "source")
    return collection.upserted(d, d.filter("id % 3 = 0").withColumn("source", F.lit("new")))


@query("SELECT doc_id AS id, source FROM documents WHERE doc_id % 7 <> 0")
def collection_delete(spark, folder):
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "source")
    return collection.deleted(d, d.filter("id % 7 = 0"))


@query("SELECT doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN 'v' || doc_id ELSE source END AS source FROM documents")
def collection_update(spark, folder):
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "source")
    return collection.updated(d, d.filter("id % 5 = 0").select("id", F.concat(F.lit("v"), "id").alias("source")), "source")


@query("SELECT count(*) AS n FROM documents")
def collection_count(spark, folder):
    return collection.counted(table(spark, folder, "documents"))


@query("SELECT doc_id AS id FROM documents WHERE source = 'src3'")
def filter_by_file(spark, folder):
    d = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.struct(F.struct(F.col("source").alias("File_name")).alias("metadata")).alias("payload"))
    return collection.ids_of_file(d, "src3")


@query(
    "WITH m AS (SELECT doc_id, md5('d' || doc_id) AS h, text FROM documents) SELECT doc_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-8' || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id, text AS content FROM m"
)
def point_generation(spark, folder):
    d = table(spark, folder, "documents").select(F.concat(F.lit("d"), "doc_id").alias("Context_id"), F.col("text").alias("Context"), "doc_id")
    return collection.points(d).select("payload.metadata.doc_id", "id", "payload.content")


@query(
    """SELECT 'documents' AS component, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'conversations', count(*) FROM conversations
    UNION ALL SELECT 'embeddings', count(*) FROM embeddings UNION ALL SELECT 'benchmark', count(*) FROM benchmark"""
)
def inspect_counts(spark, folder):
    return cli.component_counts({n: table(spark, folder, n) for n in ("documents", "pages", "conversations", "embeddings", "benchmark")})


@query("""SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;') AS escaped FROM pages""")
def page_text_html_escape(spark, folder):
    return table(spark, folder, "pages").select("page_id", T.html_escape(F.col("html")).alias("escaped"))


@query()
def aligned_sources(spark, folder):
    p = lines(spark, folder).select("doc_id", "ord", "doc_index", "text")
    return paragraphs.merge_sources(p.filter("ord % 3 <> 1"), p)
