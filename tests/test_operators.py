"""Document operators on the small cases."""

import math
import random

from pyspark.sql import functions as F

from folioforge.operators import bm25, chunking, collection, images, lists, paragraphs, sections, tables, vectors

PARAGRAPH = f"doc_id string, ord int, doc_index int, style string, text string, runs array<{paragraphs.RUN}>, source_doc_indices array<int>, emphasized array<string>, math_texts array<string>, image_included boolean"


def paras(spark, rows):
    return spark.createDataFrame([("d", i, at, style, text, [], [], [], [], False) for i, (at, style, text) in enumerate(rows)], PARAGRAPH)


def chunked(spark, p, t=(), i=()):
    tables_ = spark.createDataFrame([("d", *x) for x in t], "doc_id string, doc_index int, tid string")
    images_ = spark.createDataFrame([("d", *x) for x in i], "doc_id string, doc_index int, rId string")
    e = chunking.union_elements(paras(spark, p), tables_, images_)
    return chunking.chunk(e, F.lit("Doc_sanitized"), F.lit("Doc_sanitized.json")).orderBy("chunk_seq").collect()


def test_chunks(spark):
    p = [(0, None, "pre"), (1, "heading 1", "Chapter 1 Intro"), (2, None, "alpha"), (3, "heading 2", "1.1 Setup"), (4, None, "beta"), (6, "heading 1", "Chapter 2 Next"), (7, None, "gamma")]
    one, two = chunked(spark, p, [(5, "t5")], [(5, "rId7"), (None, "lost")])
    assert (one["Context_id"], one["Section_path"]) == ("Doc_sanitized::chunk_0001", ["Chapter 1 Intro"])
    assert one["Context"] == "This content is about the section Intro.\n\nalpha"
    assert (two["Context_id"], two["Section_path"]) == ("Doc_sanitized::chunk_0002", ["Chapter 1 Intro", "1.1 Setup"])
    assert two["Context"] == "This content is about the section Intro, and more specifically it belongs to Setup.\n\nbeta\n\n[Table:t5]\n\n[Image:rId7]\n\ngamma"
    assert (two["Image_ids"], two["Table_ids"], two["Section_length"], two["Is_image"], two["Page_number"]) == (["rId7"], ["t5"], 2, True, None)
    assert chunked(spark, [(0, None, "no heading")]) == []


def reference_chunks(rows):
    """The rule as a walk: (chunk number, path) by element."""
    titles, n, is_open, out = {}, 0, False, []
    for level, title in rows:
        if level:
            titles = {k: v for k, v in titles.items() if k < level} | {level: title}
            if level > 1:
                n, is_open = n + 1, True
        elif not is_open and not {2, 3} & set(titles) and 1 in titles:
            n, is_open = n + 1, True
        out.append(n)
    return out


def test_chunk_numbers_as_a_walk_gives_them(spark):
    rng = random.Random(5)
    docs = {d: [(rng.choice([None, None, 1, 2, 3, 4]), f"t{i}") for i in range(rng.randrange(1, 15))] for d in range(60)}
    style = {None: None, 1: "heading 1", 2: "heading 2", 3: "heading 3", 4: "subtitle2"}
    rows = [(str(d), i, i, style[level], f"x {t}", [], [], [], [], False) for d, x in docs.items() for i, (level, t) in enumerate(x)]
    p = spark.createDataFrame(rows, PARAGRAPH)
    none = p.limit(0).select("doc_id", "doc_index", F.col("text").alias("tid"), F.col("text").alias("rId"))
    got = chunking.with_chunks(chunking.union_elements(p, none, none)).select("doc_id", "doc_index", "chunk_seq").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r[0], r[1])):
        by.setdefault(int(r[0]), []).append(r[2])
    assert by == {d: reference_chunks(x) for d, x in docs.items()}


def test_plain_merge(spark):
    p = paras(spark, [(0, None, "A"), (1, "heading 1", "H"), (2, None, "B"), (4, None, "C"), (5, None, " ")])
    got = [(r["doc_index"], r["text"], r["source_doc_indices"]) for r in paragraphs.merge_plain(p).orderBy("ord").collect()]
    assert got == [(0, "A", [0]), (1, "H", [1]), (2, "B\nC", [2, 4]), (5, " ", [5])]


def test_runs(spark):
    run = lambda t, b=False, rids=(): (t, b, False, False, None, None, None, list(rids))
    rows = [("d", 0, 3, None, "old", [run("Other Fu"), run(" n", True), run("", True), run("ctions", True, ["r1"]), run("x", True, ["r1", "r2"])], [], [], [], False), ("d", 1, 4, None, "kept", [], [7], ["e"], [], True)]
    a, b = paragraphs.clean_paragraphs(spark.createDataFrame(rows, PARAGRAPH)).orderBy("ord").collect()
    assert [(r["text"], r["image_rids"]) for r in a["runs"]] == [("Other Fu", []), ("n ctions x", ["r1", "r2"])]
    assert (a["text"], a["emphasized"], a["image_included"], a["source_doc_indices"]) == ("Other Fu n ctions x", ["n ctions x"], True, [3])
    assert (b["text"], b["emphasized"], b["image_included"], b["source_doc_indices"]) == ("kept", ["e"], True, [7])


def test_alignment():
    assert paragraphs.align(["A b", "x", "c [image:r1]"], ["ab", "", "zzz", "q"]) == [0, None, 2, None]
    assert paragraphs.align(["one", "two"], ["one", "two"]) == [0, 1]
    assert paragraphs.align(["two"], ["one", "two"]) == [None, 0]
    assert paragraphs.align([], ["x"]) == [None]


def test_lists(spark):
    p = paras(spark, [(4, "소제목2", "Steps"), (5, "List Bullet", "one"), (6, " List Bullet ", "two"), (8, "List Number", "x"), (9, "List Number", "y"), (11, "List Bullet", "solo")])
    got = [(r["doc_index"], r["text"], r["source_doc_indices"], r["style"]) for r in lists.list_components(p).orderBy("doc_index").collect()]
    assert got == [(5, "제목: Steps\na. one\nb. two", [5, 6], "List Bullet"), (8, "a. x\nb. y", [8, 9], "List Bullet")]
    assert [r["doc_index"] for r in lists.consumed(p).orderBy("doc_index").collect()] == [5, 6, 8, 9]


CELL = "doc_id string, tid string, r int, cell_no int, text string, colspan int, vmerge string, images array<string>, styled boolean"


def cells(spark, rows):
    return spark.createDataFrame([("d", "t", r, n, text, span, merge, list(rids), styled) for r, row in enumerate(rows) for n, (text, span, merge, rids, styled) in enumerate(row)], CELL)


def cell(text, span=1, merge=None, rids=(), styled=False):
    return text, span, merge, rids, styled


def matrix(g):
    out = {}
    for r in g.collect():
        out[r["r"], r["c"]] = r["text"]
    return [[out[i, j] for j in range(max(c for _, c in out) + 1)] for i in range(max(r for r, _ in out) + 1)]


def test_table_grid(spark):
    c = cells(spark, [[cell("A", merge="restart"), cell("B")], [cell("", merge="continue"), cell("C")]])
    a = tables.anchors(c)
    assert matrix(tables.grid(a)) == [["A", "B"], ["", "C"]]
    assert matrix(tables.grid(a, fill_merged_text=True)) == [["A", "B"], ["A", "C"]]
    assert {(r["r"], r["c"]): r["rowspan"] for r in a.collect()}[0, 0] == 2
    html = tables.render_html(a, tables.grid(a)).first()["table_html"]
    assert html == '<table>\n  <tr>\n    <td rowspan="2">A</td>\n    <td>B</td>\n  </tr>\n  <tr>\n    <td>C</td>\n  </tr>\n</table>'


def test_table_headers_and_values(spark):
    head = lambda t: cell(t, styled=True)
    c = cells(spark, [[head("h0"), head("h<1>"), head("h2")], [cell("r1", styled=True), cell("v", 2)], [cell("r2", styled=True), cell("w", rids=["r9"])]])
    a = tables.anchors(c)
    g = tables.grid(a)
    assert matrix(g) == [["h0", "h<1>", "h2"], ["r1", "v", "v"], ["r2", "w [image:r9]", ""]]
    h = tables.headers(g).first()
    assert (h["is_rowheader"], h["is_colheader"]) == (True, True)
    got = {r["r"]: [(e["header"], e["cell"]) for e in r["entries"]] for r in tables.context_rows(a, g).collect()}
    assert got == {1: [("r1 | h<1>", "v")], 2: [("r2 | h<1>", "w [image:r9]")]}
    html = tables.render_html(a, g).first()["table_html"]
    assert '<th style="background-color: #f2f2f2;">h&lt;1&gt;</th>' in html and '<td colspan="2">v</td>' in html


def test_images(spark):
    p = paras(spark, [(0, None, "before"), (1, None, "has [image:r1]"), (3, None, "x")])
    i = spark.createDataFrame([("d", "r1", 1), ("d", "r2", 1), ("d", "r3", 2), ("d", "r4", None)], "doc_id string, rId string, doc_index int")
    got = {r["rId"]: (r["is_in_paragraph"], r["preceding_text"]) for r in images.image_context(i, p).collect()}
    assert got == {"r1": (True, "has [image:r1]"), "r2": (False, "before"), "r3": (False, "has [image:r1]"), "r4": (False, None)}
    c = cells(spark, [[cell("x", rids=["r2", "r2"])]])
    assert {r["rId"]: r["is_in_table"] for r in images.in_tables(i, c).collect()} == {"r1": False, "r2": True, "r3": False, "r4": False}
    m = spark.createDataFrame([("d", 0, "image1.png"), ("d", 1, "image1.png"), ("d", 2, "noext"), ("d", 3, "noext"), ("e", 0, "image1.png")], "doc_id string, ord int, filename string")
    assert [r["media_name"] for r in images.media_names(m).orderBy("doc_id", "ord").collect()] == ["image1.png", "image1_1.png", "noext", "noext_1", "image1.png"]
    uses = spark.createDataFrame([("d", "r1", 1, 5), ("d", "r1", 0, 7), ("d", "r1", 2, 5)], "doc_id string, rId string, ord int, doc_index int")
    at = {r["rId"]: (r["doc_index"], r["doc_indices"]) for r in images.image_places(i.drop("doc_index"), uses).collect()}
    assert at["r1"] == (7, [5, 7]) and at["r2"] == (None, [])


def test_image_models(spark):
    i = spark.createDataFrame([("a.PNG", bytearray(b"ok")), ("b.jpg", bytearray(b"ok")), ("c.png", bytearray(b"bad"))], "filename string, content binary")

    def model():
        return lambda data: {b"ok": "text"}[data]

    assert {r["filename"]: r["ocr_text"] for r in images.read_images(i, model).collect()} == {"a.PNG": "text", "b.jpg": None, "c.png": None}


def test_captions_change_nothing_else(spark):
    chunks = spark.createDataFrame([("d", "x [Image:rId1] y", 1), ("e", "x [Image:rId1]", 2)], "doc_id string, Context string, n int")
    s = spark.createDataFrame([("d", 0, "rid1 ", "old"), ("d", 1, "RID1", " new "), ("d", 2, "r2", " ")], "doc_id string, ord int, rId string, llm_text string")
    assert sorted(map(tuple, images.inject(chunks, s).collect())) == [("d", "x [Image:rId1] new y", 1), ("e", "x [Image:rId1]", 2)]


def test_sections(spark):
    b = spark.createDataFrame([(1, x) for x in (1, 3, 5, 6, None)], "section_id int, doc_index int")
    s = spark.createDataFrame([(1, 3, 6)], "parent_id int, span_start int, span_end int")
    assert sorted((r["doc_index"] for r in sections.own_blocks(b, s).collect()), key=lambda x: (x is None, x)) == [1, 6, None]


def test_bm25(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, "a b"), (4, "")], "doc_id long, text string")
    m = bm25.fit(docs)
    assert m.meta.first().asDict() == {"N": 3, "avgdl": 3.0}
    vocab = {r["term"]: (r["idx"], round(r["idf"], 6)) for r in m.vocab.collect()}
    assert vocab == {"a_b": (0, 0.470004), "b": (1, 0.470004)}
    got = {r["doc_id"]: (r["sparse"]["indices"], [round(v, 6) for v in r["sparse"]["values"]]) for r in bm25.transform(docs, m).collect()}
    assert got == {1: ([0, 1], [0.544215] * 2), 2: ([], []), 3: ([0, 1], [0.544215] * 2), 4: ([], [])}


def test_bm25_saved(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "a c"), (3, "a b")], "doc_id long, text string")
    bm25.save(bm25.fit(docs, bm25.Params(k1=1.5)), str(tmp_path / "m"))
    m = bm25.load(spark, str(tmp_path / "m"), "en")
    assert m.params.k1 == 1.5 and m.vocab.count() == 2
    for bad in (lambda: bm25.load(spark, str(tmp_path / "m"), "ko"), lambda: bm25.fit(docs.limit(0)), lambda: bm25.fit(docs, bm25.Params("auto"))):
        try:
            bad()
        except ValueError:
            continue
        raise AssertionError


def test_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0]), (3, [3.0, 4.0])], "vec_id long, embedding array<float>")
    q = spark.createDataFrame([(0, [0.0, 1.0])], "query_id long, query array<float>")
    rank = lambda metric: [(r["vec_id"], round(r["score"], 6)) for r in vectors.top_k(df, q, metric, 2).orderBy("rank").collect()]
    assert rank("cosine") == [(2, 1.0), (3, 0.8)] and rank("dot") == [(3, 4.0), (2, 2.0)] and rank("euclid") == [(2, 1.0), (1, round(math.sqrt(2), 6))]
    out = vectors.encode(spark.createDataFrame([("abc",), (None,)], "text string"), lambda: lambda ts: [[float(len(t))] for t in ts])
    assert sorted(r["dense"][0] for r in out.collect()) == [0.0, 3.0]


def test_collection(spark, tmp_path):
    rows = spark.createDataFrame([("a", [1.0]), ("b", [2.0]), ("c", [3.0])], "id string, dense array<double>")
    c = collection.Collection(spark, str(tmp_path), "points")
    assert not c.exists()
    c.create(rows)
    c.upsert(rows)
    c.upsert(spark.createDataFrame([("a", [9.0]), ("d", [4.0])], rows.schema))
    c.update_vectors(spark.createDataFrame([("b", [8.0]), ("zz", [0.0])], rows.schema), "dense")
    assert {r["id"]: r["dense"][0] for r in c.read().collect()} == {"a": 9.0, "b": 8.0, "c": 3.0, "d": 4.0}
    assert c.delete(spark.createDataFrame([("a",), ("none",)], "id string")) == 1 and c.count() == 3
    c.drop()
    assert not c.exists()
