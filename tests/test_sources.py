"""Reading Word files that the test writes, JSON lines, chunk files; the stream; the command line."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from folioforge import cli
from folioforge.operators import chunking, collection
from folioforge.sources import docx, files
from folioforge.streaming import ingest

NAMES = (
    'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" '
    'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:m="http://schemas.openxmlformats.org/officeDocument/2006/math" '
    'xmlns:wp="http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing"'
)
STYLES = f'<w:styles {NAMES}><w:style w:type="paragraph" w:styleId="H1"><w:name w:val="heading 1"/></w:style><w:style w:type="paragraph" w:styleId="H2"><w:name w:val="heading 2"/></w:style></w:styles>'
RELS = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Type="http://x/image" Target="media/image1.png"/><Relationship Id="rId8" Type="http://x/image" Target="media/gone.png"/><Relationship Id="rId9" Type="http://x/styles" Target="styles.xml"/></Relationships>'


def run(text, fmt=""):
    return f"<w:r><w:rPr>{fmt}</w:rPr><w:t>{text}</w:t></w:r>"


def p(*content, style=None):
    return f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{style}{chr(34)}/></w:pPr>' if style else ''}{''.join(content)}</w:p>"


IMAGE = '<w:r><w:drawing><wp:inline><wp:extent cx="10" cy="20"/><a:blip r:embed="rId7"/></wp:inline></w:drawing></w:r>'
MATH = "<m:oMath><m:r><m:t>x</m:t></m:r><m:r><m:t>2</m:t></m:r></m:oMath>"


def tc(content, pr=""):
    return f"<w:tc><w:tcPr>{pr}</w:tcPr>{content}</w:tc>"


def make(body):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {NAMES}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", STYLES)
        z.writestr("word/_rels/document.xml.rels", RELS)
        z.writestr("word/media/image1.png", b"png")
    return out.getvalue()


TABLE = (
    '<w:tbl><w:tr>' + tc(p(run("A")), '<w:vMerge w:val="restart"/>') + tc(p(run("B")), '<w:gridSpan w:val="2"/><w:shd w:fill="FF0000"/>') + "</w:tr><w:tr>"
    + tc(p(), '<w:vMerge w:val="continue"/>') + tc(p(run("C"))) + tc("<w:tbl><w:tr>" + tc(p(run("in"))) + "</w:tr></w:tbl>") + "</w:tr></w:tbl>"
)
BODY = p(run("Chapter 1 Intro"), style="H1") + p() + p(run("Hello "), run("bold", '<w:b w:val="0"/><w:sz w:val="21"/><w:color w:val="ff00aa"/>'), IMAGE, MATH) + p(run("1.1 Setup"), style="H2") + TABLE + "<w:sectPr/>" + p(run("end"))


def test_parse():
    d = docx.parse_docx(make(BODY))
    assert d["success"] and [(x["doc_index"], x["text"], x["style"]) for x in d["paragraphs"]] == [
        (0, "Chapter 1 Intro", "heading 1"), (2, "Hello bold[image:rId7]x2", None), (3, "1.1 Setup", "heading 2"), (5, "end", None),
    ]
    bold = d["paragraphs"][1]["runs"][1]
    assert (bold["b"], bold["sz"], bold["color"]) == (True, 10.5, "FF00AA") and d["paragraphs"][1]["emphasized"] == ["bold"] and d["paragraphs"][1]["math_texts"] == ["x2"]
    outer, inner = d["tables"]
    assert (outer["tid"], outer["doc_index"], inner["tid"]) == ("t4", 4, "t4_n1")
    assert [[(c["text"], c["gridSpan"], c["vMerge"], c["has_style"]) for c in r] for r in outer["rows"]] == [[("A", 1, "restart", False), ("B", 2, None, True)], [("", 1, "continue", False), ("C", 1, None, False), ("[table:t4_n1]", 1, None, False)]]
    assert [(i["rId"], i["doc_index"], i["doc_indices"]) for i in d["inline_images"]] == [("rId7", 2, [2]), ("rId8", None, [])]
    assert [(r["rid"]) for r in d["relationships"]] == ["rId7", "rId8", "rId9"] and d["drawings"][0]["cx"] == 10
    assert docx.parse_docx(b"no zip")["success"] is False


def test_joined():
    cases = {("abc", "12"): "abc12", ("don", "'t"): "don't", ("(", "x"): "(x", ("1.", "5"): "1.5", ("x-", "y"): "x-y", ("a", "b"): "a b", ("", "b"): "b", (" a", " ", "b ", "."): " a b.", (" ",): " ", (): ""}
    assert {k: docx.joined(k) for k in cases} == cases


def test_empty_merges_stay_empty():
    # What an empty value means is told by vmerge_default, so the reader keeps it.
    d = docx.parse_docx(make("<w:tbl><w:tr>" + tc(p(run("A")), "<w:vMerge/>") + tc(p(run("B"))) + "</w:tr></w:tbl>"))
    assert [c["vMerge"] for c in d["tables"][0]["rows"][0]] == ["", None]


def test_files_to_chunks(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.docx").write_bytes(make(BODY))
    (tmp_path / "in/sub/bad.docx").write_bytes(b"bad")
    (tmp_path / "in/~$a.docx").write_bytes(b"lock")
    (tmp_path / "captions.json").write_text(json.dumps([{"doc_id": f"file:{tmp_path}/in/a.docx", "rId": "rid7", "llm_text": "a cat"}]))
    out = str(tmp_path / "out")
    cli.run(spark, str(tmp_path / "in"), out, str(tmp_path / "captions.json"))
    chunks = [r["Context"] for r in spark.read.parquet(f"{out}/chunks").orderBy("chunk_seq").collect()]
    assert chunks[0] == "This content is about the section Intro.\n\nHello bold [image:rId7] a cat x2\n\n[Image:rId7] a cat"
    assert chunks[1].endswith("belongs to Setup.\n\n[Table:t4]\n\n[Table:t4_n1]\n\nend")
    assert [r["doc_id"].rsplit("/", 1)[-1] for r in spark.read.parquet(f"{out}/errors").collect()] == ["bad.docx"]
    t = {r["tid"]: r for r in spark.read.parquet(f"{out}/tables").collect()}
    assert (t["t4"]["rows"], t["t4"]["cols"], t["t4"]["preceding_text"]) == (2, 3, "1.1 Setup")
    assert json.loads(cli.inspect(spark, out, "all", True)) == {"paragraphs": 4, "tables": 2, "lists": 0, "images": 2, "chunks": 2}
    assert cli.inspect(spark, out, "images") == "2" and "chunks: yes" in cli.inspect(spark, out, "ls")
    docs = docx.read_docx(spark, str(tmp_path / "in")).filter("success")
    media = {r["rId"]: r["content"] for r in docx.read_media(spark, str(tmp_path / "in"), docs).collect()}
    assert {k: v and bytes(v) for k, v in media.items()} == {"rId7": b"png", "rId8": None}


def test_jsonl(spark, tmp_path):
    lines = ['{"context": "a", "unique_id": "u1"}', "{bad", '{"content": "b", "metadata": {"id": "m"}}', '{"context": "", "content": "c"}', '{"id": "i", "context": "d"}', '{"context": "e"}']
    (tmp_path / "f.jsonl").write_text("\n".join(lines))
    got = [(r["content"], r["unique_id"]) for r in files.read_jsonl(spark, str(tmp_path / "f.jsonl"), "v2").orderBy("line").collect()]
    assert got == [("a", "u1"), ("b", "m"), ("c", "f_v2_000001"), ("d", "i"), ("e", "f_v2_000002")]
    assert sorted(r["text"] for r in files.read_texts(spark, str(tmp_path / "f.jsonl")).collect()) == ["", "", "a", "d", "e"]
    assert files.read_texts(spark, str(tmp_path / "f.jsonl"), limit=2).count() == 2


def test_chunk_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/a_chunked.json").write_text(json.dumps([{"Context": "plain"}]))
    assert [f.rsplit("/", 1)[-1] for f in files.find_chunk_files(spark, str(tmp_path))] == ["a_chunked.json"]
    (tmp_path / "x/b_chunked_with_imgsum.json").write_text(json.dumps([{"Context": "rich", "File_name": "b"}, {"Context": " "}]))
    rows = files.read_chunks(spark, str(tmp_path)).collect()
    assert [(r["text"], r["metadata"]["File_name"]) for r in rows] == [("rich", "b")]
    try:
        files.find_chunk_files(spark, str(tmp_path / "x/none"))
    except Exception as e:
        assert "none" in str(e)
    assert files.output_name("d/Doc_sanitized.json", "chunked") == "d/Doc_chunked.json"


def test_file_picking(spark):
    rows = spark.createDataFrame([("/d/a_sanitized.json", 1), ("/d/b_sanitized.json", 2), ("/d/c.json", 9), ("/d/x.docx", 3), ("/e/x.docx", 3)], "path string, modificationTime long")
    assert files.newest(rows).first()[0] == "/d/b_sanitized.json"
    assert files.newest(rows.filter("path not like '%sanitized%'")).first()[0] == "/d/c.json"
    assert [r[0] for r in files.pick_one(rows, "c").collect()] == ["/d/c.json"] and files.pick_one(rows, "x.docx").count() == 0 and files.pick_one(rows, "/e/x.docx").count() == 1


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.docx").write_bytes(make(BODY))
    (tmp_path / "in/copy.docx").write_bytes((tmp_path / "in/a.docx").read_bytes())

    def to_points(rows):
        return rows.select(F.col("content_sha256").alias("id"), F.length("content").alias("n"))

    c = collection.Collection(spark, str(tmp_path), "c")
    c.create(spark.createDataFrame([], "id string, n int"))
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(ingest.distinct_content(ingest.new_files(spark, str(tmp_path / "in"))), to_points, c, str(tmp_path / "cp")).awaitTermination(120)
        assert c.count() == 1
    assert chunking.KINDS["image"] == 2
