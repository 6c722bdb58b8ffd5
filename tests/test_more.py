"""Settings, models, whole documents."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge import indexing
from folioforge.config import Settings, file_names
from folioforge.functions import models
from folioforge.operators import bm25, collection, images, sections
from folioforge.sources import docjson


def test_settings():
    assert Settings().collection == "documents_v2_ko" and Settings(version=" a/b ").safe_version == "a_b" and Settings(version="").safe_version == "v1"
    assert file_names("a, b,,") == ("a", "b") == file_names(["a", " b"]) and file_names(None) == ()
    found = Settings.of_environment({"FOLIOFORGE_LANGUAGE": "en", "FOLIOFORGE_BATCH_SIZE": "8", "FOLIOFORGE_FILE_NAMES": "x, y", "FOLIOFORGE_NAME": "n"}, name="given")
    assert (found.language, found.batch_size, found.file_names, found.name, found.version) == ("en", 8, ("x", "y"), "given", "v2")
    with pytest.raises(ValueError):
        Settings(distance="near")


def test_index_of_chunk_files(spark, tmp_path):
    chunk = lambda i, t, f: {"Context": t, "Context_id": f"{f}::{i}", "File_name": f, "Image_ids": [], "Table_ids": ["t1"], "Section_path": ["A"], "Is_image": False}
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a_chunked.json").write_text(json.dumps([chunk(1, "red apple", "a"), chunk(2, "red pear", "a"), chunk(3, "green pear", "b"), chunk(4, " ", "b")]))
    length = lambda: lambda ts: [[float(len(t))] for t in ts]
    many = lambda: lambda ts: [[[1.0], [2.0]] for _ in ts]
    c = indexing.build_index(spark, str(tmp_path / "in"), str(tmp_path / "out"), Settings(language="en"), {"": length}, {"en": many, "ko": length})
    rows = {r["payload"]["unique_id"]: r for r in c.read().collect()}
    assert set(rows) == {"a::1", "a::2", "b::3"} and all(r["late"] == [[1.0], [2.0]] for r in rows.values())
    assert rows["a::1"]["dense"] == [9.0] and rows["a::1"]["payload"]["metadata"]["Table_ids"] == ["t1"] and len(rows["a::2"]["sparse"]["indices"]) == 2
    assert [r["id"] for r in c.ids_of_file("b").collect()] == [rows["b::3"]["id"]]
    assert bm25.load(spark, f"{tmp_path}/out/documents_v2_en_bm25", "en").vocab.count() == 2
    one = indexing.build_index(spark, str(tmp_path / "in"), str(tmp_path / "out2"), Settings(language="en", file_names=("a",)))
    assert one.count() == 2


def test_model_hooks_on_images(spark):
    i = spark.createDataFrame([("d", "a.PNG", "x/a.PNG", "h1", 0), ("d", None, "x/b.png", "h2", 1), ("d", "c.jpg", "c.jpg", "h3", 2)], "doc_id string, filename string, saved_path string, content_sha256 string, ord int")
    assert {r["content_sha256"] for r in images.png_only(i).collect()} == {"h1", "h2"}
    cache = spark.createDataFrame([("h1", "ocr", "llm"), ("h1", "ocr", "llm")], "content_sha256 string, ocr_text string, llm_text string")
    assert {r["content_sha256"]: (r["ocr_text"], r["llm_text"]) for r in images.with_cached(i, cache).collect()} == {"h1": ("ocr", "llm"), "h2": (None, None), "h3": (None, None)}
    assert images.sample_images(i, 2, 1).count() == 2 and images.sample_images(i, 9).count() == 3
    raw = spark.createDataFrame([(1, "Here is: a cat"), (2, " "), (3, None)], "n int, llm_text string")
    assert {r["n"]: r["llm_text"] for r in images.described(raw).collect()} == {1: "image description: a cat", 2: None, 3: None}
    sparse = spark.createDataFrame([(([],),), (([3],),)], "s struct<indices:array<int>>")
    assert [sparse.filter(f).agg(models.has_sparse(F.col("s"))).first()[0] for f in ("true", "size(s.indices) = 0")] == [True, False]


def test_point_ids(spark):
    rows = spark.createDataFrame([(0, "f", "e", "o", "u"), (1, "f", "", "o", "u"), (2, "f", None, None, "u"), (3, "f", None, "", None), (4, "", None, None, None)], "n int, f string, e string, o string, u string")
    got = [r[0] for r in rows.orderBy("n").select(collection.point_id(F.col("f"), F.col("n"), F.col("e"), F.col("o"), F.col("u"))).collect()]
    assert got == ["e", "o", "u", "f_000003", "doc_000004"]


def test_fit_from_json_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text("\n".join(json.dumps({"context": t}) for t in ("a b", "a c", "a b", "")))
    assert {r["term"] for r in bm25.fit_json_lines(spark, str(tmp_path / "x.jsonl")).vocab.collect()} == {"b", "a_b"}


def test_collection_log(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "id string, n int").coalesce(1)
    c = collection.Collection(spark, str(tmp_path), "c", compact_after=3)
    c.create(rows)
    c.upsert(rows)
    before = c.read()
    other = collection.Collection(spark, str(tmp_path), "c")
    other.delete(spark.createDataFrame([("b",)], "id string"))
    c.upsert(spark.createDataFrame([("d", 4)], rows.schema))  # the third change: the table is made anew
    assert {r["id"]: r["n"] for r in c.read().collect()} == {"a": 3, "d": 4} and c._current()[1] == []
    assert {r["id"]: r["n"] for r in before.collect()} == {"a": 3, "b": 2}  # an open reader keeps its rows
    assert c.vacuum() == 0 and c.vacuum(older_than_seconds=-1) == 4 and c.count() == 2


def test_models(spark):
    df = spark.createDataFrame([("가나 다",), ("x",)], "t string")

    def analyser():
        return lambda t: {"x": ["m"]}[t]

    def none():
        raise ImportError

    assert sorted(r[0] for r in df.select(models.morphemes(F.col("t"), analyser)).collect()) == [["m"], ["가나", "가나", "다"]]
    assert sorted(r[0] for r in df.select(models.morphemes(F.col("t"), none)).collect()) == [["x"], ["가나", "가나", "다"]]
    body = json.loads(df.limit(1).select(models.caption_request(F.lit(b"png"), "m", "p")).first()[0])
    assert body == {"model": "m", "prompt": "p", "images": ["cG5n"], "stream": False}


def test_whole_document(spark, tmp_path):
    heads = spark.createDataFrame([("d", 0, 1, "A"), ("d", 2, 2, "B"), ("d", 5, 1, "C")], "doc_id string, pos long, level int, title string")
    tree = sections.section_tree(heads)
    assert {(r["section_id"], r["parent_id"], r["span_end"]) for r in tree.collect()} == {(0, None, 5), (2, 0, 5), (5, None, None)}
    blocks = spark.createDataFrame([("d", i, f"b{i}") for i in range(7)], "doc_id string, doc_index long, block_id string")
    meta = spark.createDataFrame([("d", "me")], "doc_id string, author string")
    out = json.loads(docjson.payload(tree, blocks, meta).first()["json"])
    assert out["version"] == "0.0.0" and out["metadata"] == {"author": "me"}
    assert {s["section_id"]: s["block_ids"] for s in out["sections"]} == {0: ["b0", "b1"], 2: ["b2", "b3", "b4"], 5: ["b5", "b6"]}
    images = spark.createDataFrame([('{"rid": "r1", "filename": "f"}',), ('{"rId": "r2"}',)], "json string")
    assert sorted(r["rId"] for r in docjson.parse_images(images).collect()) == ["r1", "r2"]
    docjson.write_pretty(images.limit(1), str(tmp_path / "x.json"))
    assert len(json.loads((tmp_path / "x.json").read_text())) == 1
