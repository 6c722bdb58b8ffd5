"""The BM25 queries run over every document, whatever its language."""

from folioforge.plans.queries import QUERIES, SQL


def test_documents_of_all_languages_and_of_none_are_found(spark, tmp_path):
    rows = [(1, "red apple pie", "en"), (2, "roter apfel kuchen", "de"), (3, "roter apfel saft", None), (4, None, "en"), (5, "green tea red", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(9, "Roter Apfel")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in run("bm25_search")} == {2, 3}
    assert {r["doc_id"] for r in run("en_tokens")} == {1, 2, 3, 5}
    assert {r["term"]: r["df"] for r in run("bm25_df")}["roter_apfel"] == 2


def test_no_query_filters_by_language():
    assert not any("lang = 'en'" in sql for sql in SQL.values())
