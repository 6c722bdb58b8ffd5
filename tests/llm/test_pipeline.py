"""The pipeline as a whole, against the stages done by hand."""

import os
from collections import Counter, defaultdict

import pytest
from test_llm_operators import CLASHES, FOLDER, ROWS, brute_mix, components, encoded, rank_order, texts

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def by_hand(rows):
    """doc_id -> how often it is in the packed sequences, and its text; rows (doc_id, text, lang, source), ids without repeats."""
    language = dict(rank_order([r[:3] for r in rows]))
    rows = [r for r in rows if language[r[0]][0] != "und"]
    last = {}
    for r in rows:
        last[r[1]] = max(r[0], last.get(r[1], r[0]))
    rows = [r for r in rows if last[r[1]] == r[0]]
    rows = [r for r, (d, _, root) in zip(rows, components(rows, 5, 80)[0], strict=True) if d == root]
    _, taken = brute_mix(rows)
    return {r[0]: (taken[n] // max(1, len(r[1].split())), r[1]) for n, r in enumerate(rows)}


def packed(got):
    at, ids = defaultdict(int), Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]]
        at[r["sequence_id"]] += r["length"]
        ids[r["doc_id"]] += r["length"]
    assert all(n == 2048 for q, n in at.items() if q < len(at) - 1)
    return ids


def test_run(spark):
    if not os.path.isdir(FOLDER):
        pytest.skip("no tables here")
    rows = [tuple(r) for r in texts(spark.read.parquet(f"{FOLDER}/documents.parquet")).values()]
    want = {d: n * len(encoded(t, 1)) for d, (n, t) in by_hand(rows).items() if n}
    assert packed(corpus_pipeline.run(spark, FOLDER).collect()) == want


@pytest.mark.parametrize("some", [ROWS, []])
def test_awkward_and_empty_tables(spark, tmp_path, some):
    df = spark.createDataFrame(some, "doc_id long, text string, lang string, source string")
    df.selectExpr("*", *(f"'clash' as {c}" for c in CLASHES)).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert not some or docs.count() > 0
    ids = packed(corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert set(ids) == {r["doc_id"] for r in docs.collect()} and bool(ids) == bool(some)
    assert not set(ids) & {2, 3, 4, 9, 11, 1, 6}  # no language; copies of 7
