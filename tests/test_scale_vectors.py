"""Exact searches: as a walk over all pairs gives them, with odd vectors, and with no join of all pairs in the plan."""

import math
import random

import pytest

from folioforge.operators import vectors
from folioforge.plans.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def score(metric, a, b):
    if metric == "max_sim":
        return sum(max(score("dot", q, d) for d in b) for q in a)
    s = 0.0
    for x, y in zip(a, b):
        s += (x - y) * (x - y) if metric == "euclid" else x * y
    if metric == "euclid":
        return math.sqrt(s)
    if metric == "dot":
        return s
    norm = math.sqrt(score("dot", a, a)) * math.sqrt(score("dot", b, b))
    return s / norm if norm else math.nan


def walk(metric, corpus, queries, k):
    out = set()
    for i, q in queries:
        found = [(score(metric, q, v), j) for j, v in corpus]
        order = lambda x: (not math.isnan(x[0]), x[0] if metric == "euclid" else -x[0], x[1]) if not math.isnan(x[0]) else (False, 0, x[1])
        out |= {(i, j, n + 1, str(s)) for n, (s, j) in enumerate(sorted(found, key=order)[:k])}
    return out


def rows_of(df, key="vec_id"):
    return {(r["query_id"], r[key], r["rank"], str(r["score"])) for r in df.collect()}


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclid"])
def test_as_all_pairs(spark, monkeypatch, metric):
    """To the last bit, with many equal, parallel and empty vectors, in several blocks and parts."""
    monkeypatch.setattr(vectors, "PART_NUMBERS", 256)
    r = random.Random(5)
    some = [[float(r.randint(-3, 3)) * 0.25 for _ in range(4)] for _ in range(60)]
    corpus = [(i, [float(x) for x in r.choice(some)]) for i in range(400)] + [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(90)] + [(2000, [0.0] * 4)]
    queries = [(i, v) for i, v in corpus if i % 7 == 0]
    c = spark.createDataFrame(corpus, SCHEMA)
    q = spark.createDataFrame(queries, "query_id long, query array<float>")
    assert rows_of(vectors.top_k(c, q, metric, 5, block=20)) == walk(metric, corpus, queries, 5)


def test_late_interaction_of_lists_of_several_lengths(spark):
    r = random.Random(6)
    vector = lambda: [round(r.uniform(-1, 1) * 64) / 64 for _ in range(3)]
    corpus = [(i, [vector() for _ in range(r.randint(1, 6))]) for i in range(50)]
    corpus += [(100 + i, corpus[3][1]) for i in range(8)]
    queries = [(i, v) for i, v in corpus if i % 5 == 0]
    c = spark.createDataFrame(corpus, "doc_id long, vectors array<array<double>>")
    q = spark.createDataFrame(queries, "query_id long, query array<array<double>>")
    assert rows_of(vectors.top_k(c, q, "max_sim", 4, "doc_id", "vectors", block=10), "doc_id") == walk("max_sim", corpus, queries, 4)


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclid"])
def test_rows_without_a_score_come_last(spark, metric):
    corpus = [(1, None), (2, [1.0, 0.0]), (3, [1.0, None]), (4, [0.5, 0.5]), (5, [1.0]), (6, [1.0, 1.0, 1.0])]
    c = spark.createDataFrame(corpus, SCHEMA)
    q = spark.createDataFrame([(0, [1.0, 0.0]), (9, [1.0])], "query_id long, query array<float>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in vectors.top_k(c, q, metric, 6).collect()}
    assert [got[0, n + 1] for n in range(6)] == [2, 4, 1, 3, 5, 6]
    assert [got[9, n + 1] for n in range(6)] == [5, 1, 2, 3, 4, 6]


@pytest.mark.parametrize("name", ["cosine_topk", "dot_topk", "euclid_topk", "hybrid_rrf", "maxsim_topk"])
def test_pairs_are_not_rows(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "FlatMapCoGroupsInArrow" in plan
