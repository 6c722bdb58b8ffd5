"""Two readings of many documents: each document's rows as align matches them, with one shuffle and no group in Python."""

import random

import pytest

from folioforge.operators import paragraphs


@pytest.mark.parametrize("size", ["4", "10000"])
def test_documents_are_aligned_one_by_one(spark, size):
    r = random.Random(4)
    text = lambda: r.choice([None, "", "a b", "B", "ab c", "x [image:r1]", "long line of words", f"n{r.randint(0, 5)}"])
    first = [(d, i, text()) for d in range(40) if d % 7 for i in r.sample(range(50), r.randint(1, 8))]
    second = [(d, i, i + 1, text()) for d in range(40) if d % 5 for i in r.sample(range(50), r.randint(1, 8))]
    a, b = spark.createDataFrame(first, "doc_id int, ord long, text string"), spark.createDataFrame(second, "doc_id int, ord long, doc_index long, text string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        got = sorted(map(tuple, paragraphs.merge_sources(a, b).collect()), key=lambda x: x[:2])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = []
    for d in range(40):
        left = sorted(x[1:] for x in first if x[0] == d)
        right = sorted(x[1:] for x in second if x[0] == d)
        hits = paragraphs.align([x[1] for x in left], [x[2] for x in right])
        expected += [(d, *x, *((None, None) if h is None else left[h])) for x, h in zip(right, hits)]
    assert got == expected


def test_one_shuffle(spark):
    df = spark.createDataFrame([(1, 0, 0, "x")], "doc_id long, ord long, doc_index long, text string")
    plan = paragraphs.merge_sources(df, df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "FlatMap" not in plan
