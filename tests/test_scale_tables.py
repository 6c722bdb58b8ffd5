"""Tables laid out in one pass: as a walk over one table gives them, over any cut of batches, and with one shuffle."""

import random

import pyarrow as pa
import pytest

from folioforge.operators import layout, tables
from folioforge.plans.queries import QUERIES

SCHEMA = "doc_id long, tid string, r int, cell_no int, text string, colspan int, vmerge string, images array<string>, styled boolean"


def walk(rows, fill):
    """(r, c) -> (text, styled), and (r, cell_no) -> (c, rowspan), of one table's rows of (cell_no, text, span, merge, styled)."""
    start, cover, n_rows = {}, {}, max(rows) + 1
    for r, line in rows.items():
        c = 0
        for no, text, span, merge, styled in sorted(line):
            start[r, no] = c, max(1, span or 1), merge, text, styled
            for x in range(c, c + max(1, span or 1)):
                cover[r, x] = r, no
            c += max(1, span or 1)
    n_cols = max(c for _, c in cover) + 1
    goes_on = lambda r, c: (r, c) in cover and start[cover[r, c]][2] == "continue"
    spans, grid = {}, {}
    for (r, no), (c, span, merge, _, _) in start.items():
        stop = min(next((x for x in range(r + 1, n_rows) if not goes_on(x, col)), n_rows) for col in range(c, c + span))
        spans[r, no] = c, stop - r if merge in ("restart", "") else 1
    for r in range(n_rows):
        for c in range(n_cols):
            own = start.get(cover.get((r, c)))
            above = [at for at, (c0, n) in spans.items() if n > 1 and at[0] < r < at[0] + n and c0 <= c < c0 + start[at][1]]
            source = start[max(above)] if above else None
            text = source[3] if source and (fill or own is None) else own[3] if own else ""
            grid[r, c] = text, bool(source[4] if source else own[4] if own else False)
    return spans, grid


def odd_tables(seed=3):
    r, out = random.Random(seed), {}
    for doc in range(60):
        lines = sorted(r.sample(range(9), r.randint(1, 6)))
        out[doc] = {i: [(n, f"t{r.randint(0, 9)} b", r.choice([None, 0, 1, 1, 2, 3]), r.choice([None, "", "restart", "continue", "continue"]), r.random() < 0.6) for n in range(r.randint(1, 4))] for i in lines}
    return out


def frame(spark, found):
    rows = [(d, "t", i, n, text, span, merge, None if n % 2 else [], styled) for d, rows in found.items() for i, line in rows.items() for n, text, span, merge, styled in line]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("fill", [False, True])
@pytest.mark.parametrize("size", ["3", "10000"])
def test_as_a_walk(spark, fill, size):
    found = odd_tables()
    expected = {d: walk(rows, fill) for d, rows in found.items()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        g, a = tables.grid(frame(spark, found), fill).collect(), tables.anchors(frame(spark, found)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(x["doc_id"], x["r"], x["c"]): (x["text"], x["styled"]) for x in g} == {(d, *at): v for d, (_, grid) in expected.items() for at, v in grid.items()}
    assert {(x["doc_id"], x["r"], x["cell_no"]): (x["c"], x["rowspan"]) for x in a} == {(d, *at): v for d, (spans, _) in expected.items() for at, v in spans.items()}
    assert len(g) == sum(len(grid) for _, grid in expected.values()) and len(a) == sum(len(spans) for spans, _ in expected.values())


def test_whole_tables_over_batches():
    batch = lambda *x: pa.RecordBatch.from_arrays([pa.array([i for i, _ in x]), pa.array([f for _, f in x])], names=["i", "first"])
    cut = layout.whole_tables(iter([batch((0, True), (1, False)), batch((2, False)), batch((3, True), (4, False), (5, True)), batch((6, True))]), "first")
    assert [t["i"].to_pylist() for t in cut] == [[0, 1, 2, 3, 4], [5], [6]]


@pytest.mark.parametrize("name", ["table_grid", "table_anchors", "table_header", "table_html", "table_context_rows"])
def test_one_shuffle_and_no_join(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange") == 1 and "Join" not in plan
