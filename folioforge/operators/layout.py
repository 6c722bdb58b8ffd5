"""The places of table cells, for many tables at once, in NumPy: every step is linear in cells and places.

Tables come as rows of cells, sorted by table, row and cell; ``first`` is true where a table begins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NONE = -1


def whole_tables(batches: Iterator[pa.RecordBatch], first: str) -> Iterator[pa.Table]:
    """The batches cut anew, so that each has whole tables only."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        begins = np.flatnonzero(batch.column(batch.schema.get_field_index(first)).to_numpy(zero_copy_only=False))
        if len(begins):
            if held or begins[-1] > 0:
                yield pa.concat_tables([*held, t.slice(0, begins[-1])])
            held = []
            t = t.slice(begins[-1])
        held.append(t)
    if held:
        yield pa.concat_tables(held)


def running(lengths: np.ndarray) -> np.ndarray:
    """Where stretches of these lengths begin, and where the last one ends."""
    return np.concatenate(([0], np.cumsum(lengths)))


def lists(lengths: np.ndarray, fields: dict[str, pa.Array]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(running(lengths), pa.int32()), pa.StructArray.from_arrays(list(fields.values()), names=list(fields)))


def where_each(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For stretches of these lengths: the stretch of every element and its place there."""
    of = np.repeat(np.arange(len(lengths)), lengths)
    return of, np.arange(len(of)) - running(lengths)[:-1][of]


def take(a: pa.Array, at: np.ndarray) -> pa.Array:
    """Elements by place; null where it is NONE."""
    return a.take(pa.array(np.maximum(at, 0), mask=at == NONE)) if len(a) else pa.nulls(len(at), a.type)


def lay_out(cells: pa.Table, first: str, key: tuple[str, ...], want: tuple[str, ...], fill: bool) -> pa.RecordBatch:
    """One row per table: its key, n_rows, n_cols, and of its anchors and places (r, c) those that are wanted."""
    col = {n: cells[n].combine_chunks() for n in cells.column_names}
    flat = lambda n, kind: col[n].to_numpy(zero_copy_only=False).astype(kind)
    begins = flat(first, bool)
    starts = np.flatnonzero(begins)
    table = np.cumsum(begins) - 1
    r, span = flat("r", np.int64), flat("colspan", np.int64)
    vmerge = lambda kind: pc.fill_null(pc.equal(col["vmerge"], kind), False).to_numpy(zero_copy_only=False)
    goes_on, restart = vmerge("continue"), vmerge("restart")

    # A cell's first column: the spans before it in its row.
    new_row = begins | np.concatenate(([True], r[1:] != r[:-1]))
    before = np.cumsum(span) - span
    c = before - before[np.flatnonzero(new_row)][np.cumsum(new_row) - 1]
    n_cells = np.diff(np.append(starts, len(r)))
    n_rows, n_cols = r[starts + n_cells - 1] + 1, np.maximum.reduceat(c + span, starts)

    # Places stand column by column, so that a vertical span is a stretch; it ends before the next place not continued.
    base = running(n_rows * n_cols)
    cell, shift = where_each(span)
    t = table[cell]
    place = base[t] + (c[cell] + shift) * n_rows[t] + r[cell]
    own = np.full(base[-1], NONE)
    own[place] = cell
    ends = np.where((own != NONE) & goes_on[own], base[-1], np.arange(base[-1]))
    after = np.append(np.minimum.accumulate(ends[::-1])[::-1], base[-1])[1:]
    stop = np.minimum(after[place] - (place - r[cell]), n_rows[t])
    rowspan = np.where(restart, np.minimum.reduceat(stop, running(span)[:-1]) - r, 1)

    number = lambda x: pa.array(x, pa.int32())
    out = {n: col[n].take(pa.array(starts)) for n in key} | {"n_rows": number(n_rows), "n_cols": number(n_cols)}
    if "anchors" in want:
        out["anchors"] = lists(n_cells, {"r": number(r), "cell_no": col["cell_no"], "c": number(c), "text": col["text"], "colspan": number(span), "vmerge": col["vmerge"], "rowspan": number(rowspan), "images": col["images"], "styled": col["styled"]})
    if "places" in want:
        # The cell that goes on to a place is the last one above that spans rows, if it reaches so far: cells between are continued.
        tall = (own != NONE) & (rowspan[own] > 1)
        last = np.maximum.accumulate(np.where(tall, np.arange(base[-1]), NONE))
        of, n = where_each(n_rows * n_cols)
        row, column = n // n_cols[of], n % n_cols[of]
        at = base[of] + column * n_rows[of] + row
        mine, above = own[at], last[at]
        reaches = (above >= at - row) & (above != at)
        above_cell = np.where(reaches, own[above], NONE)
        above_cell = np.where((above_cell != NONE) & (r[above_cell] + rowspan[above_cell] > row), above_cell, NONE)
        text = take(col["text"], np.where((above_cell != NONE) & (fill | (mine == NONE)), above_cell, mine))
        either = lambda n, blank: pc.fill_null(pc.coalesce(take(col[n], above_cell), take(col[n], mine)), blank)
        images = take(col["images"], np.where((above_cell != NONE) & (~col["images"].is_null().to_numpy(zero_copy_only=False))[above_cell], above_cell, mine))
        shown = (mine != NONE) & (column == c[mine]) & ~goes_on[mine]
        begun = lambda x: pa.array(x[mine].astype(np.int32), mask=~shown)
        out["places"] = lists(n_rows * n_cols, {"r": number(row), "c": number(column), "text": pc.fill_null(text, ""), "images": images, "styled": either("styled", False), "colspan": begun(span), "rowspan": begun(rowspan)})
    return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))
