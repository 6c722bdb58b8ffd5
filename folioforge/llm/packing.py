"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of documents in the order of a hash of doc_id and text, so a document's place doesn't depend on files
or partitions.  A round fills one window of ``window`` sequences:
each backlogged source's counter gains its quantum (its weight's share of the window), the source sends as many whole
tokens as the counter holds, and the fraction that is left, the deficit, is carried to the next window.  A source that
runs out sends what it has, and the next window is shared by the others.  So what a source has sent after r windows is
known in closed form (:class:`Schedule`), and with the running sum of its queue every document's place is known without a
loop over windows, on any executor.  Windows follow each other, sources in order inside a window, and the stream is cut
into sequences of ``length`` ids: every window has the target proportions to the token, and only the very last sequence
is padded.  By default weights are the sources' own tokens, so all queues end with the last window.

Running sums are taken in two levels: inside blocks of bounded size, each a task's window, and over the few sums of the
blocks; so a source with a third of all rows is many tasks.  Ids are written once and meet their places in a sort-merge
join, which spills.  A row a source reaches the driver and every task, and a schedule costs the square of their number: it is
meant for up to some thousands of sources.

Defined cases: null text is an empty document (its end id alone); a null source is a queue of its own; rows that repeat
a doc_id are packed each (those that repeat the text, too, are alike); a text of any length is cut into as many pieces as
it needs, and is in memory with its ids while it is encoded; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, arrow_batches, own_columns, ship_package

#: Rows that one window task holds at most, about.
BLOCK_ROWS = 1 << 18
#: Rows of a batch of texts or ids, which is whole in memory.
BATCH_ROWS = 2000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def encoded(docs: DataFrame, path: str, end_id: int, max_chunks: int) -> DataFrame:
    """doc_id, source, text_hash, n (ids with the end id), ids (little-endian unsigned 32-bit, or 16-bit if all fit)."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from .tokens import encoder

        enc = encoder(path, max_chunks)
        kind = np.dtype("<u2" if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        for batch in batches:
            at = 0
            for ids, counts in enc.encode(batch.column(1), end_id):
                here = slice(at, at + len(counts))
                edges = np.concatenate([[0], np.cumsum(counts)]) * kind.itemsize
                data = pa.py_buffer(ids.astype(kind).tobytes())
                binary = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(edges.astype(np.int32).tobytes()), data])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[here], batch.column(2)[here], batch.column(3)[here], pa.array(counts, pa.int64()), binary], ["doc_id", "source", "text_hash", "n", "ids"]
                )
                at += len(counts)

    rows = own_columns(docs, "doc_id", "text", "source").withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return rows.mapInArrow(run, "doc_id bigint, source string, text_hash bigint, n bigint, ids binary")


def running(rows: DataFrame, group: list[str], block: str, order: list[str], value: str, out: str, scratch: Scratch) -> DataFrame:
    """Adds out: the sum of value over the rows before and at this one in its group, in order of (block, *order)."""
    line = Window.partitionBy(*group, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = scratch.table(rows.groupBy(*group, block).agg(F.sum(value).alias("__sum")))
    prior = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*(F.col(g).alias(f"__{g}") for g in group), F.col(block).alias("__block"), F.coalesce(F.sum("__sum").over(prior), F.lit(0)).alias("__before"))
    on = F.col(block) == F.col("__block")
    for g in group:
        on &= F.col(g).eqNullSafe(F.col(f"__{g}"))
    return rows.withColumn("__here", F.sum(value).over(line)).join(sums, on).withColumn(out, F.col("__here") + F.col("__before")).drop("__here", "__block", "__before", *(f"__{g}" for g in group))


class Schedule:
    """What each queue has sent after r windows; tokens and weights by queue, weights as whole numbers."""

    def __init__(self, tokens: list[int], weights: list[int], window_tokens: int):
        self.tokens = tokens
        # Phases (first window, what was sent before it, weights, their sum): a new one once a queue has run out.
        self.phases: list[tuple[int, list[int], list[int], int]] = []
        self.size = window_tokens
        r, sent = 0, [0] * len(tokens)
        while any(s < t for s, t in zip(sent, tokens, strict=True)):
            left = [w if s < t else 0 for s, t, w in zip(sent, tokens, weights, strict=True)]
            if not any(left):  # only queues of weight 0
                left = [int(s < t) for s, t in zip(sent, tokens, strict=True)]
            self.phases.append((r, sent, left, sum(left)))
            gain = [(t - s, w) for s, t, w in zip(sent, tokens, left, strict=True) if w]
            r += min(-(-need * sum(left) // (window_tokens * w)) for need, w in gain)
            sent = [self.sent(q, r) for q in range(len(tokens))]
        self.windows = r
        self.firsts = [p[0] for p in self.phases]

    def sent(self, queue: int, r: int) -> int:
        """Tokens that the queue has sent in windows 0 to r - 1."""
        at = bisect.bisect_right(self.firsts, r) - 1 if hasattr(self, "firsts") else len(self.phases) - 1
        first, base, weights, total = self.phases[max(0, at)]
        return min(self.tokens[queue], base[queue] + (r - first) * self.size * weights[queue] // total)

    @functools.lru_cache(maxsize=1 << 14)  # noqa: B019  one schedule a task
    def window(self, r: int) -> tuple[list[int], list[int]]:
        """By queue: place in the stream of its first token in window r, and tokens sent before it."""
        before = [self.sent(q, r) for q in range(len(self.tokens))]
        places, at = [], sum(before)
        for q, b in enumerate(before):
            places.append(at)
            at += self.sent(q, r + 1) - b
        return places, before

    def runs(self, queue: int, start: int, n: int):
        """(place in the stream, tokens) of the queue's tokens start to start + n, in order; neighbours are one run."""
        low, high = 0, self.windows
        while low < high:  # the window that sends token start
            mid = (low + high) // 2
            low, high = (mid + 1, high) if self.sent(queue, mid + 1) <= start else (low, mid)
        run = None
        while n:
            places, before = self.window(low)
            take = min(n, self.sent(queue, low + 1) - start)
            if take:
                at = places[queue] + start - before[queue]
                if run and sum(run) == at:
                    run = (run[0], run[1] + take)
                else:
                    if run:
                        yield run
                    run = (at, take)
                start, n = start + take, n - take
            low += 1
        if run:
            yield run


def queues(rows: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(key, queue, sent) with sent the queue's tokens up to the row's end; and (source, queue, tokens).

    Blocks are a few for each task of the shuffle, so the queue of a hot source is spread over as many tasks as its rows
    are worth; beyond BLOCK_ROWS rows a block there are more of them.
    """
    tasks = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block_rows = min(BLOCK_ROWS, max(64, rows.count() // tasks))
    everything = Window.partitionBy()
    sources = rows.groupBy("source").agg(F.sum("n").alias("tokens"), F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).alias("blocks"))
    sources = scratch.table(sources.withColumn("queue", F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1))
    luck = F.xxhash64(F.lit(5), "doc_id", "text_hash").bitwiseAND(F.lit((1 << 32) - 1))
    of = sources.withColumnRenamed("source", "of").drop("tokens")
    queued = rows.join(of, F.col("source").eqNullSafe(F.col("of"))).withColumn("luck", luck).withColumn("block", F.floor(F.col("luck") * F.col("blocks") / (1 << 32)))
    return running(queued, ["queue"], "block", ["luck", "doc_id", "text_hash", "key"], "n", "sent", scratch).select("key", "queue", "sent"), sources


def pack(docs: DataFrame, path: str, end_id: int = 1, length: int = 2048, window: int = 64, weights: dict[str | None, float] | None = None, max_chunks: int = 800_000) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    weights: target shares of sources in a window (a source that isn't named has none until the others have run out);
    if not given, each source's share of all tokens.  max_chunks: of the encoder's cache, some 200 bytes each in every worker.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        ids = scratch.table(encoded(docs, path, end_id, max_chunks).withColumn("key", F.monotonically_increasing_id()))
    place, sources = queues(ids.select("key", "doc_id", "text_hash", "source", "n"), scratch)
    place = scratch.table(place)
    # A row a source reaches the driver and the tasks.
    by_queue = sources.orderBy("queue").collect()
    tokens = [r["tokens"] for r in by_queue]
    whole = tokens if weights is None else [round(1e6 * weights.get(r["source"], 0.0)) for r in by_queue]
    window_tokens = window * length

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        schedule = Schedule(tokens, whole, window_tokens)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, n, data, queue, sent in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids", "queue", "sent")), strict=True):
                values = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")
                lo = 0
                for at, left in schedule.runs(queue, sent - n, n):
                    while left:
                        take = min(left, length - at % length)
                        out.append((doc_id, lo, take, zlib.crc32(values[lo : lo + take].tobytes()), n, at // length, at % length))
                        lo, at, left = lo + take, at + take, left - take
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], [c.split()[0] for c in PIECES.split(", ")])

    # At every size the join that spills: where places are few, Spark would hash them, and shuffle ids only in larger tables.
    joined = ids.select("key", "doc_id", "n", "ids").join(place.hint("merge"), "key")
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        return scratch.keep(joined.select("doc_id", "n", "ids", "queue", "sent").mapInArrow(run, PIECES))
