"""Token ids as Arrow files with fixed-size-list batches: zero-copy random access to equal-length sequences and masks.

A part is the documents of one range of (doc_id, hash of the text), in ascending order, encoded in one task; there are as
many parts as PART_BYTES of text.  It is two Arrow IPC files in the target folder:

* ``part-NNNNN.tokens.arrow``: batches of (ids: fixed_size_list<uint16 or uint32>[sequence_length], mask:
  fixed_size_list<bool>[sequence_length]); the part's ids one after the other, the last sequence padded with mask false;
* ``part-NNNNN.docs.arrow``: (doc_id, start, n_tokens), where start counts the part's ids before the document.

Files are written under a name of the attempt and renamed when whole, so a task that is lost and run again, or twice,
leaves the same files.  The parts' ranges ascend, so the running sum of their sizes gives every document's place in
the whole.  Only one shuffle is needed, of the texts by doc_id range.

Defined cases: null text has only the end id; null doc_ids come first; rows that repeat a doc_id follow each other in the
order of their texts' hash, and may go to several parts (those that repeat the text, too, are alike), so places are the same in
every run; a text of any length is one document of one part, in memory with its ids while it is encoded; an empty table
leaves no parts; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, own_columns, ship_package

BATCH_SEQUENCES = 1024
#: Bytes of text that a part has, about, unless more parts are needed for all tasks to have one.
PART_BYTES = 64 << 20
PARTS = "part bigint, tokens_file string, docs_file string, n_docs bigint, n_tokens bigint"


def _folder(uri: str):
    """(pyarrow file system, path) of a folder's URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def _write_part(uri: str, part: int, attempt: str, batches: Iterator, path: str, end_id: int, length: int):
    """Writes the files of one part; returns its row of PARTS."""
    import numpy as np
    import pyarrow as pa

    from .tokens import encoder

    system, folder = _folder(uri)
    enc = encoder(path)
    id_type = pa.uint16() if max(enc.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else pa.uint32()
    schema = pa.schema([("ids", pa.list_(id_type, length)), ("mask", pa.list_(pa.bool_(), length))])
    doc_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
    names = [f"part-{part:05d}.{kind}.arrow" for kind in ("tokens", "docs")]
    drafts = [f"{folder}/.{attempt}-{name}" for name in names]
    system.create_dir(folder, recursive=True)
    held, start, docs = np.zeros(0, id_type.to_pandas_dtype()), 0, 0

    def batch(ids, mask):
        lists = (pa.FixedSizeListArray.from_arrays(pa.array(x, t), length) for x, t in ((ids, id_type), (mask, pa.bool_())))
        return pa.RecordBatch.from_arrays(list(lists), schema=schema)

    with system.open_output_stream(drafts[0]) as out, system.open_output_stream(drafts[1]) as doc_out:
        with pa.ipc.new_file(out, schema) as writer, pa.ipc.new_file(doc_out, doc_schema) as doc_writer:
            for rows in batches:
                at = 0
                for ids, counts in enc.encode(rows.column("text"), end_id):
                    held = np.concatenate([held, ids.astype(held.dtype)])
                    while len(held) >= length * BATCH_SEQUENCES:
                        now, held = held[: length * BATCH_SEQUENCES], held[length * BATCH_SEQUENCES :]
                        writer.write_batch(batch(now, np.ones(len(now), bool)))
                    starts = start + np.cumsum(counts) - counts
                    doc_writer.write_batch(pa.RecordBatch.from_arrays([rows.column("doc_id")[at : at + len(counts)], pa.array(starts), pa.array(counts)], schema=doc_schema))
                    start, docs, at = start + int(counts.sum()), docs + len(counts), at + len(counts)
            if len(held):
                whole = -(-len(held) // length) * length
                ids, mask = np.zeros(whole, held.dtype), np.zeros(whole, bool)
                ids[: len(held)], mask[: len(held)] = held, True
                writer.write_batch(batch(ids, mask))
    for draft, name in zip(drafts, names, strict=True):
        system.move(draft, f"{folder}/{name}")
    return part, *(f"{uri}/{name}" for name in names), docs, start


class SequenceFile:
    """Random access to the sequences of a tokens file; memory-mapped, hence without a copy, where the store is local."""

    def __init__(self, uri: str):
        import pyarrow as pa

        system, path = _folder(uri)
        source = pa.memory_map(path) if system.type_name == "local" else system.open_input_file(path)
        self.reader = pa.ipc.open_file(source)
        self.length = self.reader.schema.field("ids").type.list_size

    def __len__(self) -> int:
        n = self.reader.num_record_batches
        return (n - 1) * BATCH_SEQUENCES + self.reader.get_batch(n - 1).num_rows if n else 0

    def column(self, batch: int, name: str):
        """All values of a batch's column, as an Arrow array on the file's bytes."""
        array = self.reader.get_batch(batch).column(name)
        return array.values.slice(array.offset * self.length, len(array) * self.length)

    def sequence(self, i: int):
        """(ids, mask) of sequence i, as views: a NumPy array, and an Arrow array of bits."""
        batch, at = i // BATCH_SEQUENCES, i % BATCH_SEQUENCES * self.length
        return self.column(batch, "ids").slice(at, self.length).to_numpy(zero_copy_only=True), self.column(batch, "mask").slice(at, self.length)

    def tokens(self, start: int, n: int):
        """n ids from the start-th on."""
        import numpy as np

        step, found = BATCH_SEQUENCES * self.length, []
        while n > 0:
            here = self.column(start // step, "ids").slice(start % step, n).to_numpy(zero_copy_only=True)
            found.append(here)
            start, n = start + len(here), n - len(here)
        return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, np.uint16), *found])


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = 2, length: int = 2048, parts: int | None = None) -> DataFrame:
    """Writes the parts of docs to folder (a URI that all executors reach); one row of PARTS each, not yet run."""
    ship_package(docs.sparkSession)
    base = own_columns(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), F.monotonically_increasing_id().alias("row"))
    if parts is None:
        total = base.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_hash"), F.col("row")]
    ordered = base.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator) -> Iterator:
        import itertools

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        some = next((b for b in batches if b.num_rows), None)
        if some is None:
            return
        row = _write_part(folder, task.partitionId(), f"{task.stageId()}-{task.taskAttemptId()}", itertools.chain([some], batches), path, end_id, length)
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string() if isinstance(x, str) else pa.int64()) for x in row], [c.split()[0] for c in PARTS.split(", ")])

    return ordered.mapInArrow(run, PARTS)


def read_documents(parts: DataFrame) -> DataFrame:
    """One row per document, read from the files: doc_id, start (ids before it, over all parts), n_tokens, ids_crc32."""
    ship_package(parts.sparkSession)
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    todo = parts.select("tokens_file", "docs_file", before.alias("before")).repartition(max(1, parts.count()))  # a task a part

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                tokens = SequenceFile(row["tokens_file"])
                system, path = _folder(row["docs_file"])
                with system.open_input_file(path) as source:
                    for i in range((reader := pa.ipc.open_file(source)).num_record_batches):
                        docs = reader.get_batch(i)
                        starts, counts = (docs.column(c).to_pylist() for c in ("start", "n_tokens"))
                        crc = [zlib.crc32(tokens.tokens(s, n).astype("<u4").tobytes()) for s, n in zip(starts, counts, strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [docs.column("doc_id"), pa.array([s + row["before"] for s in starts], pa.int64()), docs.column("n_tokens"), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
                        )

    return todo.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_round_trip(docs: DataFrame, path: str, end_id: int = 2, length: int = 2048) -> DataFrame:
    """Writes all documents to the shared folder, reads the files back, and drops them."""
    scratch = Scratch(docs.sparkSession, "arrow_tokens")
    parts = scratch.table(write_tokens(docs, f"{scratch.root}/arrow", path, end_id, length))
    return scratch.keep(read_documents(parts))
