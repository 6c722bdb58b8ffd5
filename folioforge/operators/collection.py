"""A collection of points (id, vector, payload) as Parquet files in one folder, with keyed upsert, update and delete.

There is no table format here that edits rows, so a collection is a log of changes: each writes its own rows only, to a
folder of its own, and is then published as the log's next file, which is made by a rename that fails if another writer
took the number (the change then takes the next one).  Readers fold the changes, by anti-joins on their ids, over the last
whole table; after ``compact_after`` changes a writer folds them into a new one.  What a reader has opened stays: folders that
the log no longer needs go only in :meth:`Collection.vacuum`.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import text_or_empty


def upserted(existing: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """existing with the rows of new in place of those of the same key; of several new rows of a key, the last counts."""
    new = last_of_each(new, key)
    return existing.join(new.select(key), key, "left_anti").unionByName(new)


def last_of_each(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows of a key, the last one in the order of the rows; pre-aggregated, so a key of many rows isn't a hot one."""
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    found = rows.groupBy(F.col(key).alias("__key")).agg(F.max_by(whole, F.col("__place")).alias("__row")) if "__place" in rows.columns else None
    if found is None:
        return last_of_each(rows.withColumn("__place", F.monotonically_increasing_id()), key).select(*(F.col(f"`{c}`") for c in rows.columns))
    return found.select("__row.*")


def ids_of_file(rows: DataFrame, file_name: str, column: str = "payload.metadata.File_name") -> DataFrame:
    return rows.filter(F.col(column) == file_name).select("id")


def counted(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n"))


def deleted(existing: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    return existing.join(ids.select(key), key, "left_anti")


def updated(existing: DataFrame, vectors: DataFrame, column: str, key: str = "id") -> DataFrame:
    """existing with column replaced where vectors (key, column) has the key."""
    new = last_of_each(vectors.select(key, F.col(column).alias("__new")), key)
    return existing.join(new, key, "left").withColumn(column, F.coalesce("__new", column)).select(*existing.columns)


def point_id(file_name: Column, ordinal: Column, external_id: Column | None = None, own_id: Column | None = None, unique_id: Column | None = None) -> Column:
    """The first id that a document has of external_id, id and unique_id; else one made of its file and place."""
    none = F.lit(None).cast("string")
    given = (F.nullif(c.cast("string"), F.lit("")) if c is not None else none for c in (external_id, own_id, unique_id))
    made = F.concat(F.coalesce(F.nullif(file_name, F.lit("")), F.lit("doc")), F.format_string("_%06d", ordinal))
    return F.coalesce(*given, made)


def points(docs: DataFrame, content: str = "Context", unique_id: str = "Context_id", vectors: Sequence[str] = ()) -> DataFrame:
    """id (a UUID made of the unique id, so a rerun gives the same), vector struct, payload struct<content, unique_id, metadata>."""
    h = F.md5(text_or_empty(F.col(unique_id)))
    uid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("4"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    rest = [c for c in docs.columns if c not in (content, unique_id, *vectors)]
    payload = F.struct(F.col(content).alias("content"), F.col(unique_id).alias("unique_id"), F.struct(*rest).alias("metadata"))
    return docs.select(uid.alias("id"), *([F.struct(*vectors).alias("vector")] if vectors else []), payload.alias("payload"))


class Collection:
    """A named collection below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str, name: str, distance: str = "Cosine", compact_after: int = 16, **properties):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{name}"
        self.properties, self.compact_after = {"distance": distance, **properties}, compact_after

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _log(self) -> list[dict]:
        """The changes so far, by number."""
        fs, p = self._fs(f"{self.path}/log")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        names = sorted(n for n in names if n.endswith(".json") and not n.startswith("."))
        if not names:
            return []
        lines = self.spark.read.text([f"{self.path}/log/{n}" for n in names]).collect()
        return sorted((json.loads(r[0]) for r in lines), key=lambda c: c["number"])

    def _publish(self, change: dict) -> None:
        """Adds a change under the next free number."""
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs(self.path)[1].toUri(), self.spark._jsc.hadoopConfiguration())
        rename = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        number = len(self._log())
        while True:
            fs, draft = self._fs(f"{self.path}/log/.{uuid.uuid4().hex}")
            out = fs.create(draft, True)
            out.write(bytearray(json.dumps({"number": number, **self.properties, **change}).encode()))
            out.close()
            _, place = self._fs(f"{self.path}/log/{number:08d}.json")
            try:
                context.rename(draft, place, options)
                return
            except Exception:  # another writer was first  # noqa: BLE001
                fs.delete(draft, True)
                if not fs.exists(place):
                    raise
                number += 1

    def _written(self, rows: DataFrame) -> str:
        folder = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/{folder}")
        return folder

    def _current(self) -> tuple[dict, list[dict]]:
        """The last whole table, and the changes to it."""
        log = self._log()
        if not log:
            raise ValueError(f"there is no collection at {self.path}")
        base = max((c for c in log if c["change"] == "table"), key=lambda c: (c["up_to"], c["number"]))
        return base, [c for c in log if c["change"] != "table" and c["number"] > base["up_to"]]

    def exists(self) -> bool:
        return bool(self._log())

    def create(self, empty: DataFrame) -> None:
        """A collection of the schema of ``empty``, in place of one of that name."""
        self.drop()
        self._publish({"change": "table", "folder": self._written(empty.limit(0)), "up_to": -1})

    def drop(self) -> None:
        fs, p = self._fs(self.path)
        fs.delete(p, True)

    def read(self) -> DataFrame:
        base, changes = self._current()
        open_ = lambda c: self.spark.read.parquet(f"{self.path}/{c['folder']}")
        rows = open_(base)
        for c in changes:
            new = open_(c)
            rows = upserted(rows, new) if c["change"] == "upsert" else deleted(rows, new) if c["change"] == "delete" else updated(rows, new, c["column"])
        return rows

    def _change(self, rows: DataFrame, **what) -> None:
        self._publish({"folder": self._written(rows), **what})
        if len(self._current()[1]) >= self.compact_after:
            self.compact()

    def compact(self) -> None:
        """Folds the changes into a new table; changes that others publish meanwhile come after it."""
        base, changes = self._current()
        self._publish({"change": "table", "folder": self._written(self.read() if changes else self.spark.read.parquet(f"{self.path}/{base['folder']}")), "up_to": max([base["up_to"], *(c["number"] for c in changes)])})

    def vacuum(self, older_than_seconds: float = 7 * 86400) -> int:
        """Deletes the folders that the current rows don't need and that are older than that; how many went."""
        base, changes = self._current()
        needed, before = {base["folder"], "log", *(c["folder"] for c in changes)}, (time.time() - older_than_seconds) * 1000
        fs, p = self._fs(self.path)
        gone = [f.getPath() for f in fs.listStatus(p) if f.getPath().getName() not in needed and f.getModificationTime() <= before]
        for path in gone:
            fs.delete(path, True)
        return len(gone)

    def upsert(self, new: DataFrame) -> None:
        self._change(last_of_each(new, "id"), change="upsert")

    def update_vectors(self, vectors: DataFrame, column: str) -> None:
        self._change(vectors.select("id", column), change="update", column=column)

    def delete(self, ids: DataFrame) -> int:
        """Deletes by id; how many rows went."""
        gone = self.read().join(ids.select("id").distinct(), "id", "left_semi").count()
        self._change(ids.select("id").distinct(), change="delete")
        return gone

    def count(self) -> int:
        return counted(self.read()).first()["n"]

    def ids_of_file(self, file_name: str, column: str = "payload.metadata.File_name") -> DataFrame:
        return ids_of_file(self.read(), file_name, column)
