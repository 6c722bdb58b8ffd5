"""From chunk files to a searchable collection: BM25 model, sparse, dense and late-interaction vectors, points."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .operators import bm25, vectors
from .operators.collection import Collection, points
from .sources.files import read_chunks

#: A model: made once a task, it gives the function of a list of texts.
Model = Callable[[], Callable[[list[str]], list]]


def chunk_points(spark: SparkSession, base: str, settings: Settings) -> DataFrame:
    """id, payload and text of the chunks below base that the settings' file names want; without names, all."""
    chunks = read_chunks(spark, base)
    if settings.file_names:
        chunks = chunks.filter(F.col("metadata.File_name").isin(*settings.file_names))
    flat = chunks.select(F.col("text").alias("Context"), "metadata.*")
    return points(flat, "Context", "Context_id").withColumn("text", F.col("payload.content"))


def model_for(models: Mapping[str, Model], language: str) -> Model | None:
    """The model of a language, or the one for all of them (key "")."""
    return models.get(language, models.get(""))


def build_index(spark: SparkSession, base: str, target: str, settings: Settings, dense: Mapping[str, Model] | None = None, late: Mapping[str, Model] | None = None) -> Collection:
    """Fits and saves the BM25 model of the chunks below base, and makes the collection of their points in target.

    dense and late: models by language.  Late-interaction vectors, which are many a text, are added by an update of their
    own, as the points are of use without them.
    """
    rows = chunk_points(spark, base, settings).persist()
    try:
        model = bm25.fit(rows, bm25.Params(language=settings.language), key="id")
        bm25.save(model, f"{target}/{settings.collection}_bm25")
        model = bm25.load(spark, f"{target}/{settings.collection}_bm25", settings.language)
        sparse = bm25.transform(rows, model, key="id").withColumnRenamed("doc_id", "id")
        out = rows.join(sparse, "id")
        if encoder := model_for(dense or {}, settings.language):
            out = vectors.encode(out, encoder, batch_size=settings.batch_size)
        else:
            out = out.withColumn("dense", F.lit(None).cast("array<float>"))
        out = out.withColumn("late", F.lit(None).cast("array<array<float>>")).drop("text")
        collection = Collection(spark, target, settings.collection, settings.distance)
        collection.create(out)
        collection.upsert(out)
        if encoder := model_for(late or {}, settings.language):
            each = vectors.encode(rows.select("id", "text"), encoder, out="late", kind="array<array<float>>", batch_size=settings.late_interaction_batch_size)
            collection.update_vectors(each.select("id", "late"), "late")
        return collection
    finally:
        rows.unpersist()
