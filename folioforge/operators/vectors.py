"""Dense and multi-vector similarity, exact top-k, and rank fusion."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shipping import ship_package
from . import nearest


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Not a number if a vector has no length, as in SQL (Spark's division would fail)."""
    both = norm(a) * norm(b)
    return F.when(both == 0, F.when(dot(a, b).isNotNull(), F.lit(float("nan")))).otherwise(dot(a, b) / both)


def euclid(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0))), F.lit(0.0), lambda s, x: s + x))


def max_sim(query: Column, doc: Column) -> Column:
    """Late interaction: the sum, over the query's vectors, of the greatest dot product with one of the document's."""
    return F.aggregate(F.transform(query, lambda q: F.array_max(F.transform(doc, lambda d: dot(q, d)))), F.lit(0.0), lambda s, x: s + x)


METRICS: dict[str, tuple[Callable[[Column, Column], Column], bool]] = {"cosine": (cosine, True), "dot": (dot, True), "euclid": (euclid, False), "max_sim": (max_sim, True)}

#: Parts of a corpus that isn't small, at least; and about the most numbers in the vectors of one.
PARTS, PART_NUMBERS = 24, 1 << 21


def top_k(corpus: DataFrame, queries: DataFrame, metric: str, k: int, key: str = "vec_id", vector: str = "embedding", block: int = 4096) -> DataFrame:
    """query_id, key, score, rank: each query's k best rows of the corpus, ties by key, rows without a score last.

    All pairs are looked at: queries (query_id, query) in blocks of about ``block`` vectors meet the corpus in parts of bounded
    size, each pair of them in a task of its own (:mod:`.nearest`), which sends on its own k best of each query only.
    Vectors that can't be put in a matrix (null, of another size, with a null or without end) are scored one by one.
    """
    ship_package(corpus.sparkSession)
    measure, largest = METRICS[metric]
    lists = (lambda v: F.col(v)) if metric == "max_sim" else (lambda v: F.array(v))
    c = corpus.select(key, F.col(vector).alias("__v"), _dimension(lists(vector)).alias("__d"))
    q = queries.select("query_id", F.col("query").alias("__v"), _dimension(lists("query")).alias("__d"))
    vectors = F.coalesce(F.sum(F.size(lists("__v"))), F.lit(0)).alias("vectors")
    count = F.count(F.lit(1)).alias("n"), F.count("__d").alias("known"), F.min("__d").alias("least"), F.max("__d").alias("most"), vectors
    of_c, of_q = c.agg(*count).first(), q.agg(*count).first()
    size = max(of_c["most"] or 0, of_q["most"] or 0)
    regular = F.coalesce(F.col("__d") == size, F.lit(False))
    all_regular = all(n["n"] == n["known"] and n["least"] in (None, size) for n in (of_c, of_q))
    parts = max(-(-of_c["vectors"] * size // PART_NUMBERS), min(PARTS, -(-of_c["vectors"] // 1024)), 1)
    blocks = max(1, -(-of_q["vectors"] // block))

    def dealt(rows: DataFrame, by: str, mine: int, others: int, cell: Callable[[Column, Column], Column]) -> DataFrame:
        one = rows if all_regular else rows.filter(regular)
        one = one.select(by, lists("__v").alias("v"), F.pmod(F.xxhash64(by), F.lit(mine)).alias("__mine"), F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("__other"))
        return one.select(cell(F.col("__mine"), F.col("__other")).alias("__cell"), by, "v").repartition(2 * parts * blocks, "__cell").groupBy("__cell")

    left = dealt(q, "query_id", blocks, parts, lambda mine, other: mine * parts + other)
    right = dealt(c, key, parts, blocks, lambda mine, other: other * parts + mine)
    kinds = dict(q.dtypes)["query_id"], dict(c.dtypes)[key]
    out = left.cogroup(right).applyInArrow(lambda a, b: nearest.best_of_tables(a, b, metric, k, key), f"query_id {kinds[0]}, `{key}` {kinds[1]}, score double")
    if not all_regular:
        pairs = c.filter(~regular).crossJoin(F.broadcast(q.withColumnRenamed("__v", "__q").drop("__d"))).unionByName(c.filter(regular).crossJoin(F.broadcast(q.filter(~regular).withColumnRenamed("__v", "__q").drop("__d"))))
        out = out.unionByName(pairs.select("query_id", key, measure(F.col("__q"), F.col("__v")).alias("score")))
    order = F.col("score").desc_nulls_last() if largest else F.col("score").asc_nulls_last()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(order, F.col(key)))
    return out.withColumn("rank", rank).filter(F.col("rank") <= k)


def _dimension(vectors: Column) -> Column:
    """The size of a list's vectors, if it has any, all of one size and finite; else null."""
    size = F.size(F.get(vectors, F.lit(0)))
    finite = lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))
    same = F.forall(vectors, lambda v: F.coalesce(F.size(v) == size, F.lit(False)) & F.coalesce(F.forall(v, finite), F.lit(False)))
    return F.when((F.size(vectors) > 0) & (size > 0) & same, size)


def fuse(rankings: list[DataFrame], key: str = "doc_id", constant: int = 60) -> DataFrame:
    """Reciprocal rank fusion of rankings (query_id, key, rank): score = sum of 1 / (constant + rank)."""
    all_ = rankings[0].select("query_id", key, "rank")
    for r in rankings[1:]:
        all_ = all_.unionByName(r.select("query_id", key, "rank"))
    return all_.groupBy("query_id", key).agg(F.sum(1.0 / (F.lit(constant) + F.col("rank"))).alias("score"))


def encode(docs: DataFrame, model: Callable[[], Callable[[list[str]], list]], text: str = "text", out: str = "dense", kind: str = "array<float>", batch_size: int = 32) -> DataFrame:
    """Adds a model's vectors: model() is called once a task and gives the function of a list of texts (at most
    batch_size); kind is array<float> for dense, array<array<float>> for late-interaction vectors."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{out}` {kind}"])

    def run(batches: Iterator) -> Iterator:
        call = model()
        for pdf in batches:
            texts = [t or "" for t in pdf[text]]
            vectors = [v for lo in range(0, len(texts), batch_size) for v in call(texts[lo : lo + batch_size])]
            yield pdf.assign(**{out: vectors})

    return docs.mapInPandas(run, schema)
