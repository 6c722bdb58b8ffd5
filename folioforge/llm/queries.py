"""The queries of this subpackage (spark, folder of tables) -> DataFrame, and DuckDB SQL where it can tell the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    from .mixing import mix

    return mix(documents(spark, folder)).drop("copies")


def op4_shard_by_bytes(spark: SparkSession, folder: str) -> DataFrame:
    from .sharding import shard_by_bytes

    return shard_by_bytes(documents(spark, folder))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from .exact_dedup import exact_groups

    return exact_groups(documents(spark, folder)).drop("text_hash")


def vocabulary() -> str:
    """The public vocabulary file that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    from .license_scan import scan

    return scan(documents(spark, folder))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    from .language_id import identify

    return identify(documents(spark, folder)).drop("text_hash")


def op5_mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    from .packing import pack

    return pack(documents(spark, folder), vocabulary())


def op6_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    from .quality import judged

    return judged(documents(spark, folder))


def quality_ablation(spark: SparkSession, folder: str) -> DataFrame:
    from .quality import policy_ablation

    return policy_ablation(documents(spark, folder))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    from .secrets import scan

    return scan(documents(spark, folder))


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    from .jaccard_join import near_groups

    return near_groups(documents(spark, folder)).drop("kept", "text_hash")


def op10_arrow_tokens(spark: SparkSession, folder: str) -> DataFrame:
    from .arrow_tokens import tokens_round_trip

    return tokens_round_trip(documents(spark, folder), vocabulary())


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_license_scan, op2_language_id, op3_mix_sources, op4_shard_by_bytes, op5_mixture_packing,
            op6_quality_ledger, op7_secret_scan, op8_exact_dedup, op9_jaccard_join, op10_arrow_tokens,
            quality_ablation,
        )
    }
