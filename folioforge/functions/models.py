"""Where models are called: morphemes, and the request that a captioning server gets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import korean_tokens


def morphemes(text: Column, analyser: Callable[[], Callable[[str], list[str]]]) -> Column:
    """Tokens of a morphological analyser (made once a task); where it fails or finds none, the built-in Korean tokens."""
    import pandas as pd

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            call = analyser()
        except Exception:  # no analyser here  # noqa: BLE001
            call = None

        def one(t):
            try:
                return list(call(t or "")) or None if call else None
            except Exception:  # noqa: BLE001
                return None

        for s in batches:
            yield s.map(one)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.coalesce(F.pandas_udf(run, "array<string>")(text), korean_tokens(text))


def caption_request(content: Column, model: str, prompt: str) -> Column:
    """The JSON body that asks a server for a caption of an image's bytes, as one answer."""
    return F.to_json(F.struct(F.lit(model).alias("model"), F.lit(prompt).alias("prompt"), F.array(F.base64(content)).alias("images"), F.lit(False).alias("stream")))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def has_sparse(sparse: Column) -> Column:
    """Aggregate: whether any document has a term."""
    return F.bool_or(F.size(F.coalesce(sparse["indices"], F.array().cast("array<int>"))) > 0)


