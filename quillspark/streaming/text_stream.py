"""The stateless text operators on Structured Streaming input.

Tokenising, stop-word removal and regex filters are per-row, so the same
functions apply unchanged to a streaming DataFrame; counts become a
stateful streaming aggregation (complete/update output mode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quillspark.operators.counts import count_by
from quillspark.operators.tokens import remove_stopwords, unnest_tokens


def stream_tokens(spark: SparkSession, path: str, schema: StructType, text_col: str = "text", *,
                  keep=None, stop: DataFrame | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Tokens of parquet files arriving under ``path`` (streaming)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.parquet(path)
    return remove_stopwords(unnest_tokens(src, text_col, "word", position=None, keep=keep), stop)


def stream_word_counts(spark: SparkSession, path: str, schema: StructType, text_col: str = "text", *,
                       by=(), stop: DataFrame | None = None) -> DataFrame:
    """Running word counts per group over a stream of texts (Q1 on a stream)."""
    tokens = stream_tokens(spark, path, schema, text_col, keep=list(by), stop=stop)
    return count_by(tokens, [*by, "word"])


__all__ = ["stream_tokens", "stream_word_counts"]
