"""Tidy tokens: one row per word, and stop-word removal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import tokens_of
from quillspark.operators.relational import lookup


def unnest_tokens(df: DataFrame, text_col: str, out: str = "word", *,
                  position: str | None = "tpos", keep=None) -> DataFrame:
    """``unnest_tokens(out, text_col)``: lower-cased word tokens, one per row.

    The text column is dropped and the other columns (or ``keep``) repeated.
    ``position`` names a 1-based token index inside the text, the order key
    for later positional work. NULL or empty text gives no row.
    """
    keep = [c for c in df.columns if c != text_col] if keep is None else list(keep)
    d = df.select(*keep, F.posexplode(tokens_of(text_col)).alias("__tp", out))
    cols = list(keep)
    if position:
        cols.append((F.col("__tp") + 1).alias(position))
    cols.append(out)
    return d.select(*cols)


def remove_stopwords(tokens: DataFrame, stop, word: str = "word",
                     stop_word: str = "word") -> DataFrame:
    """``anti_join(stop_words, by = "word")``; ``stop=None`` keeps all tokens.

    ``stop`` is a DataFrame with a ``stop_word`` column or a list of words of
    any length. NULL in the list removes NULL tokens, as joins match NA to NA.
    """
    if stop is None:
        return tokens
    if isinstance(stop, DataFrame):
        stop = stop.select(F.col(stop_word).alias("__sw"))
    s = lookup(tokens.sparkSession, stop, "__sw string")
    return tokens.join(s, tokens[word].eqNullSafe(s["__sw"]), "left_anti")


__all__ = ["unnest_tokens", "remove_stopwords"]
