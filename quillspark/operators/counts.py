"""Counts, distinct counts, shares and vocabulary comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.operators.relational import arrange, natural_join
from quillspark.operators.tokens import remove_stopwords


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n", *, sort: bool = False) -> DataFrame:
    """``count(keys...)`` / ``group_by(keys) %>% count()``; ``sort`` orders by
    ``n`` descending (ties by the keys, for a stable result)."""
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return arrange(out, (name, "desc"), *keys) if sort else out


def n_distinct(col: str) -> Column:
    """``n_distinct``: NULL counts as one more value (SQL's would skip it)."""
    return (F.count_distinct(F.col(col))
            + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0))).cast("bigint")


def distinct_and_rows(df: DataFrame, keys: Sequence[str], col: str,
                      distinct_name: str = "n_distinct", rows_name: str = "n") -> DataFrame:
    """``group_by(keys) %>% count(n_distinct(col))``: distinct values and rows per group."""
    return df.groupBy(*keys).agg(n_distinct(col).alias(distinct_name),
                                 F.count(F.lit(1)).alias(rows_name))


def share_of_total(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """``mutate(x = x / sum(x))`` over the whole table.

    The total is a scalar subquery (one row, computed once and broadcast as a
    value); no single-partition window and no cross join.
    """
    totals = df.agg(*[F.sum(c).alias(c) for c in cols])
    return df.withColumns({c + suffix: F.col(c) / totals.select(c).scalar() for c in cols})


def word_counts(tokens: DataFrame, by: Sequence[str] = (), stop: DataFrame | None = None,
                word: str = "word", *, sort: bool = True) -> DataFrame:
    """Q1: word frequencies per group, stop words removed, most frequent first."""
    return count_by(remove_stopwords(tokens, stop, word), [*by, word], sort=sort)


def compare_vocab(a: DataFrame, b: DataFrame, a_name: str, b_name: str,
                  word: str = "word") -> DataFrame:
    """Q2: two word-count tables (``word, n``) joined on the shared words, each
    count turned into its share of the shared vocabulary of its side."""
    left = a.select(word, F.col("n").alias(a_name))
    right = b.select(word, F.col("n").alias(b_name))
    both = natural_join(left, right)
    return share_of_total(both, [a_name, b_name])


def compare_groups(tokens: DataFrame, group: str, a_value, b_value, a_name: str, b_name: str, *,
                   stop=None, word: str = "word") -> DataFrame:
    """Q2 for two groups of one token table (e.g. two languages or genders):
    both counts come from one aggregation over one pass of the tokens, then
    the words used by both groups get their share of each side's shared
    vocabulary. Same result as ``compare_vocab`` on the two filtered counts."""
    t = remove_stopwords(tokens.where(F.col(group).isin(a_value, b_value)), stop, word)
    both = (t.groupBy(word)
             .agg(F.count(F.when(F.col(group) == a_value, F.lit(1))).alias(a_name),
                  F.count(F.when(F.col(group) == b_value, F.lit(1))).alias(b_name))
             .where((F.col(a_name) > 0) & (F.col(b_name) > 0)))
    return share_of_total(both, [a_name, b_name])


__all__ = ["compare_groups", "count_by", "n_distinct", "distinct_and_rows", "share_of_total",
           "word_counts", "compare_vocab"]
