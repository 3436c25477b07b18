"""Term weights (tf-idf) and top-k with ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.relational import join_on, join_totals


def tf_idf(counts: DataFrame, term: str, doc: str, n: str = "n") -> DataFrame:
    """``bind_tf_idf(term, doc, n)``: adds ``tf``, ``idf``, ``tf_idf``.

    tf = n / sum(n) in the document; idf = ln(#documents / #documents holding
    the term). ``counts`` has one row per (doc, term) and counts of 1 or more.
    Document totals and document frequencies are aggregates joined back (no
    window over a whole document or term), the latter by ``join_totals``, so a
    term that every document holds is spread over many tasks. The numbers of
    documents and of rows are one scalar subquery.
    """
    # Every branch reads ``n`` through the same test (``n > 0``, true for
    # counts), so the optimiser keeps the (doc, term, n) aggregate intact in
    # each branch and they share its shuffle: the input is tokenised once.
    has = F.col(n) > 0
    doc_tot = counts.groupBy(doc).agg(F.sum(n).alias("__doc_total"))
    term_df = counts.groupBy(term).agg(F.count(F.when(has, F.lit(1))).alias("__doc_freq"))
    whole = counts.agg(F.struct((F.count_distinct(F.when(has, F.col(doc)))
                                 + F.coalesce(F.max(F.when(has, F.col(doc).isNull().cast("int"))), F.lit(0))).alias("docs"),
                                F.count(F.when(has, F.lit(1))).alias("rows")).alias("whole")).scalar()
    n_docs = whole["docs"]
    out = join_totals(join_on(counts, doc_tot, [doc]), term_df, term, "__doc_freq", whole["rows"])
    out = out.withColumns({
        "tf": F.col(n) / F.col("__doc_total"),
        "idf": F.log(n_docs / F.col("__doc_freq")),
    }).withColumn("tf_idf", F.col("tf") * F.col("idf"))
    return out.drop("__doc_total", "__doc_freq")


def top_k_ties(df: DataFrame, by: Sequence[str], k: int, weight: str) -> DataFrame:
    """``group_by(by) %>% top_n(k, weight)``: rows whose rank by descending
    weight is at most ``k``, ties kept, NULL weights dropped.

    Per group this is ``rank() <= k``, planned with a per-partition group limit
    before the shuffle; without groups the k-th largest weight is found by a
    distributed take-ordered and used as a threshold.
    """
    d = df.where(F.col(weight).isNotNull())
    if by:
        w = Window.partitionBy(*by).orderBy(F.col(weight).desc())
        return d.withColumn("__rk", F.rank().over(w)).where(F.col("__rk") <= k).drop("__rk")
    kth = d.select(weight).orderBy(F.col(weight).desc()).limit(k).agg(F.min(weight)).scalar()
    return d.where(F.col(weight) >= kth)


def top_terms(weighted: DataFrame, by: Sequence[str], k: int, *, weight: str = "tf_idf",
              min_n: int | None = None, n: str = "n") -> DataFrame:
    """Q7: characteristic terms: optional ``n > min_n`` filter, then top-k with ties."""
    d = weighted if min_n is None else weighted.where(F.col(n) > min_n)
    return top_k_ties(d, by, k, weight)


def mean_order(df: DataFrame, level: str, value, name: str = "mean") -> DataFrame:
    """``reorder(level, value)``: the mean value per level, in plotting order."""
    return (df.groupBy(level).agg((F.sum(value).cast("double") / F.count(value)).alias(name))
              .orderBy(F.col(name).asc_nulls_last(), F.col(level).asc_nulls_last()))


__all__ = ["tf_idf", "top_k_ties", "top_terms", "mean_order"]
