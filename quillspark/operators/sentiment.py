"""Lexicon sentiment along texts, and lexicon building."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import after_delim, before_delim, floor_div
from quillspark.operators.relational import arrange, lookup, union_by_name, union_labelled
from quillspark.operators.tokens import remove_stopwords, unnest_tokens


def _lexicon_hits(tokens: DataFrame, lexicon, stop, word: str, category: str) -> DataFrame:
    """Tokens (stop words out) joined to a lexicon given as a DataFrame or as
    ``(word, category)`` rows."""
    t = remove_stopwords(tokens, stop, word)
    lex = lookup(tokens.sparkSession, lexicon, f"`{word}` string, `{category}` string")
    return t.join(lex, word)


def _spread_counts(keys, cat: str, values: Sequence[str]):
    """Counts per category value as columns, 0 when absent: ``count`` then
    ``spread(cat, n, fill = 0)`` in one aggregation."""
    return [F.count(F.when(F.col(cat) == v, F.lit(1))).alias(v) for v in values]


def sentiment_arc(tokens: DataFrame, lexicon, work: Sequence[str], line: str = "line_no", *,
                  width: int = 80, stop: DataFrame | None = None, word: str = "word",
                  category: str = "sentiment", negative: str = "negative",
                  positive: str = "positive") -> DataFrame:
    """Q4: lexicon hits per (work, line bucket of ``width``), one column per
    polarity, and ``sentiment = positive - negative``."""
    hits = _lexicon_hits(tokens, lexicon, stop, word, category)
    out = (hits.groupBy(*work, floor_div(line, width).alias("index"))
               .agg(*_spread_counts(work, category, [negative, positive])))
    return out.withColumn("sentiment", F.col(positive) - F.col(negative))


def sentiment_signed(tokens: DataFrame, lexicon, work: Sequence[str], line: str = "line_no", *,
                     width: int = 80, stop: DataFrame | None = None, word: str = "word",
                     category: str = "sentiment", negative: str = "negative") -> DataFrame:
    """Q5: long form of the arc, counts of the negative category negated."""
    hits = _lexicon_hits(tokens, lexicon, stop, word, category)
    c = (hits.groupBy(*work, floor_div(line, width).alias("index"), category)
             .agg(F.count(F.lit(1)).alias("n")))
    cond = F.col(category) == negative
    return c.withColumn("n", F.when(cond, -F.col("n")).when(~cond, F.col("n")))


def sentiment_by(tokens: DataFrame, lexicon, keys: Sequence[str], *,
                 stop: DataFrame | None = None, word: str = "word", category: str = "neg_pos",
                 negative: str = "neg", positive: str = "pos") -> DataFrame:
    """Q21: lexicon hits per key, spread by polarity, ``sentiment = pos - neg``,
    lowest first."""
    hits = _lexicon_hits(tokens, lexicon, stop, word, category)
    out = hits.groupBy(*keys).agg(*_spread_counts(keys, category, [negative, positive]))
    out = out.withColumn("sentiment", F.col(positive) - F.col(negative))
    return arrange(out, "sentiment", *keys)


def build_lexicon(neg: DataFrame, pos: DataFrame, *, word_pos: str = "Wort_POS",
                  value: str = "Wert", inflections: str = "Inflektionen",
                  label: str = "neg_pos", dedupe: bool = False) -> DataFrame:
    """Q20: a word lexicon from two raw polarity tables.

    ``Word|POS`` is split at the first ``|`` (without one, both parts are the
    whole value); both tables are stacked with a ``neg``/``pos`` label; base
    words (distinct) and comma-separated inflections become ``word`` rows.
    The inflection rows are not made distinct, so one word may appear twice;
    ``dedupe`` removes that.
    """
    parts = {"neg": neg, "pos": pos}
    stacked = union_labelled(
        {k: t.select(before_delim(word_pos, "|").alias("Wort"),
                     after_delim(word_pos, "|").alias("POS"), value, inflections)
         for k, t in parts.items()}, label)
    basic = unnest_tokens(stacked.select(label, value, "Wort"), "Wort", "word", position=None).distinct()
    declinated = unnest_tokens(stacked.select(label, value, inflections), inflections, "word",
                               position=None)
    out = union_by_name(basic.select(label, value, "word"), declinated.select(label, value, "word"))
    return out.distinct() if dedupe else out


__all__ = ["sentiment_arc", "sentiment_signed", "sentiment_by", "build_lexicon"]
