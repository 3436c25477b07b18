"""Position inside a text: relative position, deciles and their analyses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import decile_of, tokens_of
from quillspark.operators.counts import count_by
from quillspark.operators.ordered import DEFAULT_BLOCK, number_rows
from quillspark.operators.relational import lookup
from quillspark.operators.tokens import remove_stopwords
from quillspark.operators.weights import tf_idf, top_k_ties


def relative_position(df: DataFrame, part: Sequence[str], order: Sequence[str],
                      name: str = "word_position", *, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``group_by(part) %>% mutate(name = row_number() / n())`` in ``order``."""
    d = number_rows(df, part, order, "__rn", group_total="__n", block_size=block_size)
    return d.withColumn(name, F.col("__rn") / F.col("__n")).drop("__rn", "__n")


def text_positions(df: DataFrame, text_col: str = "text", *, stop_words=None, keep=None,
                   word: str = "word", position: str = "tpos",
                   name: str = "word_position") -> DataFrame:
    """Tokens of each text with their relative position among the kept
    tokens: ``unnest_tokens`` + stop-word ``anti_join`` + ``row_number()/n()``
    per text, computed inside the row.

    When every sequence is one text in one row (a document, a book read
    whole), its tokens never need to meet again: the stop words are dropped
    from the token array, ranks are array indexes and ``n()`` the array size.
    No shuffle, no window. ``position`` keeps the token's index in the full
    text. ``stop_words`` is a word list of any length, held as a set in the
    plan; a stop *table* goes through ``relative_position`` on a token table.
    """
    keep = [c for c in df.columns if c != text_col] if keep is None else list(keep)
    toks = F.transform(tokens_of(text_col), lambda w, i: F.struct((i + 1).alias("p"), w.alias("w")))
    if stop_words:
        # ``isin`` over many literals becomes a hash-set lookup (InSet); a
        # token is never NULL, so NULL in the list matches none
        words = [w for w in stop_words if w is not None]
        toks = F.filter(toks, lambda t: ~t["w"].isin(*words))
    d = df.select(*keep, toks.alias("__toks"))
    d = d.select(*keep, F.size("__toks").alias("__n"), F.posexplode("__toks").alias("__r", "__t"))
    return d.select(*keep, F.col("__t")["p"].alias(position), F.col("__t")["w"].alias(word),
                    ((F.col("__r") + 1) / F.col("__n")).alias(name))


def text_decile_counts(df: DataFrame, text_col: str = "text", *, stop_words=None,
                       word: str = "word") -> DataFrame:
    """``count(decile, word)`` of texts one row each (see ``text_positions``)."""
    t = with_decile(text_positions(df, text_col, stop_words=stop_words, keep=[], word=word))
    return count_by(t, ["decile", word])


def with_decile(df: DataFrame, rel: str = "word_position", name: str = "decile") -> DataFrame:
    """``mutate(decile = ceiling(rel * 10) / 10)``."""
    return df.withColumn(name, decile_of(rel))


def decile_counts(tokens: DataFrame, part, order, stop: DataFrame | None = None,
                  word: str = "word", *, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Stop words out, position by decile of each work, ``count(decile, word)``."""
    t = remove_stopwords(tokens, stop, word)
    t = with_decile(relative_position(t, part, order, block_size=block_size))
    return count_by(t, ["decile", word])


def sentiment_by_decile(tokens: DataFrame, scores: DataFrame, part, order,
                        stop: DataFrame | None = None, word: str = "word",
                        score: str = "score", *, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Q6: mean lexicon score per decile of position, weighted by counts.

    Positions are taken after stop-word removal, as in the analysis.
    """
    c = decile_counts(tokens, part, order, stop, word, block_size=block_size)
    return decile_scores(c, scores, word, score)


def decile_scores(c: DataFrame, scores: DataFrame, word: str = "word", score: str = "score") -> DataFrame:
    """``inner_join(scores) %>% group_by(decile) %>% summarize(sum(score*n)/sum(n))``."""
    lex = scores.select(word, score) if isinstance(scores, DataFrame) else scores
    j = c.join(lookup(c.sparkSession, lex, f"`{word}` string, `{score}` double"), word)
    return (j.groupBy("decile")
             .agg((F.sum(F.col(score) * F.col("n")) / F.sum("n")).alias(score)))


def top_terms_by_decile(tokens: DataFrame, part, order, stop: DataFrame | None = None,
                        word: str = "word", *, min_n: int = 30, k: int = 10,
                        block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Q8: tf-idf with the decile as document, ``n > min_n``, global top-k."""
    c = decile_counts(tokens, part, order, stop, word, block_size=block_size)
    return decile_top_terms(c, word, min_n=min_n, k=k)


def decile_top_terms(c: DataFrame, word: str = "word", *, min_n: int = 30, k: int = 10) -> DataFrame:
    """tf-idf of decile counts with the decile as document, ``n > min_n``, top-k."""
    w = tf_idf(c, word, "decile")
    return top_k_ties(w.where(F.col("n") > min_n), [], k, "tf_idf")


__all__ = ["text_positions", "text_decile_counts", "decile_scores", "decile_top_terms",
           "relative_position", "with_decile", "decile_counts", "sentiment_by_decile",
           "top_terms_by_decile"]
