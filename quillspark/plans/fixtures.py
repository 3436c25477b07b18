"""Small word lists and tables of our own, used by the registered analyses.

The oracle SQL is built from the same Python values, so both engines read
the same words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.sources.tables import make_table
from pyspark.sql.types import (
    IntegerType, StringType, StructField, StructType,
)

# Fixed values (own fixtures): stop words for English and German prose.
STOP_WORDS = ["the", "of", "and", "to", "a", "in", "is", "that", "it", "for",
              "der", "die", "und", "den", "von", "das"]

# Fixed values (own fixtures): invented polarity of words that occur in the
# driver's prose, and a numeric score for the same words.
POSITIVE = ["tion", "ther", "than", "thon", "thing"]
NEGATIVE = ["thth", "thhe", "thnt", "thed", "erin"]
SCORES = {"tion": 3.0, "ther": 2.0, "than": 1.0, "thon": 2.0, "thing": 1.0,
          "thth": -3.0, "thhe": -2.0, "thnt": -1.0, "thed": -2.0, "erin": -1.0}

# Fixed values (own fixtures): a cast table for conversation roles and one
# alias spelling.
CAST = [("The User", "F", "user", "User"),
        ("The Assistant", "M", "assistant", "Assistant"),
        ("", "M", "narrator", "Narrator")]
SPEAKER_ALIASES = {"system": "narrator"}

# Fixed values (own fixtures): first-name table (name, year, female, male)
# for the gender profile; two rows lie outside the year range used.
FIRST_NAMES = [("red", 1850, 30, 10), ("red", 1950, 0, 90), ("blue", 1860, 5, 40),
               ("small", 1870, 12, 12), ("large", 1880, 50, 1), ("hot", 1890, 2, 3),
               ("cold", 1990, 70, 0), ("new", 1875, 9, 8)]
NAME_YEARS = (1800, 1900)


def polarity_rows(negative: str = "negative", positive: str = "positive"):
    """``(word, category)`` rows of the polarity fixture."""
    return [(w, positive) for w in POSITIVE] + [(w, negative) for w in NEGATIVE]


def stop_words(spark: SparkSession) -> DataFrame:
    return make_table(spark, [(w,) for w in STOP_WORDS], "word string")


def scores(spark: SparkSession) -> DataFrame:
    return make_table(spark, list(SCORES.items()), "word string, score double")


def cast_table(spark: SparkSession) -> DataFrame:
    schema = StructType([StructField(c, StringType()) for c in
                         ("name", "gender", "speaker_clean", "nameshort")])
    return make_table(spark, CAST, schema)


def first_names(spark: SparkSession) -> DataFrame:
    schema = StructType([StructField("name", StringType()), StructField("year", IntegerType()),
                         StructField("female", IntegerType()), StructField("male", IntegerType())])
    return make_table(spark, FIRST_NAMES, schema)


def sql_values(rows, names) -> str:
    """``(SELECT * FROM (VALUES ...) AS v(names))`` for the oracle SQL."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return repr(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS v({', '.join(names)}))"


__all__ = ["polarity_rows", "STOP_WORDS", "POSITIVE", "NEGATIVE", "SCORES", "CAST", "SPEAKER_ALIASES",
           "FIRST_NAMES", "NAME_YEARS", "stop_words", "scores", "cast_table",
           "first_names", "sql_values"]
