"""Selecting works from a catalogue and profiling their authors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import first_word, reverse_name, str_detect
from quillspark.operators.counts import count_by
from quillspark.operators.relational import anti, join_on, semi_in


def select_works(meta: DataFrame, subjects: DataFrame | None = None, *, id_col: str = "work_id",
                 subject_col: str = "subject", subject_pattern: str | None = None,
                 subject_equals: str | None = None, author_col: str = "author",
                 author_patterns: Sequence[str] = (), language: str | None = None,
                 has_text_col: str | None = "has_text", minus: DataFrame | None = None) -> DataFrame:
    """Q9: works by subject, author and language predicates.

    ``subjects ⋈ meta`` when a subject predicate is given, else ``meta``;
    author patterns are regexes that must all match; ``has_text`` must be
    TRUE; ``minus`` removes the works of another selection (anti join on id).
    """
    if subjects is not None and (subject_pattern or subject_equals):
        s = subjects
        if subject_pattern:
            s = s.where(str_detect(subject_col, subject_pattern))
        if subject_equals is not None:
            s = s.where(F.col(subject_col) == subject_equals)
        base = join_on(s, meta, [id_col])
    else:
        base = meta
    for p in author_patterns:
        base = base.where(str_detect(author_col, p))
    if has_text_col:
        base = base.where(F.col(has_text_col) == F.lit(True))
    if language is not None:
        base = base.where(F.col("language") == language)
    if minus is not None:
        base = anti(base, minus.select(id_col), [id_col])
    return base


def subject_counts(subjects: DataFrame, meta: DataFrame | None = None, *, id_col: str = "work_id",
                   subject_col: str = "subject", has_text_col: str | None = None,
                   authors: DataFrame | None = None, author_col: str = "author",
                   birth_col: str = "birthdate", born: tuple | None = None) -> DataFrame:
    """Q10: works per subject, most first.

    With ``authors`` and ``born=(lo, hi)``: works whose author was born
    strictly between the bounds (``%in%`` semi join), left-joined to their
    subjects (a work without subject counts under NULL). Otherwise subjects,
    optionally restricted to works that have a text.
    """
    if authors is not None:
        lo, hi = born
        period = authors.where((F.col(birth_col) < hi) & (F.col(birth_col) > lo))
        works = semi_in(meta, author_col, period, author_col)
        rows = join_on(works.select(id_col), subjects.select(id_col, subject_col), [id_col], "left")
    else:
        rows = subjects
        if meta is not None and has_text_col:
            rows = join_on(rows, meta.where(F.col(has_text_col) == F.lit(True)).select(id_col), [id_col])
    return count_by(rows, [subject_col], sort=True)


def name_profile(authors: DataFrame, names: DataFrame, *, author_col: str = "author",
                 birth_col: str = "birthdate", born: tuple, years: tuple,
                 name_col: str = "name", year_col: str = "year",
                 female_col: str = "female", male_col: str = "male") -> DataFrame:
    """Q16: gender profile of authors born strictly inside ``born``.

    ``Last, First`` is turned round, the first word taken as first name and
    looked up in a caller-supplied name table (counts of women and men per
    name and year) summed over ``years`` (inclusive); the name is female when
    more women than men carried it. Duplicate lookups are dropped, the
    lookup left-joined, and authors counted per gender (NULL when unknown).
    """
    lo, hi = born
    a = authors.where((F.col(birth_col) < hi) & (F.col(birth_col) > lo))
    a = a.withColumn("reversename", reverse_name(author_col))
    a = a.withColumn("first_name", first_word("reversename"))
    y0, y1 = years
    g = (names.where(F.col(year_col).between(y0, y1))
              .groupBy(name_col).agg(F.sum(female_col).alias("__f"), F.sum(male_col).alias("__m"))
              .select(name_col, F.when(F.col("__f") > F.col("__m"), "female").otherwise("male")
                      .alias("gender"))
              .dropDuplicates())
    a = join_on(a, g, {"first_name": name_col}, "left")
    return count_by(a, ["gender"])


__all__ = ["select_works", "subject_counts", "name_profile"]
