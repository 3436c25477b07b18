"""Column helpers for string work, with R's missing-value rules.

All helpers return native Column expressions (no UDF), so they stay inside
whole-stage code generation. Where R and SQL disagree on NULL handling the
helper follows R, as written in each docstring.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word segments of the Unicode word-break rules, as one pattern of character
# classes. The classes' members.
# Marks and format characters belong to the character before them.
_EXTEND = r"\p{M}\p{Cf}&&[^\x{200B}]"
_JAPANESE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\x{3031}-\x{3035}\x{30FC}\x{FF70}"
_LETTER = rf"[a-z[\p{{L}}\p{{Nl}}&&[^{_JAPANESE}]]]"
_DIGIT = r"[\p{Nd}\x{66B}]"
_JOINER = r"\p{Pc}\x{202F}"  # underscores and the like
_MID_BOTH = r".'\x{2018}\x{2019}\x{2024}\x{FE52}\x{FF07}\x{FF0E}"
_MID_LETTER = rf"[{_MID_BOTH}\x{{B7}}\x{{387}}\x{{55F}}\x{{5F4}}\x{{2027}}\x{{FE13}}]"
_MID_DIGIT = rf"[{_MID_BOTH},;\x{{37E}}\x{{589}}\x{{60C}}\x{{60D}}\x{{66C}}\x{{7F8}}\x{{2044}}\x{{FE10}}\x{{FE14}}\x{{FE50}}\x{{FE54}}\x{{FF0C}}\x{{FF1B}}]"


def _word_pattern() -> str:
    more, joiners = rf"[{_EXTEND}]*+", rf"[{_JOINER}[{_EXTEND}]]*+"
    # letters (digits) with their marks, and those that one mark of the middle joins
    letters = rf"{_LETTER}[a-z[\p{{L}}\p{{Nl}}{_EXTEND}&&[^{_JAPANESE}]]]*+(?:{_MID_LETTER}{more}{_LETTER}[a-z[\p{{L}}\p{{Nl}}{_EXTEND}&&[^{_JAPANESE}]]]*+)*+"
    digits = rf"{_DIGIT}[{_DIGIT}[{_EXTEND}]]*+(?:{_MID_DIGIT}{more}{_DIGIT}[{_DIGIT}[{_EXTEND}]]*+)*+"
    joiner = rf"[{_JOINER}]{more}"
    katakana = rf"[\p{{IsKatakana}}\x{{3031}}-\x{{3035}}\x{{30FC}}\x{{FF70}}][\p{{IsKatakana}}\x{{3031}}-\x{{3035}}\x{{30FC}}\x{{FF70}}{_EXTEND}]*+"
    single = rf"[\p{{IsHan}}\p{{IsHiragana}}]{more}"
    # most words are plain letters before a blank or a mark that joins nothing
    plain = r"[a-zß-öø-ÿ]++(?=[\x00-\x20,;:!?\"()|/-]|\z|\.(?:[\x00-\x20]|\z))"
    whole = rf"(?:[{_JOINER}]{joiners})?(?:{letters}|{digits})(?:{letters}|{digits}|{joiner})*+|(?:{joiner}){{2,}}+|{katakana}|{single}"
    # a few marks before a token are passed in one step
    return rf"[\x00-\x20.,;:!?\"()|/-]{{0,3}}+({plain}|{whole})"


#: A token: a segment of letters, digits and joiners; a mark of the middle stands
#: between letters (don't, e.g) or digits (3.14, 1,000). Joiners alone make a token from
#: two on. Ideographs and hiragana stand alone, katakana in runs. Lower-cased first.
#: Group 1 is the token.
TOKEN_PATTERN = _word_pattern()


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokens_of(col) -> Column:
    """Array of lower-cased word tokens of a text column (NULL/'' give [])."""
    return F.regexp_extract_all(F.lower(_c(col)), F.lit(TOKEN_PATTERN), 1)


def str_detect(col, pattern: str) -> Column:
    """Regex search; NULL input stays NULL (stringr semantics)."""
    return _c(col).rlike(pattern)


def grepl(col, pattern: str) -> Column:
    """Regex search; NULL input gives FALSE (base R semantics)."""
    return F.coalesce(_c(col).rlike(pattern), F.lit(False))


def contains_fixed(col, literal: str) -> Column:
    """Literal substring test (``fixed=TRUE``); NULL input gives FALSE."""
    return F.coalesce(_c(col).contains(literal), F.lit(False))


def replace_first(col, pattern: str, replacement: str) -> Column:
    """Replace only the first regex match (``str_replace``).

    The value is cut at the first match, so the pattern keeps its own groups
    and flags; the replacement is taken literally. A match of nothing at all
    puts the replacement in front.
    """
    c = _c(col)
    parts = F.split(c, pattern, 2)
    empty = c.rlike(pattern) & (F.regexp_extract(c, pattern, 0) == "")
    return (F.when(empty, F.concat(F.lit(replacement), c))
             .when(F.size(parts) == 2, F.concat(F.get(parts, F.lit(0)), F.lit(replacement), F.get(parts, F.lit(1)))).otherwise(c))


def replace_all(col, pattern: str, replacement: str) -> Column:
    """Replace every regex match (``gsub``/``str_replace_all``)."""
    return F.regexp_replace(_c(col), F.lit(pattern), F.lit(replacement))


def str_extract(col, pattern: str) -> Column:
    """First regex match, NULL when there is none (``str_extract``)."""
    return F.nullif(F.regexp_extract(_c(col), pattern, 0), F.lit(""))


def trim_ws(col) -> Column:
    """Strip leading/trailing whitespace incl. tabs and newlines (``trimws``)."""
    return F.regexp_replace(_c(col), F.lit(r"^\s+|\s+$"), F.lit(""))


def before_delim(col, delim: str) -> Column:
    """Part before the first ``delim``; the whole value when it is absent."""
    return F.substring_index(_c(col), delim, 1)


def after_delim(col, delim: str) -> Column:
    """Part after the first ``delim``; the whole value when it is absent."""
    c = _c(col)
    at = F.instr(c, delim)
    return F.when(at == 0, c).otherwise(F.substr(c, at + F.lit(len(delim))))


def paste(*cols, sep: str = ".") -> Column:
    """Join values with ``sep`` (``paste``/``interaction``); NULL shows as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("NA")) for c in cols])


def floor_div(col, width: int) -> Column:
    """Integer division rounding down (``%/%``), as bigint."""
    return F.floor(_c(col) / F.lit(width))


def decile_of(rel_pos) -> Column:
    """``ceiling(p * 10) / 10`` in the same double operation order as R."""
    return F.ceil(_c(rel_pos) * F.lit(10)) / F.lit(10)


def if_else(cond: Column, yes, no) -> Column:
    """``ifelse``: NULL condition gives NULL (not ``no``)."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    no = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond, yes).when(~cond, no)


def if_else_na(cond: Column, yes) -> Column:
    """``ifelse(cond, yes, NA)``."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    return F.when(cond, yes)


def reverse_name(col) -> Column:
    """"Last, First Middle" -> "First Middle Last"; other values unchanged."""
    return F.regexp_replace(_c(col), F.lit(r"^([^,]+),\s*(.*)$"), F.lit("$2 $1"))


def first_word(col) -> Column:
    """First blank-separated word of a value (NULL stays NULL)."""
    return F.nullif(F.regexp_extract(_c(col), r"^\s*(\S+)", 1), F.lit(""))


__all__ = [
    "TOKEN_PATTERN", "tokens_of", "str_detect", "grepl", "contains_fixed",
    "replace_first", "replace_all", "str_extract", "trim_ws", "before_delim",
    "after_delim", "paste", "floor_div", "decile_of", "if_else", "if_else_na",
    "reverse_name", "first_word",
]
