"""Structure of line-oriented texts (plays): segments, acts, scenes,
speakers, stage directions and dialogue turns.

Each function takes a lines table with a sequence key ``part`` and an order
``order`` (see ``quillspark.operators.ordered``). Functions that look at
neighbouring lines expect the neighbour columns ``prev1``, ``prev2`` and
``next1``; ``add_neighbours`` makes them for any table, and
``quillspark.sources.text_lines(neighbours=...)`` reads them from the split
text without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import (
    contains_fixed, grepl, if_else, if_else_na, replace_first, str_detect, str_extract, trim_ws,
)
from quillspark.operators.ordered import DEFAULT_BLOCK, ordered_scan
from quillspark.operators.relational import join_on

NEIGHBOURS = {"prev1": 1, "prev2": 2, "next1": -1}


def add_neighbours(lines: DataFrame, part: Sequence[str], order: Sequence[str], line: str = "line", *,
                   pos: str = "rownumber", shifts: Mapping[str, int] = NEIGHBOURS,
                   block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Number rows densely per sequence (``pos``) and add lag/lead columns."""
    return ordered_scan(lines, part, order, running={pos: (F.lit(1), True)},
                        shifts={name: (line, k) for name, k in shifts.items()}, block_size=block_size)


def mark_segments(lines: DataFrame, part, order, *, start: Column, end: Column,
                  name: str = "is_book", inside: str = "book", outside: str = "nobook",
                  keep: bool = True, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Q13, first half: mark ``inside`` where ``start`` holds (typically "the
    previous line is the start marker"), ``outside`` where ``end`` holds,
    carry the marks down and keep the inside rows (all rows with their mark
    when ``keep`` is false). Rows before the first mark keep NULL."""
    d = lines.withColumn(name, if_else_na(start, inside))
    d = d.withColumn(name, if_else(end, outside, F.col(name)))
    d = ordered_scan(d, part, order, fill_down=[name], block_size=block_size)
    return d.where(F.col(name) == inside) if keep else d


def split_front_matter(lines: DataFrame, part, order, *, body_start: Column, name: str = "is_text",
                       value: str = "text", block_size: int = DEFAULT_BLOCK):
    """Q13, second half: mark the row where ``body_start`` holds (typically
    "the next line is the first heading"), carry it down; rows before it are
    the front matter. Returns ``(front_matter, body)``."""
    d = lines.withColumn(name, if_else_na(body_start, value))
    d = ordered_scan(d, part, order, fill_down=[name], block_size=block_size)
    return d.where(F.col(name).isNull()), d.where(F.col(name) == value)


def _blank(col: Column) -> Column:
    return col == ""


def annotate_structure(lines: DataFrame, part, order, *, line: str = "line",
                       act_pattern: str, scene_literal: str,
                       scene_fixes: Mapping[str, str] | None = None,
                       is_blank: Callable[[Column], Column] = _blank,
                       prev1: str = "prev1", prev2: str = "prev2", next1: str = "next1",
                       spoken_only: bool = True, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Q14: act, scene, speaker and stage-description marks, carried down.

    act     -- the line, where it matches ``act_pattern`` (regex);
    scene   -- the line, where it holds ``scene_literal`` (literal), after
               ``scene_fixes`` (first-match replacements);
    speaker -- a non-blank line after a blank line;
    scene_description -- ``scene_descr_begin`` on a non-blank line after two
               blank lines on a scene heading; ``scene_descr_end`` on a blank
               line between a non-blank and a blank line.
    NULL comparisons at the ends of a text give NULL marks, as in R. With
    ``spoken_only`` the rows inside an act and outside a description start
    are kept.
    """
    L, P1, P2, N1 = F.col(line), F.col(prev1), F.col(prev2), F.col(next1)
    d = lines.withColumn("akt", if_else_na(grepl(L, act_pattern), L))
    d = d.withColumn("scene", if_else_na(contains_fixed(L, scene_literal), L))
    for pat, rep in (scene_fixes or {}).items():
        d = d.withColumn("scene", replace_first("scene", pat, rep))
    d = d.withColumn("speaker", if_else_na(~is_blank(L) & is_blank(P1), L))
    d = d.withColumn("scene_description",
                     if_else_na(~is_blank(L) & is_blank(P1) & is_blank(P2) & F.col("scene").isNotNull(),
                                "scene_descr_begin"))
    d = d.withColumn("scene_description",
                     if_else(~is_blank(P1) & is_blank(L) & is_blank(N1), "scene_descr_end",
                             F.col("scene_description")))
    d = ordered_scan(d, part, order, fill_down=["akt", "scene", "speaker", "scene_description"],
                     block_size=block_size)
    if spoken_only:
        d = d.where(F.col("akt").isNotNull() & (F.col("scene_description") != "scene_descr_begin"))
    return d


def clean_speakers(dialogues: DataFrame, cast: DataFrame | None = None, *, speaker: str = "speaker",
                   line: str = "line", aliases: Mapping[str, str] | None = None,
                   anchored: bool = True, drop_patterns: Sequence[str],
                   cast_key: str = "speaker_clean") -> DataFrame:
    """Q15: split a stage direction off the speaker, trim, map aliases, join
    the cast table, blank speaker lines and drop heading and empty lines.

    activity      -- the speaker from the first ``(`` on, NULL if none;
    speaker_clean -- the speaker before the first ``(``, trimmed, aliases
                     replaced (first match; anchored to the whole value by
                     default so a long form is not replaced again);
    then ``left_join(cast, by = speaker_clean)``, ``line = ""`` where the line
    is the speaker line, and rows whose ``speaker_clean`` matches a drop
    pattern or whose line is empty are removed (NULL removes too, like R's
    ``filter``).
    """
    S = F.col(speaker)
    d = dialogues.withColumn("activity", str_extract(S, r"\(.*"))
    d = d.withColumn("speaker_clean", trim_ws(replace_first(S, r"\(.*", "")))
    for pat, rep in (aliases or {}).items():
        p = f"^(?:{pat})$" if anchored else pat
        d = d.withColumn("speaker_clean", replace_first("speaker_clean", p, rep))
    if cast is not None:
        d = join_on(d, cast, {"speaker_clean": cast_key}, "left")
    d = d.withColumn(line, if_else(F.col(line) == S, "", F.col(line)))
    for pat in drop_patterns:
        d = d.where(~str_detect("speaker_clean", pat))
    return d.where(~(F.col(line) == ""))


def number_turns(dialogues: DataFrame, part, order, *, speaker: str = "speaker_clean",
                 name: str = "dialrank", block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Q17: dialogue turn ids.

    A turn ends where the speaker differs from the next row's speaker, or at
    the last row of the sequence; every row gets the number of the turn end
    at or after it (1, 2, ...). NULL speakers never end a turn themselves
    (the comparison is NULL), as in R. Adds ``rownumber`` (dense 1..n) and
    ``turnswitch``. One scan finds the row numbers, the next speakers and how
    often the speaker has changed so far, which is the turn id less one.
    """
    d = ordered_scan(dialogues, part, order, running={"rownumber": (F.lit(1), True)}, changes={"__before": speaker},
                     shifts={"__next": (speaker, -1)}, group_total="__n", block_size=block_size)
    sw = F.col(speaker) != F.col("__next")
    d = d.withColumn("turnswitch", if_else_na(sw, "turnswitch"))
    d = d.withColumn("turnswitch", if_else(F.col("rownumber") == F.col("__n"), "turnswitch",
                                           F.col("turnswitch")))
    return d.withColumn(name, F.col("__before") + 1).drop("__before", "__next", "__n")


__all__ = ["NEIGHBOURS", "add_neighbours", "mark_segments", "split_front_matter",
           "annotate_structure", "clean_speakers", "number_turns"]
