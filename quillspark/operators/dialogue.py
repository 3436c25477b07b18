"""Who speaks how much: turns, participants, lines and words per speaker and
scene, and picking scenes by their ordinal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import paste, tokens_of
from quillspark.operators.counts import distinct_and_rows, n_distinct
from quillspark.operators.ordered import first_seen_code, ordered_scan
from quillspark.operators.relational import arrange, join_on
from quillspark.session import cut_lineage


def turns_per(dialogues: DataFrame, keys: Sequence[str], turn: str = "dialrank",
              name: str = "n") -> DataFrame:
    """Q18: ``group_by(keys) %>% summarize(n = n_distinct(turn))``, most first."""
    out = dialogues.groupBy(*keys).agg(n_distinct(turn).alias(name))
    return arrange(out, (name, "desc"), *keys)


def participants_per(dialogues: DataFrame, keys: Sequence[str], member: str,
                     name: str = "n") -> DataFrame:
    """Q18: distinct participants (NULL counted once) per group, most first."""
    out = dialogues.groupBy(*keys).agg(n_distinct(member).alias(name))
    return arrange(out, (name, "desc"), *keys)


def lines_per(dialogues: DataFrame, keys: Sequence[str], turn: str = "dialrank") -> DataFrame:
    """Q18/Q23: turns (distinct turn ids) and lines per group."""
    return distinct_and_rows(dialogues, keys, turn, "n_turns", "n")


def words_per(dialogues: DataFrame, keys: Sequence[str], *, line: str = "line",
              levels: Mapping[str, str] | None = None, order: Sequence[str] = (),
              label: str = "label") -> DataFrame:
    """Q19: word tokens per group; with ``levels`` each listed key also gets
    its code by first appearance in ``order`` and the codes are joined into a
    dotted ``label``; rows sorted by the codes.

    One aggregation counts the words and finds where each group first
    appears; the codes come from that small table.
    """
    first = [F.min(F.struct(*[F.col(c) for c in order])).alias("__at")] if levels else []
    groups = dialogues.groupBy(*keys).agg(F.sum(F.size(tokens_of(line))).alias("n"), *first)
    if not levels:
        return groups.where(F.col("n") > 0)
    groups = cut_lineage(groups)
    at = groups.select(*keys, *[F.col("__at")[c].alias(f"__{c}") for c in order])
    out = groups.where(F.col("n") > 0).drop("__at")
    for level, code in levels.items():
        out = join_on(out, first_seen_code(at, [], [f"__{c}" for c in order], level, code), [level], "left")
    out = out.withColumn(label, paste(*levels.values(), sep="."))
    return arrange(out, *levels.values(), *keys)


def nth_level(df: DataFrame, level: str, k: int, order: Sequence[str], part: Sequence[str] = ()) -> DataFrame:
    """P12/Q22: rows whose ``level`` is the k-th distinct value in order of
    first appearance (``filter(x == unique(x)[k])``), per ``part``."""
    return levels_at(df, {level: k}, order, part)


def levels_at(df: DataFrame, at: Mapping[str, int], order: Sequence[str], part: Sequence[str] = ()) -> DataFrame:
    """Rows whose levels are the ``{level: k}``-th by first appearance, per
    ``part``. One scan carries each level's first k values along the sequence."""
    names = {level: f"__first{n}" for n, level in enumerate(at)}
    d = ordered_scan(df, part, order, firsts={names[level]: (level, k) for level, k in at.items()})
    for level, k in at.items():
        d = d.where(F.col(level) == F.get(names[level], F.lit(k - 1)))
    return d.select(*df.columns)


def scene_at(lines: DataFrame, act_no: int, scene_no: int, order: Sequence[str], *, act: str = "akt",
             scene: str = "scene", part: Sequence[str] = ()) -> DataFrame:
    """Q22: the rows of the ``act_no``-th act and the ``scene_no``-th scene
    (``filter(act == unique(act)[i], scene == unique(scene)[j])``). Both count
    by first appearance over the whole text, the scene not within its act."""
    return levels_at(lines, {act: act_no, scene: scene_no}, order, part)


__all__ = ["turns_per", "participants_per", "lines_per", "words_per", "nth_level", "levels_at", "scene_at"]
