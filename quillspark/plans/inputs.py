"""Inputs derived from the driver tables.

Stand-ins: ``documents`` is a library (``doc_id`` a work, ``lang`` and
``source`` groups of works), its lines come from splitting ``text`` at
newlines; ``conversations`` is a play (``conv_id`` a scene, ``role`` the
speaker, lines ordered by ``turn, line_no``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.operators.tokens import unnest_tokens
from quillspark.sources.tables import load_table
from quillspark.sources.text import text_lines

DOC_KEYS = ["doc_id", "lang", "source"]


#: Session setting: tasks to which the texts of ``documents`` are dealt after reading, for
#: files of few row groups (``load_table``'s ``partitions``); unset, the file's splits.
PARTITIONS = "quillspark.documents.partitions"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A driver table."""
    return load_table(spark, base, name, partitions=spark.conf.get(PARTITIONS, None) if name == "documents" else None)


def doc_lines(spark: SparkSession, base: str, neighbours: dict | None = None) -> DataFrame:
    """``(doc_id, lang, source, line_no, line[, neighbours])``."""
    docs = table(spark, base, "documents").select(*DOC_KEYS, "text")
    return text_lines(docs, "text", neighbours=neighbours)


def doc_tokens(spark: SparkSession, base: str) -> DataFrame:
    """``(doc_id, lang, source, tpos, word)``, ``tpos`` 1..n over the whole text."""
    docs = table(spark, base, "documents").select(*DOC_KEYS, "text")
    return unnest_tokens(docs, "text", "word", position="tpos")


def line_tokens(spark: SparkSession, base: str) -> DataFrame:
    """``(doc_id, lang, source, line_no, tpos, word)``, ``tpos`` inside the line."""
    return unnest_tokens(doc_lines(spark, base), "line", "word", position="tpos")


def conv_lines(spark: SparkSession, base: str) -> DataFrame:
    """``(conv_id, turn, role, line_no, line)``."""
    conv = table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    return text_lines(conv, "text")


__all__ = ["DOC_KEYS", "PARTITIONS", "table", "doc_lines", "doc_tokens", "line_tokens", "conv_lines"]
