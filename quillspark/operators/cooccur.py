"""Co-occurrence of members in shared contexts, and the network behind it.

A context becomes one row with the sorted array of its different members
(``member_sets``), collected after partial sets in the map tasks. Pairs are made
inside the row and counted before they are shuffled, so nothing is joined. A
context with very many members is cut into squares of array slices, which are
dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.relational import join_on

# Members of one side of a square of pairs.
DEFAULT_CHUNK = 512


def members_of(df: DataFrame, context: Sequence[str], member: str) -> DataFrame:
    """``group_by(context) %>% distinct(member)``."""
    return df.select(*context, member).distinct()


def member_sets(df: DataFrame, context: Sequence[str], member: str, name: str = "members") -> DataFrame:
    """One row per context: the sorted array of its different members (no NULL).

    A context's members stand in one row: pairs are as many as their square, so
    a context whose members would not fit has more pairs than could be listed.
    """
    d = df.select(*context, member).where(F.col(member).isNotNull())
    return d.groupBy(*context).agg(F.sort_array(F.collect_set(member)).alias(name))


def cooccurrence(df: DataFrame, context: Sequence[str], member: str, *,
                 a: str = "member_a", b: str = "member_b", name: str = "n",
                 chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Q11: contexts shared by each ordered pair of distinct members.

    Same as the self join of distinct (context, member) rows on the context,
    ``filter(a != b)`` and ``count(a, b)``: both directions are listed and
    NULL members take no part. Pairs are made in one direction only (``a < b``)
    and mirrored after counting. A member array is cut into slices of ``chunk``;
    each pair of slices is a row of its own, dealt by its place, and yields the
    pairs between them.
    """
    return _pairs(member_sets(df, context, member, "__m"), list(context), a, b, name, chunk)


def _pairs(sets: DataFrame, context: list[str], a: str, b: str, name: str, chunk: int) -> DataFrame:
    m, last = F.col("__m"), F.floor((F.size("__m") - 1) / F.lit(chunk)).cast("int")
    piece = lambda k: F.slice(m, F.col(k) * chunk + 1, F.lit(chunk))
    squares = sets.where(F.size("__m") > 1).withColumn("__p", F.explode(F.sequence(F.lit(0), last)))
    squares = squares.withColumn("__q", F.explode(F.sequence(F.col("__p"), last)))
    squares = squares.select(F.xxhash64(*context).alias("__h"), "__p", "__q", piece("__p").alias("__x"),
                             F.when(F.col("__p") < F.col("__q"), piece("__q")).alias("__y"))
    squares = squares.repartition("__h", "__p", "__q")
    # the slice itself or, after its element, the other one
    ones = squares.select("__x", "__y", F.posexplode("__x").alias("__i", a))
    rest = F.when(F.col("__y").isNull(), F.slice("__x", F.col("__i") + 2, F.lit(chunk))).otherwise(F.col("__y"))
    counted = ones.select(a, F.explode(rest).alias(b)).groupBy(a, b).agg(F.count(F.lit(1)).alias(name))
    both = F.explode(F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")), F.struct(F.col(b).alias("x"), F.col(a).alias("y"))))
    return counted.select(both.alias("__e"), name).select(F.col("__e.x").alias(a), F.col("__e.y").alias(b), name)


def network_vertices(df: DataFrame, context: Sequence[str], member: str, name: str = "name") -> DataFrame:
    """R3: members that share a context with another member, each once --
    the vertices of the co-occurrence network, without making its edges."""
    sets = member_sets(df, context, member, "__m")
    return sets.where(F.size("__m") > 1).select(F.explode("__m").alias(name)).distinct()


def context_counts(df: DataFrame, context: Sequence[str], member: str, name: str = "n", *,
                   drop_null: bool = False) -> DataFrame:
    """Contexts per member (``totalscenes``); NULL is a member of its own
    unless ``drop_null``."""
    m = members_of(df, context, member)
    if drop_null:
        m = m.where(F.col(member).isNotNull())
    return m.groupBy(member).agg(F.count(F.lit(1)).alias(name))


def cooccurrence_share(df: DataFrame, context: Sequence[str], member: str, *,
                       min_share: float | None = None, a: str = "member_a", b: str = "member_b",
                       chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Q12: pair count over the contexts of the first member (``n / n_a``),
    kept where it exceeds ``min_share``."""
    # NULL members never head a pair, so both branches can read one table of sets
    sets = member_sets(df, context, member, "__m")
    pairs = _pairs(sets, list(context), a, b, "n", chunk)
    totals = sets.select(F.explode("__m").alias(a)).groupBy(a).agg(F.count(F.lit(1)).alias("n_a"))
    out = join_on(pairs, totals, [a], "left")
    out = out.withColumn("share", F.col("n") / F.col("n_a"))
    return out if min_share is None else out.where(F.col("share") > min_share)


def graph_vertices(edges: DataFrame, src: str, dst: str, name: str = "name") -> DataFrame:
    """R3: vertices of an edge list, each endpoint once."""
    return (edges.select(F.col(src).alias(name))
                 .union(edges.select(F.col(dst).alias(name))).distinct())


__all__ = ["members_of", "member_sets", "cooccurrence", "context_counts", "cooccurrence_share",
           "graph_vertices", "network_vertices", "DEFAULT_CHUNK"]
