"""Relational building blocks with R's rules for NULL, order and joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def lookup(spark, data, schema) -> DataFrame:
    """A lookup table (stop list, lexicon) ready to join: a DataFrame as it
    is, or local rows -- a list of words or of tuples. No hint is given: a
    side that is small by its statistics is broadcast, any other is shuffled.
    """
    if isinstance(data, DataFrame):
        return data
    from quillspark.sources.tables import make_table
    return make_table(spark, [r if isinstance(r, tuple) else (r,) for r in data], schema)


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str] | Mapping[str, str],
            how: str = "inner", *, null_safe: bool = True) -> DataFrame:
    """Equi-join on named keys; ``{left: right}`` maps differently named keys.

    ``null_safe`` matches NULL to NULL as dplyr does; it still plans as a hash
    or sort-merge join. Right-side key columns are dropped, so the result has
    one column per key (``by=c(a="b")`` keeps ``a``).
    """
    pairs = list(keys.items()) if isinstance(keys, Mapping) else [(k, k) for k in keys]
    r = right
    renamed = {}
    for i, (_, rk) in enumerate(pairs):
        tmp = f"__rk{i}"
        r = r.withColumnRenamed(rk, tmp)
        renamed[rk] = tmp
    cond = None
    for lk, rk in pairs:
        lc, rc = left[lk], r[renamed[rk]]
        c = lc.eqNullSafe(rc) if null_safe else (lc == rc)
        cond = c if cond is None else (cond & c)
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return out
    if how in ("right", "right_outer", "full", "outer", "full_outer"):
        out = out.withColumns({lk: F.coalesce(F.col(lk), F.col(renamed[rk])) for lk, rk in pairs})
    return out.drop(*renamed.values())


#: A key is hot that holds more than one in this many rows; so there are fewer hot keys than that.
HOT_PARTS = 10_000


def join_totals(left: DataFrame, totals: DataFrame, key: str, rows: str, every: Column, *, parts: int = HOT_PARTS) -> DataFrame:
    """Joins to each row the ``totals`` of its ``key`` (one row per key, made from
    ``left`` itself; its column ``rows`` counts the key's rows, ``every`` all rows).

    Keys with more than one in ``parts`` of all rows are fewer than ``parts``, however
    large the table: these are broadcast, and their rows are dealt by a hash
    of the row and not by key. All other rows are joined on the key. NULL is a key.
    """
    values = [c for c in totals.columns if c != key]
    hot = totals.where(F.col(rows) * parts > every)
    hot = F.broadcast(hot.select(F.col(key).alias("__hk"), F.struct(*values).alias("__hot")))
    d = left.join(hot, left[key].eqNullSafe(hot["__hk"]), "left").drop("__hk")
    # rows of hot keys meet nothing here; the hash, of the key or of the row, deals them
    cold = F.col("__hot").isNull()
    d = d.withColumns({"__key": F.when(cold, F.col(key)), "__deal": F.when(cold, F.xxhash64(key)).otherwise(F.xxhash64(*left.columns))})
    rest = totals.select(F.col(key).alias("__ck"), F.xxhash64(key).alias("__cd"), F.struct(*values).alias("__cold"))
    d = d.join(rest, d["__key"].eqNullSafe(rest["__ck"]) & (d["__deal"] == rest["__cd"]), "left")
    return d.select(*left.columns, *[F.coalesce(F.col("__hot")[c], F.col("__cold")[c]).alias(c) for c in values])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns the two tables share (dplyr's default ``by``)."""
    common = [c for c in left.columns if c in right.columns]
    if not common:
        raise ValueError("natural_join: no common columns")
    return join_on(left, right, common, how)


def semi_in(df: DataFrame, col: str, other: DataFrame, other_col: str | None = None) -> DataFrame:
    """``filter(col %in% other$other_col)``: NULL matches NULL like ``%in%``."""
    return join_on(df, other.select(other_col or col).distinct(), {col: other_col or col}, "left_semi")


def anti(df: DataFrame, other: DataFrame, keys) -> DataFrame:
    """``anti_join``: rows of ``df`` without a match in ``other``."""
    return join_on(df, other, keys, "left_anti")


def arrange(df: DataFrame, *keys, collation: str | None = None) -> DataFrame:
    """``arrange``: NULL last in both directions. Keys are names (ascending),
    ``("name", "desc")`` pairs or columns. Text is in code-point order; with a
    ``collation`` (a Spark one: ``"UNICODE"``, ``"en"``, ``"de"``, ...) named text
    columns follow the locale, and texts equal there the code points."""
    cols = []
    for k in keys:
        if isinstance(k, Column):
            cols.append(k)
            continue
        name, direction = k if isinstance(k, tuple) else (k, "asc")
        by = [F.col(name)]
        if collation and isinstance(df.schema[name].dataType, StringType):
            by.insert(0, F.collate(name, collation))
        cols += [c.desc_nulls_last() if direction == "desc" else c.asc_nulls_last() for c in by]
    return df.orderBy(*cols)


def union_labelled(tables: Mapping[str, DataFrame], id_col: str) -> DataFrame:
    """``bind_rows(a=x, b=y, .id=id_col)``: stack by name, label the source,
    missing columns NULL."""
    out = None
    for label, t in tables.items():
        t = t.select(F.lit(label).alias(id_col), *t.columns)
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def union_by_name(*tables: DataFrame) -> DataFrame:
    """``bind_rows(x, y)``: UNION ALL by column name, missing columns NULL."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def pivot_fill(df: DataFrame, keys: Iterable[str], pivot_col: str, values: Sequence[str],
               value_col: str = "n", fill=0) -> DataFrame:
    """``spread(pivot_col, value_col, fill=0)``. The value list is passed, so
    the schema is fixed and no extra job discovers it."""
    out = df.groupBy(*keys).pivot(pivot_col, list(values)).agg(F.sum(value_col))
    return out.na.fill(fill, subset=list(values))


def first_n(df: DataFrame, col: str, n: int) -> DataFrame:
    """``x$col[1:n]`` of a selection, in ascending order of ``col``."""
    return df.orderBy(F.col(col).asc_nulls_last()).limit(n)


__all__ = ["lookup", "join_on", "join_totals", "natural_join", "semi_in", "anti", "arrange",
           "union_labelled", "union_by_name", "pivot_fill", "first_n"]
