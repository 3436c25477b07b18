"""Order-dependent operators that stay parallel when one sequence is huge.

R applies ``row_number``, ``lag``, ``lead``, ``na.locf`` and running counts
to the physical row order of one data frame. Spark has no physical order,
so every function here takes explicit keys:

* ``part``  -- columns naming one sequence (a work, a conversation); may be
  empty, then the whole table is one sequence;
* ``order`` -- columns ordering rows inside a sequence, unique per sequence.

A plain ``Window.partitionBy(part).orderBy(order)`` puts a whole sequence in
one task. Here the rows of a sequence are cut into blocks: a block holds
``block_size`` consecutive values of the last order column under one value of
the others, so never more than ``block_size`` rows. One window pass per block
does the local work; one summary row per block is scanned in the same way, by
blocks of blocks, then by blocks of the next order column, up to a scan over a
sequence's coarsest blocks; what each block inherits is joined back.

How many levels an order column takes depends on its type, so that no scan
holds more than ``block_size`` blocks under one value of the columns before,
however the values are spaced (consecutive, microseconds, hashed ids): one level
for int and shorter, three for bigint. A bigint column named as ``dense("turn")``
numbers things one by one and takes one. Order columns that are no integers
(timestamps, strings, decimals) are replaced by the places that Spark's range
partitioning with sampled bounds gives the rows.

The scan is one SQL statement. Rows, dealt by block, and the summaries of each
level are common table expressions that two later steps read. They hold a random
column, which nobody reads: Spark evaluates a non-deterministic common table
expression once, so the table is read once and shuffled once, with just the
columns that the steps and the caller need.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from quillspark.operators.relational import join_on
from quillspark.session import cut_lineage

DEFAULT_BLOCK = 1 << 16
_P = "__qs_"


class dense(str):
    """Name of an order column whose values lie close together, such as the
    numbers of lines or turns: a scan needs one level of blocks for it."""


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


class _Carried:
    """What is carried along a sequence, as columns of summaries.

    s sums; c counts of changes with f/l first and last value; d/u last and
    first non-NULL value; t/h last and first few values; n_ row counts. Values
    of changes and of t/h are wrapped, as NULL is a value there. w the first few
    different values. A prefixed p holds what stands before (s, c, d, t) or after
    (u, h) a summary in its group; w and the total are those of the sequence.
    """

    def __init__(self, running: int, changes: int, down: int, up: int, lags: Mapping[int, int], leads: Mapping[int, int], firsts: list[int], total: bool):
        self.s = [f"s{n}" for n in range(running)]
        self.c = [f"{n}" for n in range(changes)]
        self.d, self.u = [f"d{n}" for n in range(down)], [f"u{n}" for n in range(up)]
        self.t, self.h = {f"t{n}": k for n, k in lags.items()}, {f"h{n}": k for n, k in leads.items()}
        self.w = {f"w{n}": k for n, k in enumerate(firsts)}
        self.total = total

    def columns(self) -> list[str]:
        """Columns of a summary."""
        return [*self.s, *(x + n for n in self.c for x in "cfl"), *self.d, *self.u, *self.t, *self.h, *self.w, "n_"]

    def handed(self) -> list[str]:
        """Columns that a summary hands to its members."""
        return ["p" + x for x in [*self.s, *("c" + n for n in self.c), *self.d, *self.u, *self.t, *self.h, *self.w]] + ["total"] * self.total

    def prefixed(self, table: str, group: str, at: str, top: bool) -> str:
        """``table`` with the columns handed on, within ``group`` in the order ``at``."""
        w = f"(PARTITION BY {group} ORDER BY {at}"
        before, after = w + " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", w + " ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
        edge = [f"coalesce(cast(lag(l{n}) OVER {w}).v <> f{n}.v AS bigint), 0) AS e{n}" for n in self.c]
        cols = [f"coalesce(sum({x}) OVER {before}, 0) AS p{x}" for x in self.s]
        cols += [f"coalesce(sum(c{n} + e{n}) OVER {before}, 0) + e{n} AS pc{n}" for n in self.c]
        cols += [f"last({x}, true) OVER {before} AS p{x}" for x in self.d]
        cols += [f"first({x}, true) OVER {after} AS p{x}" for x in self.u]
        cols += [f"{_last(f'flatten(collect_list({x}) OVER {w} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING))', k)} AS p{x}" for x, k in self.t.items()]
        cols += [f"slice(flatten(collect_list({x}) OVER {w} ROWS BETWEEN 1 FOLLOWING AND {k} FOLLOWING)), 1, {k}) AS p{x}" for x, k in self.h.items()]
        if top:
            cols += [f"sum(n_) OVER (PARTITION BY {group}) AS total"] * self.total
        out = f"SELECT {', '.join(['*', *cols])} FROM (SELECT {', '.join(['*', *edge])} FROM {table})"
        if top and self.w:
            out = f"SELECT * FROM ({out}) JOIN (SELECT {', '.join([group, *self.different(at, 'p')])} FROM {table} GROUP BY {group}) USING ({group})"
        return out

    def different(self, at: str, prefix: str = "") -> list[str]:
        """Aggregates of the first different values of a group."""
        return [f"{_different(f'flatten(transform(sort_array(collect_list(struct(struct({at}) AS a, {x} AS x))), y -> y.x))', k)} AS {prefix}{x}" for x, k in self.w.items()]

    def fold(self, by: str) -> list[str]:
        """Aggregates that make one summary of those of a group, in the order ``by``."""
        at = f"struct({by})"
        aggs = [f"sum({x}) AS {x}" for x in self.s]
        for n in self.c:
            aggs += [f"sum(c{n} + e{n}) AS c{n}", f"min_by(f{n}, {at}) AS f{n}", f"max_by(l{n}, {at}) AS l{n}"]
        aggs += [f"max_by({x}, {at}) FILTER (WHERE {x} IS NOT NULL) AS {x}" for x in self.d]
        aggs += [f"min_by({x}, {at}) FILTER (WHERE {x} IS NOT NULL) AS {x}" for x in self.u]
        aggs += [f"max_by({_last(f'concat(p{x}, {x})', k)}, {at}) AS {x}" for x, k in self.t.items()]
        aggs += [f"min_by(slice(concat({x}, p{x}), 1, {k}), {at}) AS {x}" for x, k in self.h.items()]
        return [*aggs, *self.different(by), "sum(n_) AS n_"]

    def inherited(self) -> list[str]:
        """Columns handed on by a summary q that itself inherits from up."""
        cols = [f"q.p{x} + up.p{x} AS p{x}" for x in [*self.s, *("c" + n for n in self.c)]]
        cols += [f"coalesce(q.p{x}, up.p{x}) AS p{x}" for x in [*self.d, *self.u]]
        cols += [f"{_last(f'concat(up.p{x}, q.p{x})', k)} AS p{x}" for x, k in self.t.items()]
        cols += [f"slice(concat(q.p{x}, up.p{x}), 1, {k}) AS p{x}" for x, k in self.h.items()]
        return cols + [f"up.p{x} AS p{x}" for x in self.w] + ["up.total AS total"] * self.total


def _last(arr: str, k: int) -> str:
    """The last ``k`` elements."""
    return f"slice({arr}, greatest(size({arr}) - {k - 1}, 1), {k})"


def _different(arr: str, k: int) -> str:
    """The first ``k`` different elements."""
    return f"slice(array_distinct({arr}), 1, {k})"


def _block(value: str, width: int) -> str:
    """``value`` over ``width``, rounded down."""
    return f"(({value} div {width}) - CASE WHEN {value} % {width} < 0 THEN 1 ELSE 0 END)"


def _shared(name: str, key: str, columns: Iterable[str], source: str) -> str:
    """A common table expression dealt by ``key`` that is evaluated once.
    Its columns come in the order of their names, as in the plan's pruned reads,
    so that pruning changes nothing but the columns."""
    return f"{name} AS (SELECT /*+ REPARTITION({key}) */ {', '.join(sorted(columns))}, rand() AS zz FROM {source})"


def _places(df: DataFrame, part: list[str], order: list[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with two integral columns that order the rows like ``order``."""
    return _ranged(df, part + order), [dense(_P + "pid"), dense(_P + "idx")]


def ordered_scan(df: DataFrame, part: Iterable[str], order: Iterable[str], *,
                 running: Mapping[str, tuple] | None = None,
                 changes: Mapping[str, str] | None = None,
                 fill_down: Iterable[str] = (), fill_up: Iterable[str] = (),
                 shifts: Mapping[str, tuple] | None = None,
                 group_total: str | None = None, firsts: Mapping[str, tuple] | None = None,
                 block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Running sums, fills and neighbours along an ordered sequence, block-parallel.

    running     -- ``{name: (value_column, inclusive)}``: cumulative sum of the
                   value over rows before (and, if inclusive, at) each row;
                   0 for an empty prefix.
    changes     -- ``{name: column}``: how often the column's value has differed
                   from the row before, up to the row (a NULL differs from none).
    fill_down   -- columns replaced by the last non-NULL value at or before
                   the row (``na.locf``); leading NULLs stay NULL.
    fill_up     -- columns replaced by the first non-NULL value at or after
                   the row (``na.locf(fromLast=TRUE)``).
    shifts      -- ``{name: (column, k)}``: the column's value ``k`` rows before
                   (k > 0) or after (k < 0), NULL beyond the ends.
    group_total -- name of a column holding the row count of the sequence.
    firsts      -- ``{name: (column, k)}``: array of the column's first ``k``
                   different values in the sequence (``unique(x)[1:k]``, no NULL).
    """
    part, order, columns = list(part), list(order), list(df.columns)
    running, changes, shifts, firsts = dict(running or {}), dict(changes or {}), dict(shifts or {}), dict(firsts or {})
    fill_down, fill_up = list(fill_down), list(fill_up)
    if any(not isinstance(df.schema[c].dataType, ByteType | ShortType | IntegerType | LongType) for c in order):
        df, order = _places(df, part, order)
    levels = [3 if isinstance(df.schema[c].dataType, LongType) and not isinstance(c, dense) else 1 for c in order]

    # plain names: c columns, o order, v values summed; k the block of a row
    at = {c: f"c{n:04d}" for n, c in enumerate(columns)}
    o, p = [f"o{n}" for n in range(len(order))], [f"p{n}" for n in range(len(part))]
    v = [f"v{n}" for n in range(len(running))]
    d = df.select(*[F.col(c).alias(a) for c, a in at.items()], *[F.col(c).cast("long").alias(a) for c, a in zip(order, o)],
                  *[F.col(c).alias(a) for c, a in zip(part, p)], *[_lit(x).alias(a) for (x, _), a in zip(running.values(), v)])
    fields = ", ".join(f"'{a}', {a}" for a in p) or "'p', 1"
    key = lambda j, width: f"named_struct({', '.join([fields, *(f'{chr(39)}o{n}{chr(39)}, o{n}' for n in range(j))])}, 'b', {_block(o[j], width)})"

    number = {c: n for n, c in enumerate(dict.fromkeys(c for c, _ in shifts.values()))}
    far = lambda sign: {n: max(sign * k for s, k in shifts.values() if s == c and sign * k > 0)
                        for c, n in number.items() if any(s == c and sign * k > 0 for s, k in shifts.values())}
    carried = _Carried(len(running), len(changes), len(fill_down), len(fill_up), far(1), far(-1), [k for _, k in firsts.values()], group_total is not None)

    # rows with what their own block tells
    w = f"(PARTITION BY k ORDER BY {', '.join(o)}"
    upto, onwards = w + " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)", w + " ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    local = [f"coalesce(sum({x}) OVER {upto}, 0) AS r{n}" for n, x in enumerate(v)]
    local += [f"coalesce(cast(lag({at[c]}) OVER {w}) <> {at[c]} AS bigint), 0) AS x{n}" for n, c in enumerate(changes.values())]
    local += [f"last({at[c]}, true) OVER {upto} AS a{n}" for n, c in enumerate(fill_down)]
    local += [f"first({at[c]}, true) OVER {onwards} AS b{n}" for n, c in enumerate(fill_up)]
    local += [f"{'lag' if k > 0 else 'lead'}({at[c]}, {abs(k)}) OVER {w}) AS z{n}" for n, (c, k) in enumerate(shifts.values())]
    if shifts:
        local += [f"row_number() OVER {w}) AS i", "count(*) OVER (PARTITION BY k) AS m"]
    changed = ["*", *[f"sum(x{n}) OVER {upto} AS y{n}" for n in range(len(changes))]]
    with_ = [_shared("r", "k", [*d.columns, "k"], f"(SELECT *, {key(len(o) - 1, block_size)} AS k FROM {{d}})")]
    rows = f"(SELECT {', '.join(changed)} FROM (SELECT {', '.join(['*', *local])} FROM r))"

    # block summaries; those of plain aggregates need no window
    place = f"struct({', '.join(o)})"
    aggs = [f"coalesce(sum({x}), 0) AS s{n}" for n, x in enumerate(v)]
    for n, c in enumerate(changes.values()):
        aggs += [f"sum(x{n}) AS c{n}", f"min_by(named_struct('v', {at[c]}), {place}) AS f{n}", f"max_by(named_struct('v', {at[c]}), {place}) AS l{n}"]
    aggs += [f"max_by({at[c]}, {place}) FILTER (WHERE {at[c]} IS NOT NULL) AS d{n}" for n, c in enumerate(fill_down)]
    aggs += [f"min_by({at[c]}, {place}) FILTER (WHERE {at[c]} IS NOT NULL) AS u{n}" for n, c in enumerate(fill_up)]
    few = lambda n, cond, out: (f"transform(sort_array(collect_list(named_struct('i', i, 'v', {at[n]})) FILTER (WHERE {cond})), "  # noqa: E731
                                f"x -> named_struct('v', x.v)) AS {out}")
    aggs += [few(c, f"i > m - {carried.t[f't{n}']}", f"t{n}") for c, n in number.items() if f"t{n}" in carried.t]
    aggs += [few(c, f"i <= {carried.h[f'h{n}']}", f"h{n}") for c, n in number.items() if f"h{n}" in carried.h]
    listed = lambda a: f"transform(sort_array(collect_list(struct({place} AS a, {a} AS x)) FILTER (WHERE {a} IS NOT NULL)), y -> y.x)"
    aggs += [f"{_different(listed(at[c]), k)} AS w{n}" for n, (c, k) in enumerate(firsts.values())]
    with_.append(f"s0 AS (SELECT k, {', '.join([*aggs, 'count(*) AS n_'])} FROM {rows} GROUP BY k)")

    # up: of each level the group of its summaries (g) and their order in it
    members: list[str] = []
    steps = [(j, block_size ** n) for j in reversed(range(len(o))) for n in range(1, levels[j] + 1)]
    for n, (j, width) in enumerate(steps):
        top = n + 1 == len(steps)
        if top:
            group, inner = (f"named_struct({', '.join(f'{chr(39)}{a}{chr(39)}, k.{a}' for a in p)})" if p else "0"), "k.b"
        else:
            up, wide = steps[n + 1]
            kept = [f"'{a}', k.{a}" for a in p or ["p"]] + [f"'{a}', k.{a}" for a in o[:up]]
            block = _block("k.b", block_size) if up == j else _block(f"k.{o[up]}", wide)
            group, inner = f"named_struct({', '.join([*kept, f'{chr(39)}b{chr(39)}, {block}'])})", "k.b" if up == j else f"k.{o[up]}, k.b"
        with_.append(_shared(f"g{n}", "g", [*carried.columns(), "g", "k"], f"(SELECT *, {group} AS g FROM s{n})"))
        members.append(f"({carried.prefixed(f'g{n}', 'g', inner, top)})")
        if not top:
            with_.append(f"s{n + 1} AS (SELECT g AS k, {', '.join(carried.fold(inner))} FROM {members[n]} GROUP BY g)")
    # down: each level inherits from the coarser one
    last = len(steps) - 1
    with_.append(f"u{last} AS (SELECT {', '.join(['k', *carried.handed()])} FROM {members[last]})")
    for n in reversed(range(last)):
        with_.append(f"u{n} AS (SELECT {', '.join(['q.k AS k', *carried.inherited()])} FROM {members[n]} q JOIN u{n + 1} up ON q.g = up.k)")

    new = {}
    for n, (name, (_, inclusive)) in enumerate(running.items()):
        new[name] = f"r{n} + ps{n}" if inclusive else f"r{n} - coalesce(v{n}, 0) + ps{n}"
    new |= {name: f"y{n} + pc{n}" for n, name in enumerate(changes)}
    new |= {c: f"coalesce(a{n}, pd{n})" for n, c in enumerate(fill_down)}
    new |= {c: f"coalesce(b{n}, pu{n})" for n, c in enumerate(fill_up)}
    for n, (name, (c, k)) in enumerate(shifts.items()):
        if k > 0:
            new[name] = f"CASE WHEN i > {k} THEN z{n} ELSE get(pt{number[c]}, cast(size(pt{number[c]}) - ({k + 1} - i) AS int)).v END"
        elif k < 0:
            new[name] = f"CASE WHEN m - i >= {-k} THEN z{n} ELSE get(ph{number[c]}, cast({-k - 1} - (m - i) AS int)).v END"
        else:
            new[name] = at[c]
    new |= {name: f"pw{n}" for n, name in enumerate(firsts)}
    if group_total:
        new[group_total] = "total"
    shown = {c: new.get(c, at[c]) for c in columns} | new
    out = ", ".join(f"{x} AS q{n:04d}" for n, x in enumerate(shown.values()))
    handed = ", ".join(f"u0.{x}" for x in carried.handed())
    body = f"SELECT {out} FROM (SELECT x.*, {handed} FROM {rows} x JOIN u0 ON x.k = u0.k)"
    return df.sparkSession.sql(f"WITH {', '.join(with_)} {body}", d=d).toDF(*shown)


def number_rows(df: DataFrame, part, order, name: str = "row_no", *,
                group_total: str | None = None, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``row_number()`` per sequence (1..n), optionally with ``n()``."""
    return ordered_scan(df, part, order, running={name: (F.lit(1), True)},
                        group_total=group_total, block_size=block_size)


def shift(df: DataFrame, part, pos: str, shifts: Mapping[str, tuple], *,
          block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Lag/lead columns by the order column ``pos``: ``{new_name:
    (source_column, k)}``; ``k > 0`` is ``lag(col, k)``, ``k < 0`` is
    ``lead(col, -k)``, NULL beyond the ends; any distance."""
    return ordered_scan(df, part, [pos], shifts=shifts, block_size=block_size)


def _ranged(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` sorted over all partitions by Spark's range partitioning, with
    the partition (``__qs_pid``) and the place in it (``__qs_idx``). The
    result is written to the shared folder, so every use of it sees the same
    partitions."""
    d = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_P + "seq", F.monotonically_increasing_id())
    d = cut_lineage(d)
    return d.select(*df.columns, F.shiftright(_P + "seq", 33).alias(_P + "pid"), F.col(_P + "seq").bitwiseAND((1 << 33) - 1).alias(_P + "idx"))


def sorted_row_number(df: DataFrame, part, order, name: str = "row_no") -> DataFrame:
    """``row_number()`` per ``part`` by any sortable ``order`` (rows unique
    on part + order), with no assumption on how the order values are spread.

    Meant for small distinct tables (levels, first appearances): the rows are
    range-partitioned on part + order, and a row's number is its place in the
    partition plus the sizes of the sequence's earlier partitions.
    """
    part, order = list(part), list(order)
    pid, idx, start, off = _P + "pid", _P + "idx", _P + "start", _P + "off"
    d = _ranged(df, part + order)
    sizes = d.groupBy(*part, pid).agg(F.count(F.lit(1)).alias(_P + "size"), F.min(idx).alias(start))
    earlier = Window.partitionBy(*part).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select(*part, pid, start, F.coalesce(F.sum(_P + "size").over(earlier), F.lit(0)).alias(off))
    out = join_on(d, sizes, [*part, pid])
    return out.select(*df.columns, (F.col(off) + F.col(idx) - F.col(start) + 1).alias(name))


def nested_row_number(df: DataFrame, outer: str, inner_order, name: str = "row_no", *,
                      block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """``row_number()`` over the whole table ordered by ``(outer, inner_order...)``
    (``mutate(rownumber = 1:nrow(x))`` on a table of many sequences).

    By an integral ``outer`` the whole table is one sequence of a scan. By any
    other, rows are numbered inside each ``outer`` sequence; the sequences' sizes
    (one row each) are range-partitioned on ``outer`` and summed up within the
    partitions; one row per partition is summed up over them. A NULL ``outer``
    is a sequence of its own, the first.
    """
    if isinstance(df.schema[outer].dataType, ByteType | ShortType | IntegerType | LongType):
        return number_rows(df, [], [outer, *inner_order], name, block_size=block_size)
    inner = number_rows(df, [outer], inner_order, _P + "rin", block_size=block_size)
    sizes = _ranged(df.groupBy(outer).agg(F.count(F.lit(1)).alias(_P + "nin")), [outer])
    pid = _P + "pid"
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    whole = sizes.groupBy(pid).agg(F.sum(_P + "nin").alias(_P + "sum"))
    whole = whole.select(pid, F.coalesce(F.sum(_P + "sum").over(earlier(Window.orderBy(pid))), F.lit(0)).alias(_P + "base"))  # one row per partition
    within = F.coalesce(F.sum(_P + "nin").over(earlier(Window.partitionBy(pid).orderBy(_P + "idx"))), F.lit(0))
    offsets = sizes.withColumn(_P + "off", within).join(whole, pid).select(outer, (F.col(_P + "off") + F.col(_P + "base")).alias(_P + "off"))
    out = join_on(inner, offsets, [outer])
    return out.withColumn(name, F.col(_P + "off") + F.col(_P + "rin")).select(*df.columns, name)


def alphabetical_code(df: DataFrame, level: str, name: str = "code", *, collation: str | None = None) -> DataFrame:
    """Codes of the distinct values of ``level`` in sorted order (1, 2, ...),
    ``as.numeric(factor(x))`` with R's default (sorted) levels; NULL is no
    level. Text is in code-point order (R's C locale) or, as R sorts levels in any
    other locale, in that of a Spark ``collation`` (``"en"``, ``"de"``, ...); values
    that the collation takes as equal stay levels of their own, by code point.
    No step holds all values in one task.
    """
    d = df.select(level).where(F.col(level).isNotNull()).distinct()
    if collation is None:
        return sorted_row_number(d, [], [level], name)
    d = d.withColumn(_P + "sort", F.collate(level, collation))
    return sorted_row_number(d, [], [_P + "sort", level], name).select(level, name)


def first_seen_code(df: DataFrame, part, order, level: str, name: str = "code") -> DataFrame:
    """Level code by first appearance: ``as.numeric(factor(x, levels=unique(x)))``.

    Returns one row per (part, level) with the code. NULL is no level (R's
    factor leaves NA out), so a left join back gives NULL codes for it.
    """
    part, order = list(part), list(order)
    first = (df.where(F.col(level).isNotNull()).groupBy(*part, level)
               .agg(F.min(F.struct(*[F.col(c) for c in order])).alias(_P + "first")))
    okeys = [_P + "o_" + c for c in order]
    first = first.select(*part, level, *[F.col(_P + "first")[c].alias(k) for c, k in zip(order, okeys)])
    coded = sorted_row_number(first, part, okeys, name)
    return coded.select(*part, level, name)


__all__ = ["ordered_scan", "dense", "number_rows", "nested_row_number", "sorted_row_number", "alphabetical_code", "shift", "first_seen_code", "DEFAULT_BLOCK"]
