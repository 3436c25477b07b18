"""Candidate pairs and bounded cells for similarity joins.

Rows that share a key (an inverted list, a block of a fingerprint) are
candidates of each other. Short lists become pairs; lists that are too long to
be paired stay lists (``kind`` 1: u is the list, v a member). Pairs and lists
are gathered into groups, and groups are cut into squares of two chunks of
bounded weight, so that a group of any size is compared whole, by many tasks.
Lists with much the same members can share a group, so that these members
travel once and not once a list.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import cut

MET = "kind byte, u long, v long, m int"


def pairs_of_runs(batches, most: int, percent: int):
    """Pairs of each key's list, from batches (key, id, size) sorted by key;
    sizes must be within ``percent`` of each other, m is the smaller. Lists
    longer than ``most`` come out as lists, however many batches they span."""
    kept, length, streamed = None, 0, None  # the list at the end of a batch may go on; its length if it is being streamed
    for b in batches:
        t, c, n = (np.asarray(b.column(k)) for k in range(3))
        if kept is not None:
            t, c, n = (np.concatenate(y) for y in zip(kept, (t, c, n)))
        kept = None
        if not len(t):
            continue
        at = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        end = np.append(at[1:], len(t))
        if length and t[0] == streamed:
            yield _listed(t[:end[0]], c[:end[0]])
            if len(at) == 1:
                continue
            at, end = at[1:], end[1:]
        length, last = 0, at[-1]
        if len(t) - last > most:  # streamed from now on
            yield _listed(t[last:], c[last:])
            length, streamed = len(t) - last, t[last]
        else:
            kept = (t[last:], c[last:], n[last:])
        yield from _pairs(t, c, n, at[:-1], end[:-1], most, percent)
    if kept is not None:
        yield from _pairs(*kept, np.array([0]), np.array([len(kept[0])]), most, percent)


def _met(kind, u, v, m):
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int8)), pa.array(u), pa.array(v), pa.array(m)], names=["kind", "u", "v", "m"])


def _listed(key, ids):
    return _met(1, key, ids, np.zeros(len(ids), np.int32))


def _pairs(t, c, n, at, end, most, percent):
    size = end - at
    for k in np.unique(size[size > 1]):
        starts = at[size == k]
        if k > most:
            rows = (starts[:, None] + np.arange(k)).ravel()
            yield _listed(t[rows], c[rows])
            continue
        i, j = np.triu_indices(k, 1)
        for lot in np.array_split(starts, max(1, len(starts) * len(i) // 500_000)):
            p, q = (lot[:, None] + i).ravel(), (lot[:, None] + j).ravel()
            low, high = np.minimum(n[p], n[q]), np.maximum(n[p], n[q])
            ok = (c[p] != c[q]) & (100 * low.astype(np.int64) >= percent * high.astype(np.int64))
            p, q = p[ok], q[ok]
            if len(p):
                yield _met(0, np.minimum(c[p], c[q]), np.maximum(c[p], c[q]), np.minimum(n[p], n[q]))


def runs_of(batches, columns: int):
    """Rows of equal first column of sorted batches, as lists of columns."""
    key, held = None, [[] for _ in range(columns)]
    for b in batches:
        keys = b.column(0).to_pylist()
        at = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
        values = [b.column(k + 1).to_pylist() for k in range(columns)]
        for lo, hi in zip(at, at[1:]):
            if lo == hi:
                continue
            if keys[lo] != key and key is not None:
                yield key, held
                held = [[] for _ in range(columns)]
            key = keys[lo]
            for h, v in zip(held, values):
                h.extend(v[lo:hi])
    if key is not None:
        yield key, held


def grouped_pairs(pairs: DataFrame) -> DataFrame:
    """``(grp, u, v)`` from ``pairs(u, v)``: a pair meets in the group of the
    smallest partner of its smaller end, so the pairs of a clique share one."""
    low = (pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).groupBy("u").agg(F.min("v").alias("m"))
           .select("u", F.least("u", "m").alias("m")))
    return pairs.join(low, "u").select(F.xxhash64("m", F.lit("pair")).alias("grp"), "u", "v")


def pair_groups(pairs: DataFrame) -> DataFrame:
    """``(grp, id)`` from ``pairs(u, v)``: the ends of ``grouped_pairs``."""
    return grouped_pairs(pairs).select("grp", F.explode(F.array("u", "v")).alias("id"))


def list_groups(lists: DataFrame) -> DataFrame:
    """``(grp, id)`` from ``lists(list, id)``."""
    return lists.select(F.xxhash64("list", F.lit("list")).alias("grp"), "id")


def bundle_groups(lists: DataFrame, near: int = 4, part: int = 4) -> DataFrame:
    """``(grp, id)`` from materialised, distinct ``lists(list, id, weight)``:
    like ``list_groups``, but lists are bundled where a list of many copies
    would come once for each passage that they share. A list follows the
    smallest list that holds one ``part``-th of its members or more, as far as
    every member's ``near`` smallest lists tell. All pairs of a bundle must be
    no more work than those of its lists, else these stay alone."""
    first = lists.groupBy("id").agg(F.slice(F.array_sort(F.collect_set("list")), 1, near).alias("first"))
    both = lists.join(first, "id").select("list", F.explode("first").alias("lead")).groupBy("list", "lead").agg(F.count("*").alias("both"))
    size = lists.groupBy("list").agg(F.count("*").alias("c"), F.sum(F.col("weight").cast("double")).alias("alone"))
    lead = both.join(size, "list").where(F.col("both") * part >= F.col("c")).groupBy("list").agg(F.min("lead").alias("lead"))
    lead = cut(size.join(lead, "list", "left").select("list", "alone", F.coalesce("lead", "list").alias("lead")))
    alone = lead.groupBy("lead").agg(F.sum(F.col("alone") * F.col("alone")).alias("alone"))
    bundle = (lists.join(lead.select("list", "lead"), "list").groupBy("lead", "id").agg(F.max("weight").alias("weight"))
              .groupBy("lead").agg(F.sum(F.col("weight").cast("double")).alias("whole")))
    worth = bundle.join(alone, "lead").where(F.col("whole") * F.col("whole") <= F.col("alone")).select("lead", F.lit(True).alias("worth"))
    name = lead.join(worth, "lead", "left").select("list", F.when(F.col("worth"), F.xxhash64("lead", F.lit("bundle")))
                                                   .otherwise(F.xxhash64("list", F.lit("list"))).alias("grp"))
    return lists.join(name, "list").select("grp", "id").distinct()


def squares(grouped: DataFrame, bound: int) -> DataFrame:
    """``(cell, id, side)`` from ``grouped(grp, id, weight)``: each group in
    squares of two chunks of about ``bound`` weight. Within a cell sides 0
    meet sides 1, and sides 2 meet each other."""
    members = grouped.groupBy("grp", "id").agg(F.max("weight").alias("weight"))
    size = members.groupBy("grp").agg(F.ceil(F.sum("weight") / bound).alias("chunks"), F.count("*").alias("c")).where("c > 1").drop("c")
    members = members.join(size, "grp").withColumn("i", F.pmod(F.xxhash64("id"), F.col("chunks")))
    members = members.select("grp", "id", "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("j"))
    return members.select(F.xxhash64("grp", F.least("i", "j"), F.greatest("i", "j")).alias("cell"), "id",
                          F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1).alias("side"))
