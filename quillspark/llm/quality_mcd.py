"""Quality rules with robust multivariate outliers (operator 8).

Per text: words, characters in words, symbols, repeated lines and repeated
three-word windows. Documents that pass two plain rules are described by a
vector of transformed statistics; per language and source a minimum covariance
determinant estimate gives location and scatter, and a vector whose squared
Mahalanobis distance exceeds ``CUTOFF`` is rejected.

Large groups are estimated as FastMCD does: every group falls by hash into
subsets of about ``SUBSET`` rows, each subset finds its half of smallest
determinant by C-steps, the subset estimates are averaged, and one reweighting
step over all rows of the group gives the final estimate. So no task holds a
group, however many rows it has, and all rows take part. Where a group
has fewer than ``MIN_GROUP`` rows, its rows are judged by the estimate over all
sources of its language, and where the language has fewer, by the one over all rows.

Defined cases: a null or blank text has no words and fails the base rule; null
languages and sources form groups of their own; rows that repeat an id are
judged each; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import cut, mix, row_words, segments, text_buffers, word_hashes

MIN_WORDS, MAX_REPEAT_PCT = 50, 50
SUBSET, MIN_GROUP, KEEP = 2048, 64, 0.75
#: Squared distance beyond which a vector is an outlier: the 0.999999 quantile
#: of chi-square with five degrees of freedom.
CUTOFF = 35.888
#: Least scale of each transformed statistic, for those that are mostly 0. In a
#: group without spread a text goes from 6 times (or a sixth of) the words, 1.6 times
#: the word length, 5 symbols in 100 words, 10 % repeated lines or 10 % repeated words.
FLOOR = (0.3, 0.08, 0.3, 0.4, 0.4)
DIM = len(FLOOR)

_EXACT = np.arange(256, dtype=np.uint64) + np.uint64(1)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_NOT_NEWLINE = np.zeros(256, bool)
_NOT_NEWLINE[10] = True
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


def _again(keys: np.ndarray):
    """(is a later occurrence, occurs twice or more) of each key."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, bool)
    same[1:-1] = s[1:] == s[:-1]
    later, twice = np.zeros(len(s), bool), np.zeros(len(s), bool)
    later[order] = same[:-1]
    twice[order] = same[:-1] | same[1:]
    return later, twice


def row_stats(column) -> list[np.ndarray]:
    """The six statistics of every text of an Arrow string column."""
    data, off = text_buffers(column)
    n = len(off) - 1
    out = [np.zeros(n, np.int64) for _ in range(6)]
    for i, j in segments(off):
        if off[i] == off[j]:
            continue
        rows = np.arange(i, j)
        h, first, s, e = row_words(data, off, i, j, table=_EXACT)
        lo, hi = int(off[i]), int(off[j])
        part = data[lo:hi]
        count = lambda at, o=off[i:j + 1] - lo: np.diff(np.concatenate(([0], np.cumsum(at, dtype=np.int64)))[o])
        out[0][i:j] = np.diff(first)
        starts_char = (part & 0xC0) != 0x80
        inside = np.zeros(hi - lo + 1, np.int64)
        np.add.at(inside, s - lo, 1)
        np.add.at(inside, e - lo, -1)
        out[1][i:j] = count(starts_char & (np.cumsum(inside[:-1]) > 0))
        out[2][i:j] = count(_SYMBOL[part])
        # lines: spans between newlines and row ends
        cuts = np.concatenate((off[i:j], np.flatnonzero(part == 10) + lo + 1))
        starts = np.unique(cuts)
        ends = np.append(starts[1:], hi)
        ends = ends - ((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10))
        row = np.searchsorted(off, starts, side="right") - 1
        has = np.searchsorted(s, ends) > np.searchsorted(s, starts)
        starts, ends, row = starts[has], ends[has], row[has]
        if len(starts):
            line = word_hashes(data, starts, ends, _EXACT)
            later, _ = _again(line ^ mix(row.astype(np.uint64), 7))
            out[3][i:j] = np.bincount(row[later] - i, minlength=j - i)
            out[4][i:j] = np.bincount(row - i, minlength=j - i)
        if len(h) >= 3:
            word_row = np.repeat(rows, np.diff(first))
            tri = mix(h[:-2], 1) + mix(h[1:-1], 2) * np.uint64(3) + mix(h[2:], 3) * np.uint64(5)
            inner = word_row[:-2] == word_row[2:]
            at = np.flatnonzero(inner)
            _, twice = _again(tri[at] ^ mix(word_row[at].astype(np.uint64), 9))
            hit = np.zeros(len(h), bool)
            for k in range(3):
                hit[at[twice] + k] = True
            out[5][i:j] = np.bincount(word_row[hit] - i, minlength=j - i)
    return out


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    d = docs.select(id_col, *keep, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in d.schema[:-1]) + ", " + STATS
    names = [*d.columns[:-1], *[c.split()[0] for c in STATS.split(", ")]]

    def run(batches):
        for b in batches:
            got = row_stats(b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], *[pa.array(g) for g in got]], names=names)

    return d.mapInArrow(run, schema)


def vector() -> list:
    """Transformed statistics."""
    n = F.col("n_words")
    return [F.log(n + 1.0), F.log((F.col("word_chars") + 1) / (n + 1)), F.log1p(100 * F.col("n_symbols") / n),
            F.log1p(100 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))), F.log1p(100 * F.col("n_repeat_words") / n)]


def _distances(x, mean, cov):
    inv = np.linalg.inv(cov)
    d = x - mean
    return np.einsum("ij,jk,ik->i", d, inv, d)


def _scatter(x):
    return x.mean(axis=0), (np.cov(x, rowvar=False, bias=True) if len(x) > 1 else np.zeros((DIM, DIM))) + np.diag(np.square(FLOOR))


def mcd(x: np.ndarray, keep: float = KEEP, steps: int = 30):
    """Location and scatter of the rows of smallest determinant, by C-steps
    from the medians and median deviations. Ties go to the first rows."""
    mid = np.median(x, axis=0)
    scale = np.maximum(1.4826 * np.median(np.abs(x - mid), axis=0), FLOOR)
    mean, cov, h, before = mid, np.diag(scale ** 2), max(1, math.ceil(keep * len(x))), math.inf
    for _ in range(steps):
        mean, cov = _scatter(x[np.argsort(_distances(x, mean, cov), kind="stable")[:h]])
        det = np.linalg.slogdet(cov)[1]
        if det >= before - 1e-12:
            break
        before = det
    return mean, cov


_NAMES = [f"m{i}" for i in range(DIM)] + [f"c{i}_{j}" for i in range(DIM) for j in range(i, DIM)]
_UPPER = np.triu_indices(DIM)


def _pack(mean, cov):
    return [*map(float, mean), *map(float, cov[_UPPER])]


def _unpack(row):
    v = np.array([row[c] for c in _NAMES], float)
    cov = np.zeros((DIM, DIM))
    cov[_UPPER] = v[DIM:]
    return v[:DIM], cov + np.triu(cov, 1).T


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", subset: int = SUBSET, min_group: int = MIN_GROUP, cutoff: float = CUTOFF) -> DataFrame:
    """Statistics, base verdict, squared distance (null if the base rule
    failed) and ``kept`` of every document."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                    F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    s = text_stats(d).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))
    s = cut(s.withColumn("_row", F.monotonically_increasing_id()))
    v = s.where("not base_failed").select("_row", F.xxhash64("doc_id", "n_words", "word_chars").alias("_hash"), "lang", "source", *[x.alias(f"x{k}") for k, x in enumerate(vector())])
    size = v.groupBy("lang", "source").agg(F.count("*").alias("n")).withColumn("small", F.col("n") < min_group)
    langs = cut(size.groupBy(F.col("lang").alias("l")).agg((F.sum("n") < min_group).alias("few"), F.max("small").alias("asked")))
    over_all = langs.where("few").limit(1).count() > 0
    named = lambda kind, *c: F.concat(F.lit(kind), F.to_json(F.struct(*c)))
    own, wide = named("group", "lang", "source"), named("lang", "lang")
    size = size.join(langs, F.col("lang").eqNullSafe(F.col("l"))).select(
        F.col("lang").alias("l"), F.col("source").alias("s"), "n",
        F.when(~F.col("small"), own).when(~F.col("few"), wide).otherwise("pooled").alias("judge"),
        # estimates that the rows take part in
        F.explode(F.array_compact(F.array(F.when(~F.col("small"), own), F.when(F.col("asked") & ~F.col("few"), wide),
                                          F.lit("pooled" if over_all else None).cast("string")))).alias("grp"))
    size = cut(size.withColumn("judged", F.col("grp") == F.col("judge")))
    groups = cut(size.groupBy("grp").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") / subset)).alias("parts")))
    size = size.join(groups, "grp")
    v = (v.join(size, v["lang"].eqNullSafe(size["l"]) & v["source"].eqNullSafe(size["s"]))
         .select("grp", "judged", F.pmod("_hash", F.col("parts")).alias("part"), "_row", "_hash", *[f"x{k}" for k in range(DIM)]))
    v = cut(v)
    cols = [f"x{k}" for k in range(DIM)]
    shape = "grp string, part long, " + ", ".join(f"{c} double" for c in _NAMES)

    def first(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([[p["grp"].iloc[0], p["part"].iloc[0], *_pack(*mcd(p.sort_values(["_hash", *cols])[cols].to_numpy()))]],
                            columns=["grp", "part", *_NAMES])

    raw = v.groupBy("grp", "part").applyInPandas(first, shape).groupBy("grp").agg(*[F.avg(c).alias(c) for c in _NAMES])
    spread = lambda e: cut(e.join(groups, "grp").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts"))

    def reweigh(p: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        x = p[cols].to_numpy()
        mean, cov = _unpack(e.iloc[0])
        x = x[_distances(x, mean, cov) <= 20.0]  # about the 0.999 quantile of chi-square, five degrees of freedom
        prod = x.T @ x
        return pd.DataFrame([[p["grp"].iloc[0], float(len(x)), *map(float, x.sum(axis=0)), *map(float, prod[_UPPER])]], columns=["grp", "n", *_NAMES])

    raw = spread(raw)
    sums = (v.groupBy("grp", "part").cogroup(raw.groupBy("grp", "part"))
            .applyInPandas(reweigh, "grp string, n double, " + ", ".join(f"{c} double" for c in _NAMES))
            .groupBy("grp").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in _NAMES]).where("n > 0"))
    means = [(F.col(f"m{i}") / F.col("n")).alias(f"m{i}") for i in range(DIM)]
    covs = [(F.col(f"c{i}_{j}") / F.col("n") - F.col(f"m{i}") / F.col("n") * F.col(f"m{j}") / F.col("n")
             + (FLOOR[i] ** 2 if i == j else 0.0)).alias(f"c{i}_{j}") for i in range(DIM) for j in range(i, DIM)]
    final = spread(sums.select("grp", *means, *covs))

    def last(p: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        p = p[p["judged"]]
        dist = _distances(p[cols].to_numpy(), *_unpack(e.iloc[0])) if len(e) else np.zeros(len(p))
        return pd.DataFrame({"_row": p["_row"], "distance": dist})

    dist = v.groupBy("grp", "part").cogroup(final.groupBy("grp", "part")).applyInPandas(last, "_row long, distance double")
    return (s.join(dist, "_row", "left").drop("_row")
            .withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)))
