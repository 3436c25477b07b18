"""Embedding near-duplicates by iterative quantisation (operator 9).

Rotations that balance binary codes are learned by ITQ on a bounded sample of
``SAMPLE`` vectors; every vector is coded. Substrings of the codes are the
keys of the multi-index Hamming tables: two codes of 64 bits that differ in
fewer bits than there are substrings agree in one of them. Vectors of cosine
0.9 differ in more bits, so ``ROTATIONS`` codes are made, as many as let over
nine in ten such pairs meet (README). Vectors that meet
under a key are reranked by the cosine of the original vectors, in blocks of
``BLOCK`` against ``BLOCK`` rows, so a key that a third of all rows share is
compared whole by many tasks. A pair counts in the first table in which it
meets. Blocks return link counts and a spanning forest, never pairs.

Defined cases: vectors that are null, zero, of another length than the
sample's commonest, or hold null or non-finite components link with nothing;
rows that repeat an id are vectors of their own; a null id is kept and names
no component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import components, cut, mix

SAMPLE, ROTATIONS, ROUNDS, BITS, BLOCK, COSINE = 20_000, 8, 40, 16, 1024, 0.9


def usable(col) -> F.Column:
    """Whether an array column is a vector with a direction."""
    d = F.transform(col, lambda x: x.cast("double"))
    fine = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(col.isNotNull() & fine & F.exists(d, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def learn(x: np.ndarray, rotations: int = ROTATIONS, rounds: int = ROUNDS, seed: int = 7) -> tuple[np.ndarray, list[np.ndarray]]:
    """Mean of the unit vectors and ``rotations`` projections to balanced bits."""
    mean = x.mean(axis=0)
    z = x - mean
    _, axes = np.linalg.eigh(z.T @ z)
    axes = axes[:, ::-1][:, :64]
    z = z @ axes
    rng, out = np.random.default_rng(seed), []
    for _ in range(rotations):
        r = np.linalg.qr(rng.normal(size=(z.shape[1], z.shape[1])))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(z @ r >= 0, 1.0, -1.0).T @ z)
            r = (u @ v).T
        out.append(axes @ r)
    return mean, out


def substrings(x: np.ndarray, mean: np.ndarray, projections: list[np.ndarray], bits: int = BITS) -> np.ndarray:
    """A column of integers for each Hamming table."""
    code = np.concatenate([(x - mean) @ p >= 0 for p in projections], axis=1)
    parts = [code[:, i:i + bits] for i in range(0, code.shape[1], bits)]
    return np.stack([p @ (np.int64(1) << np.arange(p.shape[1], dtype=np.int64)) for p in parts], axis=1)


def forest(link: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect the linked rows ``a`` and columns ``b`` of a block."""
    big = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    while True:
        na = np.minimum(la, np.where(link, lb[None, :], big).min(axis=1))
        nb = np.minimum(lb, np.where(link, na[:, None], big).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    return [*zip(a[la != a].tolist(), la[la != a].tolist()), *zip(b[lb != b].tolist(), lb[lb != b].tolist())]


def dedup(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, sample: int = SAMPLE,
          bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every vector."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    v = cut(v.withColumn("row", F.monotonically_increasing_id()).withColumn("fine", usable(F.col("v"))))
    some = v.where("fine").select("vec_id", "v").orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(sample).toArrow()  # bounded
    drawn = some.column("v").to_pylist()
    ids = v.select("row", "vec_id")
    if not drawn:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = max(sorted({len(d) for d in drawn}), key=[len(d) for d in drawn].count)
    mean, projections = learn(unit(np.array([d for d in drawn if len(d) == width])))
    tables = sum(-(-p.shape[1] // bits) for p in projections)
    narrow = np.uint16 if bits <= 16 else np.int64  # of a substring

    def code(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = unit(np.asarray(b.column(1).flatten(), float).reshape(-1, width))
            sub = substrings(x, mean, projections, bits)
            key = mix(sub.astype(np.uint64) * np.uint64(tables) + np.arange(tables, dtype=np.uint64), 31).view(np.int64)
            n = b.num_rows
            again = lambda a: a.take(pa.array(np.repeat(np.arange(n), tables)))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), again(b.column(0)),
                                              again(pa.array([r.tobytes() for r in sub.astype(narrow)], pa.binary())), again(pa.array([r.tobytes() for r in x], pa.binary()))],
                                             names=["key", "tab", "row", "code", "x"])

    fine = v.where(F.col("fine") & (F.size("v") == width)).select("row", "v")
    coded = fine.mapInArrow(code, "key long, tab int, row long, code binary, x binary")
    size = cut(coded.select("key").groupBy("key").agg(F.count("*").alias("c")).where("c > 1").withColumn("chunks", F.ceil(F.col("c") / block)))
    met = coded.join(size, "key").withColumn("i", F.pmod(F.xxhash64("row"), F.col("chunks")))
    met = met.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    met = met.select(F.xxhash64("key", F.least("i", "j"), F.greatest("i", "j")).alias("cell"), "tab", "row",
                     F.when(F.col("i") == F.col("j"), 2).when(F.col("i") < F.col("j"), 0).otherwise(1).alias("side"), "code", "x")
    met = met.repartition("cell").sortWithinPartitions("cell", "row")

    def rerank(batches):
        from quillspark.llm.cells import runs_of

        for _, (tab, row, side, codes, x) in runs_of(batches, 5):
            row, side = np.array(row), np.array(side)
            c, x = np.array([np.frombuffer(y, narrow) for y in codes]), np.array([np.frombuffer(y, np.float64) for y in x])
            p, q = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
            link = x[p] @ x[q].T >= cosine
            link[row[p][:, None] == row[q][None, :]] = False
            first = link.copy()
            for t in range(tab[0]):  # pairs that have met in an earlier table
                first &= c[p, t][:, None] != c[q, t][None, :]
            both = p is q or (len(p) == len(q) == len(row))
            n = np.zeros(len(row), np.int64)
            n[p] += first.sum(axis=1)
            if not both:
                n[q] += first.sum(axis=0)
            edges = forest(link, row[p], row[q])
            rows = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([row[rows], np.array([e[0] for e in edges], np.int64)])),
                 pa.array(np.concatenate([n[rows], np.zeros(len(edges), np.int64)])),
                 pa.array([None] * len(rows) + [e[1] for e in edges], pa.int64())], names=["row", "n", "v"])

    found = cut(met.mapInArrow(rerank, "row long, n long, v long"))
    counts = found.where("v is null").groupBy("row").agg(F.sum("n").alias("n_links"))
    comp = components(found.where("v is not null").select(F.col("row").alias("u"), "v")).withColumnRenamed("id", "row")
    named = ids.join(comp, "row", "left").withColumn("component", F.coalesce("component", "row"))
    least = named.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    out = named.join(least, "component").join(counts, "row", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id",
                      F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
