"""Mixing sources to target weights (operator 3).

Every source's documents fall by hash into blocks; the permuted blocks of a
source, read once or more than once, are its supply, and a target in words
becomes an exact quota of block draws whose last block is drawn in part. A
splitting tree deals the quotas out to the output shards: each node halves its
draws by one multivariate hypergeometric draw over the sources, so every shard
gets a random share of each source and the shares add up exactly. Shards then
take disjoint runs of each source's permuted blocks and are shuffled locally.

Scale: texts are read once for their sizes; running sums go over blocks (a few
hundred documents each) in two levels, so no window holds a whole source, and
only the one partly drawn block of a source is ordered document by document.
One row per source is all that meets in one task.

Defined cases: null or blank texts have size 0 and are never taken; a null
source is a source of its own, the last; rows that repeat an id are documents
of their own; an empty table gives no rows. Draws depend on ids and ``seed``
alone, so reruns agree.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillspark.llm.common import WORD, cut

WEIGHTS, SHARE, CAP, BLOCK, SHARDS, SEED = (3, 1, 2), 1.5, 2, 256, 16, "mix"


def _key(*parts):
    return F.md5(F.concat_ws(":", *parts))


def targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """``sources(source, source_size, n_docs)`` with ``target``: the level at
    which weight * level, stopped at ``cap`` times the size, sums to ``share``
    of all words; resharing the excess by weight ends there too."""
    pick = F.array(*[F.lit(w) for w in weights])
    n = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))  # one row per source
    s = sources.withColumn("weight", F.element_at(pick, (n - 1) % len(weights) + 1))
    s = s.withColumn("full_at", F.col("source_size") * cap / F.col("weight"))
    before = W.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(whole) * share - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
                     / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    level = F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", F.col("source").isNull().alias("last"), "source", "level"))).over(whole)["level"]
    return s.withColumn("target", F.least(F.col("source_size") * float(cap), F.coalesce(F.col("weight") * level, F.col("source_size") * float(cap)))).drop("full_at", "level", "weight")


def split_tree(quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """``(source, shard, draws)`` from ``quotas(source, draws)``."""
    levels = max(0, (shards - 1).bit_length())
    if 1 << levels != shards:
        raise ValueError("shards must be a power of two")

    def halve(node: pd.DataFrame) -> pd.DataFrame:
        import zlib

        import numpy as np

        node = node.sort_values("source", na_position="last", ignore_index=True)
        draws = node["draws"].to_numpy()
        at = int(node["shard"].iloc[0])
        rng = np.random.default_rng([at, zlib.crc32(seed.encode())])
        left = rng.multivariate_hypergeometric(draws, int(draws.sum()) // 2, method="marginals") if draws.sum() else draws
        return pd.concat([node.assign(shard=2 * at, draws=left), node.assign(shard=2 * at + 1, draws=draws - left)])

    kind = quotas.schema["source"].dataType.simpleString()
    tree = quotas.select("source", F.lit(1).cast("long").alias("shard"), F.col("draws").cast("long"))  # node 1 is the root
    for _ in range(levels):
        tree = tree.groupBy("shard").applyInPandas(halve, f"source {kind}, shard long, draws long")
    return tree.withColumn("shard", F.col("shard") - shards)


def plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, share=SHARE, cap=CAP, block_docs: int = BLOCK, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, shards)``: a document
    is taken ``taken / size`` times, once for each entry of ``shards``."""
    d = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    src = d.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    src = cut(targets(src, weights, share, cap).withColumn("n_blocks", F.ceil(F.col("n_docs") / block_docs))
              .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
              .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")))
    info = src.withColumnRenamed("source", "s")
    d = d.join(info, d["source"].eqNullSafe(info["s"])).drop("s").withColumn("key", _key(F.lit(seed), F.col("doc_id")))
    d = d.withColumn("block", F.conv(F.substring("key", 1, 8), 16, 10).cast("long") % F.col("n_blocks"))
    # running words and numbers of the permuted blocks, in two levels
    b = d.groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    b = b.withColumn("bkey", _key(F.lit(seed), F.lit("block"), F.col("source"), F.col("block"))).withColumn("top", F.substring("bkey", 1, 3))
    tops = b.groupBy("source", "top").agg(F.sum("words").alias("w"), F.count("*").alias("n"))
    over = W.partitionBy("source").orderBy("top").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select(F.col("source").alias("s"), F.col("top").alias("t"), F.coalesce(F.sum("w").over(over), F.lit(0)).alias("w0"),
                       F.coalesce(F.sum("n").over(over), F.lit(0)).alias("n0"))
    inner = W.partitionBy("source", "top").orderBy("bkey", "block")
    b = (b.join(tops, b["source"].eqNullSafe(tops["s"]) & (b["top"] == tops["t"])).drop("s", "t")
         .withColumn("before", F.col("w0") + F.sum("words").over(inner) - F.col("words"))
         .withColumn("rank", F.col("n0") + F.row_number().over(inner) - 1))
    b = cut(b.select("source", "block", "before", "rank", (F.col("before") < F.col("rest")).alias("drawn"),
                     ((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))).alias("edge")))
    # quotas of block draws, dealt to the shards
    drawn = b.where("drawn").groupBy("source").agg(F.count("*").alias("part")).withColumnRenamed("source", "s")
    quotas = (src.join(drawn, src["source"].eqNullSafe(drawn["s"]), "left")
              .select("source", (F.col("passes") * F.col("n_blocks") + F.coalesce("part", F.lit(0))).alias("draws")))
    tree = split_tree(quotas, shards, seed)
    ends = tree.withColumn("end", F.sum("draws").over(W.partitionBy("source").orderBy("shard")))
    ends = (ends.groupBy("source").agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "end"))), lambda x: x["end"]).alias("ends"))
            .withColumnRenamed("source", "s"))  # one entry per shard
    info = src.select(F.col("source").alias("s2"), "passes", "n_blocks")
    b = b.join(info, b["source"].eqNullSafe(info["s2"])).join(ends, b["source"].eqNullSafe(ends["s"]), "left")
    where = lambda n: F.size(F.filter("ends", lambda e: e <= n * F.col("n_blocks") + F.col("rank")))
    b = cut(b.select(F.col("source").alias("bs"), F.col("block").alias("bb"), "before", "drawn", "edge",
                     F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), where).alias("at")))
    d = d.join(b, d["source"].eqNullSafe(b["bs"]) & (d["block"] == b["bb"]))
    cols = ["doc_id", "source", "size", "source_size", "target", "passes", "drawn", "at"]
    sure = d.where("not edge").select(*cols)
    within = W.partitionBy("source", "block").orderBy("key", "doc_id", "size")
    part = (d.where("edge").withColumn("start", F.col("before") + F.sum("size").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
            .withColumn("drawn", F.col("start") + F.col("size") / 2 <= F.col("rest")).select(*cols))
    times = F.col("passes") + F.when(F.col("drawn"), 1).otherwise(0)
    return sure.union(part).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.slice("at", F.lit(1), times.cast("int"))).otherwise(F.array().cast("array<int>")).alias("shards"))


def draw(docs: DataFrame, *, seed: str = SEED, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", **options) -> DataFrame:
    """The mixture itself: rows of ``docs``, each as often as it is taken, with
    ``shard``, dealt to the shards and shuffled within each."""
    p = plan(docs, seed=seed, shards=shards, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    # rows that share id, source and size share one decision, the larger
    p = p.where("taken > 0").groupBy(F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("size").alias("_z")).agg(F.max("shards").alias("_shards"))
    size = F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long")
    out = docs.join(p, docs[id_col].eqNullSafe(p["_i"]) & docs[source_col].eqNullSafe(p["_s"]) & (size == p["_z"]))
    out = out.select(*[docs[c] for c in docs.columns], F.posexplode("_shards").alias("_pass", "shard"))
    return out.sortWithinPartitions("shard", _key(F.lit(seed), F.col(id_col), F.col("_pass"))).drop("_pass")
