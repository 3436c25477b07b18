"""Training-data pipeline over ``documents``: toxicity, line dedup, n-gram
Jaccard join, mixing, BPE.

``run`` applies the stages in order; each stage's rows are written as Parquet
into the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import bpe_trie, line_dedup, mixing, ngram_join, toxicity
from quillspark.llm.common import cut, shared_dir, ship, small_side

#: The near-duplicate stage's shingle length and least similarity in percent.
WORDS, PERCENT = 5, 80


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.fit(docs, labels))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand elsewhere before; a document that
    loses every line goes."""
    out = line_dedup.dedup(docs).where("_n_gone = 0 or _n_gone < _n_lines")
    changed = F.when(F.col("_n_gone") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", changed).select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each near-duplicate group."""
    found = ngram_join.join(docs, words=WORDS, percent=PERCENT)
    gone = cut(found.where("doc_id <> component_id").select("doc_id").distinct())
    return docs.join(small_side(gone), "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.draw(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    import public_tokenizers

    return bpe_trie.digests(bpe_trie.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("toxicity", clean), ("line dedup", lines), ("n-gram Jaccard join", near), ("mixing sources to target weights", mix),
          ("BPE encoding and decoding", tokens)]
#: SQL can't express a learnt classifier or BPE; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs
