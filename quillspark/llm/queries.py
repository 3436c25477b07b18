"""Registered queries of the package: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def op1_url_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by rule or by propagated trust of its host."""
    from quillspark.llm import url_filter

    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on four-word shingles."""
    from quillspark.llm import ngram_join

    return ngram_join.join(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    from quillspark.llm import mixing

    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the public word BPE."""
    import public_tokenizers

    from quillspark.llm import bpe_trie

    docs = table(spark, sf_dir, "documents")
    return bpe_trie.digests(bpe_trie.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    from quillspark.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_toxicity_weak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a classifier under weak supervision."""
    from quillspark.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand elsewhere before."""
    from quillspark.llm import line_dedup

    out = line_dedup.dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_lines").cast("long").alias("n_lines"), F.col("_n_gone").cast("long").alias("n_gone"), "text")


def op8_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by base rules and robust distance."""
    from quillspark.llm import quality_mcd

    return quality_mcd.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_embedding_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and components of all embeddings."""
    from quillspark.llm import embed_itq

    return embed_itq.dedup(table(spark, sf_dir, "embeddings"))


def op10_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    from quillspark.llm import license_scan

    return license_scan.scan(table(spark, sf_dir, "documents"))


def op11_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark texts, the best tenth ranked."""
    from quillspark.llm import resample

    docs = table(spark, sf_dir, "documents")
    gains = resample.gains(docs, table(spark, sf_dir, "benchmark"), ngrams=1)
    return resample.rank(docs, gains, ngrams=1).select("doc_id", "n_features", "weight", "score", "rank")


def op12_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by pattern and by randomness tests."""
    from quillspark.llm import secret_scan

    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, periods planted in a tenth."""
    from quillspark.llm import word_runs

    return word_runs.digests(word_runs.find(table(spark, sf_dir, "documents"), rewrite=word_runs.plant))


def queries():
    return {name: f for name, f in globals().items() if name.startswith("op")}
