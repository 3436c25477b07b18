"""Plan checks and a streaming run on the driver's smallest tables."""

import contextlib
import io
import os
import time

from conftest import SF_SMALL

from quillspark.plans import fixtures as FX
from quillspark.plans.queries import queries
from quillspark.streaming import stream_word_counts


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_no_python_udf_and_broadcast_anti_join(spark):
    qs = queries()
    for name in ["word_counts", "tf_idf", "sentiment_arc", "number_turns", "cooccurrence", "annotate_structure"]:
        p = plan_text(qs[name](spark, SF_SMALL))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
    wc = plan_text(qs["word_counts"](spark, SF_SMALL))
    assert "LeftAnti" in wc and "Broadcast" in wc              # a short list is broadcast by its size
    from quillspark.operators.tokens import remove_stopwords, unnest_tokens
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    p = plan_text(remove_stopwords(unnest_tokens(docs, "text"), FX.stop_words(spark)))
    assert "LeftAnti" in p and "Broadcast" in p                 # table: broadcast anti join


def test_no_single_partition_window_in_ordered_scans(spark):
    qs = queries()
    for name in ["fill_down", "number_turns", "lag_lead"]:
        p = plan_text(qs[name](spark, SF_SMALL))
        assert "SinglePartition" not in p, name


def test_group_top_k_limits_before_shuffle(spark):
    p = plan_text(queries()["topk_ties_group"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_column_pruning_reaches_scan(spark):
    p = plan_text(queries()["count_by"](spark, SF_SMALL))
    assert "ReadSchema: struct<lang:string>" in p


def test_stream_word_counts(spark, tmpdir_path):
    schema = spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema
    src = os.path.join(tmpdir_path, "in")
    spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(50).write.parquet(src)
    counts = stream_word_counts(spark, src, schema, by=["lang"], stop=FX.stop_words(spark))
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("wc_test")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ckpt")).start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = {(r.lang, r.word): r.n for r in spark.sql("SELECT * FROM wc_test").collect()}
    from quillspark.operators.counts import word_counts
    from quillspark.operators.tokens import unnest_tokens
    batch_docs = spark.read.parquet(src)
    batch = word_counts(unnest_tokens(batch_docs, "text", position=None, keep=["lang"]), ["lang"],
                        FX.stop_words(spark), sort=False)
    assert streamed == {(r.lang, r.word): r.n for r in batch.collect()}
    assert time.time() > 0


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    from quillspark.plans.oracle import oracle_sql
    assert df.count() > 0 and set(queries()) == set(oracle_sql()) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_without_the_training_data_parts():
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("quillspark.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as E
from quillspark.plans.queries import queries
assert set(E.queries()) == set(queries()) == set(E.oracle_sql())
"""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
