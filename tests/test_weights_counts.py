import math

from pyspark.sql import functions as F

from quillspark.operators import counts, relational, weights
from quillspark.operators.tokens import remove_stopwords, unnest_tokens


def docs(spark):
    return spark.createDataFrame([("d1", "The cat and the dog."), ("d2", "A cat, a cat!"), ("d3", None)],
                                 "doc string, text string")


def test_tokens_and_stopwords(spark):
    t = unnest_tokens(docs(spark), "text")
    assert t.count() == 9
    stop = spark.createDataFrame([("the",), ("a",), ("and",)], "word string")
    left = remove_stopwords(t, stop)
    assert sorted(r.word for r in left.collect()) == ["cat", "cat", "cat", "dog"]


def test_tf_idf_properties(spark):
    t = unnest_tokens(docs(spark), "text")
    c = counts.count_by(t, ["doc", "word"])
    w = weights.tf_idf(c, "word", "doc")
    tf_sums = {r.doc: r.s for r in w.groupBy("doc").agg(F.sum("tf").alias("s")).collect()}
    assert all(abs(s - 1.0) < 1e-12 for s in tf_sums.values())
    rows = {(r.doc, r.word): r for r in w.collect()}
    assert rows[("d1", "cat")].idf == 0.0          # in every document
    assert math.isclose(rows[("d1", "dog")].idf, math.log(2))
    assert math.isclose(rows[("d2", "a")].tf_idf, 2 / 4 * math.log(2))


def test_top_k_keeps_ties(spark):
    df = spark.createDataFrame([("g", "a", 5), ("g", "b", 4), ("g", "c", 4), ("g", "d", 3), ("h", "e", None)],
                               "g string, w string, n int")
    got = sorted(r.w for r in weights.top_k_ties(df, ["g"], 2, "n").collect())
    assert got == ["a", "b", "c"]
    assert sorted(r.w for r in weights.top_k_ties(df, [], 3, "n").collect()) == ["a", "b", "c"]
    assert sorted(r.w for r in weights.top_k_ties(df, [], 4, "n").collect()) == ["a", "b", "c", "d"]


def test_shares_and_n_distinct(spark):
    a = spark.createDataFrame([("x", 2), ("y", 6), ("z", 1)], "word string, n long")
    b = spark.createDataFrame([("x", 1), ("y", 1), ("q", 5)], "word string, n long")
    got = {r.word: (r.A, r.B) for r in counts.compare_vocab(a, b, "A", "B").collect()}
    assert got == {"x": (0.25, 0.5), "y": (0.75, 0.5)}
    df = spark.createDataFrame([("g", 1), ("g", None), ("g", 1), ("h", 2)], "g string, v int")
    nd = {r.g: (r.n_distinct, r.n) for r in counts.distinct_and_rows(df, ["g"], "v").collect()}
    assert nd == {"g": (2, 3), "h": (1, 1)}


def test_compare_groups_equals_compare_vocab(spark):
    t = spark.createDataFrame([("x", "a"), ("x", "b"), ("x", "b"), ("y", "b"), ("y", "c"), ("y", "a"), ("y", "a"),
                               ("z", "a")], "g string, word string")
    one = counts.compare_groups(t, "g", "x", "y", "X", "Y")
    cx = counts.count_by(t.where(F.col("g") == "x"), ["word"])
    cy = counts.count_by(t.where(F.col("g") == "y"), ["word"])
    two = counts.compare_vocab(cx, cy, "X", "Y")
    assert sorted(tuple(r) for r in one.collect()) == sorted(tuple(r) for r in two.collect())


def test_term_of_every_document_is_spread(spark):
    """With neither skew splitting nor automatic broadcast."""
    docs_n = 3000
    c = spark.range(docs_n).selectExpr("cast(id AS string) AS doc", "explode(array('the', concat('w', id % 50))) AS word", "1L AS n")
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    try:
        w = weights.tf_idf(c, "word", "doc")
        parts = w.groupBy("word", F.spark_partition_id().alias("p")).agg(F.count("*").alias("count"), F.sum("tf_idf")).where("word = 'the'").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(parts) == 8 and max(r["count"] for r in parts) < docs_n / 4
    got = {(r.doc, r.word): (r.tf, r.idf) for r in w.collect()}
    assert len(got) == 6000 and got["7", "the"] == (0.5, 0.0) and got["7", "w7"] == (0.5, math.log(50))


def test_join_totals_by_hot_and_null_keys(spark):
    rows = [("a", i) for i in range(50)] + [(None, i) for i in range(40)] + [(f"k{i}", i) for i in range(20)]
    left = spark.createDataFrame(rows, "key string, v int")
    totals = left.groupBy("key").agg(F.sum("v").alias("s"), F.count("*").alias("r"))
    sums = lambda key: [v for k, v in rows if k == key]
    want = sorted(str((k, v, sum(sums(k)), len(sums(k)))) for k, v in rows)
    for parts in (1, 2, 3, 5, 10_000):  # no key hot, some, all
        got = relational.join_totals(left, totals, "key", "r", F.lit(len(rows)), parts=parts)
        assert got.columns == ["key", "v", "s", "r"] and sorted(str(tuple(r)) for r in got.collect()) == want
