"""Properties of the registered analyses on the driver's smallest tables."""

import math

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quillspark.plans.queries import queries


def test_turn_ids_contiguous_from_one(spark):
    d = queries()["number_turns"](spark, SF_SMALL)
    per = d.groupBy("conv_id").agg(F.min("dialrank").alias("lo"), F.max("dialrank").alias("hi"),
                                   F.count_distinct("dialrank").alias("k"),
                                   F.count("*").alias("n"), F.max("rownumber").alias("last"))
    for r in per.collect():
        assert r.lo == 1 and r.hi == r.k and r.last == r.n


def test_shares_sum_to_one(spark):
    s = queries()["compare_vocab"](spark, SF_SMALL).agg(F.sum("share_en").alias("a"),
                                                         F.sum("share_de").alias("b")).first()
    assert math.isclose(s.a, 1.0) and math.isclose(s.b, 1.0)
    t = queries()["share_of_total"](spark, SF_SMALL).agg(F.sum("share").alias("s")).first()
    assert math.isclose(t.s, 1.0)


def test_tf_sums_to_one_per_document(spark):
    w = queries()["tf_idf"](spark, SF_SMALL)
    for r in w.groupBy("lang").agg(F.sum("tf").alias("s")).collect():
        assert math.isclose(r.s, 1.0)


def test_relative_positions_end_at_one(spark):
    p = queries()["rel_position"](spark, SF_SMALL)
    for r in p.groupBy("doc_id").agg(F.max("word_position").alias("m")).collect():
        assert r.m == 1.0


def test_cooccurrence_symmetric(spark):
    rows = {(r.member_a, r.member_b): r.n for r in queries()["cooccurrence"](spark, SF_SMALL).collect()}
    assert rows and all(rows[(b, a)] == n for (a, b), n in rows.items())
