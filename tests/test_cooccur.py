import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillspark.operators import cooccur


def brute(rows):
    by_ctx = {}
    for c, m in rows:
        if m is not None:
            by_ctx.setdefault(c, set()).add(m)
    out = Counter()
    for members in by_ctx.values():
        for a, b in itertools.permutations(members, 2):
            out[(a, b)] += 1
    return out


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_chunked_pairs_equal_brute_force(spark, chunk):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 6), rnd.choice("abcdefgh")) for _ in range(120)]
    rows += [(99, m) for m in "abcdefghij"] * 3 + [(5, None)]   # one hot context, duplicates, NULL
    df = spark.createDataFrame(rows, "ctx int, m string")
    got = cooccur.cooccurrence(df, ["ctx"], "m", chunk=chunk)
    assert {(r.member_a, r.member_b): r.n for r in got.collect()} == dict(brute(rows))


def test_pairs_symmetric_and_share(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "a"), (3, "b")], "ctx int, m string")
    pairs = {(r.member_a, r.member_b): r.n for r in cooccur.cooccurrence(df, ["ctx"], "m").collect()}
    assert all(pairs[(b, a)] == n for (a, b), n in pairs.items())
    share = {(r.member_a, r.member_b): r.share
             for r in cooccur.cooccurrence_share(df, ["ctx"], "m", min_share=0.5).collect()}
    assert share == {("b", "a"): 1.0, ("c", "a"): 1.0, ("a", "b"): 2 / 3}
    verts = sorted(r.name for r in cooccur.graph_vertices(cooccur.cooccurrence(df, ["ctx"], "m"),
                                                           "member_a", "member_b").collect())
    assert verts == ["a", "b", "c"]
    lonely = df.union(spark.createDataFrame([(9, "z"), (9, None), (10, None), (None, "y"), (None, "x")], "ctx int, m string"))
    assert sorted(r.name for r in cooccur.network_vertices(lonely, ["ctx"], "m").collect()) == ["a", "b", "c", "x", "y"]


def test_hot_context_in_chunks(spark):
    # a single context with 300 members and chunk 40: 8 chunks per side, 64
    # join groups of at most ~40 x 40 members; still every ordered pair once
    df = spark.createDataFrame([(1, f"m{i}") for i in range(300)], "ctx int, m string")
    got = cooccur.cooccurrence(df, ["ctx"], "m", chunk=40)
    assert got.count() == 300 * 299 and got.agg(F.max("n")).first()[0] == 1


def test_large_context_needs_no_join(spark):
    df = spark.createDataFrame([(1, f"m{i:04d}") for i in range(600)] + [(c, f"m{k}") for c in range(2, 50) for k in range(3)], "ctx int, m string")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = cooccur.cooccurrence(df, ["ctx"], "m", chunk=50)._jdf.queryExecution().executedPlan().toString()
        sets = cooccur.member_sets(df, ["ctx"], "m", "__m")
        assert sets.where("ctx = 1").selectExpr("size(__m) AS n").first().n == 600
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 3
    got = cooccur.cooccurrence(df, ["ctx"], "m", chunk=50)
    assert got.count() == 600 * 599 + 6 and got.where("member_a >= 'm0000' and length(member_a) = 5").agg(F.max("n")).first()[0] == 1


@pytest.mark.parametrize("chunk", [1, 3, 512])
def test_share_and_other_member_types(spark, chunk):
    rnd = random.Random(chunk)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice([1, 2, 3, 4, None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "ctx int, m int")
    want = brute(rows)
    heads = Counter(m for _, m in {(c, m) for c, m in rows if m is not None})
    got = cooccur.cooccurrence_share(df, ["ctx"], "m", chunk=chunk).collect()
    assert {(r.member_a, r.member_b): (r.n, r.n_a, r.share) for r in got} == {(a, b): (n, heads[a], n / heads[a]) for (a, b), n in want.items()}
