import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quillspark.operators import ordered
from quillspark.plans.queries import queries


def make(spark, n_parts=3, n=40, seed=7, null_rate=0.6):
    rnd = random.Random(seed)
    rows = []
    for p in range(n_parts):
        size = n * (p + 1)
        for i in range(size):
            v = None if rnd.random() < null_rate else f"v{p}_{i}"
            rows.append((p, i * 3 + rnd.randint(0, 2), v, rnd.randint(0, 3)))
    return spark.createDataFrame(rows, "part int, ord int, v string, x int")


def expected(df):
    w = Window.partitionBy("part").orderBy("ord")
    return df.select(
        "part", "ord",
        F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("down"),
        F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("up"),
        F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("inc"),
        F.coalesce(F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("exc"),
        F.row_number().over(w).alias("rn"),
        F.count("*").over(Window.partitionBy("part")).alias("tot"))


@pytest.mark.parametrize("block", [1, 2, 7, 1000])
def test_scan_matches_plain_window(spark, block):
    df = make(spark)
    got = ordered.ordered_scan(
        df.withColumn("down", F.col("v")).withColumn("up", F.col("v")), ["part"], ["ord"],
        running={"inc": (F.col("x"), True), "exc": (F.col("x"), False), "rn": (F.lit(1), True)},
        fill_down=["down"], fill_up=["up"], group_total="tot", block_size=block)
    cols = ["part", "ord", "down", "up", "inc", "exc", "rn", "tot"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in expected(df).select(*cols).collect())
    assert a == b


def test_leading_and_trailing_nulls_stay(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "a"), (1, 3, None), (1, 4, "b"), (1, 5, None)],
                               "part int, ord int, v string")
    down = ordered.ordered_scan(df, ["part"], ["ord"], fill_down=["v"], block_size=2)
    up = ordered.ordered_scan(df, ["part"], ["ord"], fill_up=["v"], block_size=2)
    assert [r.v for r in down.orderBy("ord").collect()] == [None, "a", "a", "b", "b"]
    assert [r.v for r in up.orderBy("ord").collect()] == ["a", "a", "b", "b", None]


def test_fill_is_idempotent_and_partitioning_free(spark):
    df = make(spark, seed=3)
    once = ordered.ordered_scan(df, ["part"], ["ord"], fill_down=["v"], block_size=5)
    twice = ordered.ordered_scan(once, ["part"], ["ord"], fill_down=["v"], block_size=3)
    spread = ordered.ordered_scan(df.repartition(7), ["part"], ["ord"], fill_down=["v"], block_size=4)
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    assert rows(once) == rows(twice) == rows(spread)


def test_null_sequence_key_is_one_sequence(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, None), (1, 1, None)], "part int, ord int, v string")
    got = ordered.ordered_scan(df, ["part"], ["ord"], fill_down=["v"], block_size=1)
    assert sorted((r.part is None, r.ord, r.v) for r in got.collect()) == \
        [(False, 1, None), (True, 1, "a"), (True, 2, "a")]


def test_whole_table_sequence(spark):
    df = spark.range(1, 21).select(F.col("id").cast("int").alias("ord"))
    got = ordered.number_rows(df, [], ["ord"], "rn", group_total="n", block_size=3)
    assert sorted((r.ord, r.rn, r.n) for r in got.collect()) == [(i, i, 20) for i in range(1, 21)]


@pytest.mark.parametrize("block", [1, 2, 3, 4, 1000])
def test_shift_lag_lead(spark, block):
    df = spark.createDataFrame([(1, i, f"l{i}") for i in range(1, 5)] + [(2, 1, "m1")],
                               "part int, pos int, line string")
    got = ordered.shift(df, ["part"], "pos", {"p1": ("line", 1), "p2": ("line", 2), "n1": ("line", -1)},
                        block_size=block)
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == [(1, 1, "l1", None, None, "l2"), (1, 2, "l2", "l1", None, "l3"),
                    (1, 3, "l3", "l2", "l1", "l4"), (1, 4, "l4", "l3", "l2", None),
                    (2, 1, "m1", None, None, None)]


def test_first_seen_code(spark):
    df = spark.createDataFrame([(1, 1, "b"), (1, 2, "a"), (1, 3, "b"), (1, 4, None), (1, 5, "c"),
                                (2, 1, "c")], "part int, ord int, lvl string")
    got = ordered.first_seen_code(df, ["part"], ["ord"], "lvl", "code")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", 2), (1, "b", 1), (1, "c", 3), (2, "c", 1)]


def test_nested_row_number(spark):
    df = make(spark, n_parts=4, n=9, seed=11)
    got = ordered.nested_row_number(df, "part", ["ord"], "rn", block_size=2)
    want = df.select("part", "ord", F.row_number().over(Window.orderBy("part", "ord")).alias("rn"))
    assert sorted((r.part, r.ord, r.rn) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_alphabetical_code(spark):
    words = "pear apple fig apple kiwi banana date cherry fig".split()
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    got = ordered.alphabetical_code(df, "w", "code")
    assert sorted(tuple(r) for r in got.collect()) == [(w, i) for i, w in enumerate(sorted(set(words)), 1)]


def test_shift_matches_window_on_long_sequence(spark):
    df = spark.range(1, 301).select(F.lit(1).alias("part"), F.col("id").cast("int").alias("pos"),
                                    (F.col("id") * 7 % 13).cast("string").alias("v"))
    got = ordered.shift(df, ["part"], "pos", {"a": ("v", 2), "b": ("v", -3)}, block_size=8)
    w = Window.partitionBy("part").orderBy("pos")
    want = df.select("part", "pos", "v", F.lag("v", 2).over(w).alias("a"), F.lead("v", 3).over(w).alias("b"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


@pytest.fixture()
def uncoalesced(spark):
    """Keeps shuffle partitions and joins as planned, so that tasks can be told."""
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in off}
    for k, v in off.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_hot_sequence_is_spread_over_tasks(uncoalesced):
    spark = uncoalesced
    # one sequence holding every row: its blocks land in different partitions
    df = spark.range(1, 2001).select(F.lit(7).alias("part"), F.col("id").cast("int").alias("ord"))
    got = ordered.number_rows(df, ["part"], ["ord"], "rn", block_size=50)
    parts = got.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1
    assert got.agg(F.max("rn")).first()[0] == 2000
    sh = ordered.shift(got, ["part"], "rn", {"prev": ("ord", 1)}, block_size=50)
    assert sh.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert sh.where(F.col("prev") != F.col("ord") - 1).count() == 0


def test_sorted_row_number_any_order(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, None]), f"k{rnd.randint(0, 10**6):07d}", i) for i in range(400)]
    df = spark.createDataFrame(rows, "part int, key string, i int").dropDuplicates(["part", "key"])
    got = ordered.sorted_row_number(df, ["part"], ["key", "i"], "rn")
    want = df.select("part", "key", "i", F.row_number().over(Window.partitionBy("part").orderBy("key", "i")).alias("rn"))
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    assert sorted((tuple(r) for r in got.select("part", "key", "i", "rn").collect()), key=key) == \
        sorted((tuple(r) for r in want.collect()), key=key)


def test_scan_with_one_value_of_the_first_order_column(spark):
    df = spark.createDataFrame([(1, 0, i, None if i % 3 else f"v{i}") for i in range(50)],
                               "part int, o1 int, o2 int, v string")
    got = ordered.ordered_scan(df, ["part"], ["o1", "o2"], fill_down=["v"], running={"n": (F.lit(1), True)},
                               block_size=4)
    rows = sorted((r.o2, r.v, r.n) for r in got.collect())
    assert rows == [(i, f"v{i - i % 3}", i + 1) for i in range(50)]


def test_sorted_row_number_independent_of_partitioning(spark):
    df = spark.range(0, 500).select((F.col("id") % 3).alias("part"), (F.col("id") * 7919 % 1000).alias("o"))
    a = ordered.sorted_row_number(df.repartition(3), ["part"], ["o"], "rn")
    b = ordered.sorted_row_number(df.repartition(11, "o"), ["part"], ["o"], "rn")
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


@pytest.mark.parametrize("block", [1, 2, 5, 1000])
@pytest.mark.parametrize("depth", [2, 3])
def test_scan_over_several_order_columns(spark, block, depth):
    rnd = random.Random(block * depth)
    rows = [(rnd.choice([1, 2, None]), rnd.randint(0, 6), rnd.randint(0, 3), i, rnd.choice(["a", "b", None]), rnd.randint(0, 5)) for i in range(150)]
    df = spark.createDataFrame(rows, "part int, o1 int, o2 int, o3 int, v string, x int")
    order = ["o1", "o2", "o3"][3 - depth:] if depth == 3 else ["o1", "o3"]
    got = ordered.ordered_scan(df.withColumn("down", F.col("v")).withColumn("up", F.col("v")), ["part"], order,
                               running={"inc": (F.col("x"), True), "rn": (F.lit(1), True)}, changes={"chg": "v"}, fill_down=["down"], fill_up=["up"],
                               shifts={"p1": ("v", 1), "p4": ("x", 4), "n3": ("v", -3)}, group_total="tot", block_size=block)
    w = Window.partitionBy("part").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.last("v", True).over(upto).alias("down"), F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("up"),
                     F.sum("x").over(upto).alias("inc"), F.row_number().over(w).alias("rn"),
                     F.coalesce((F.lag("v", 1).over(w) != F.col("v")).cast("long"), F.lit(0)).alias("c"),
                     F.lag("v", 1).over(w).alias("p1"), F.lag("x", 4).over(w).alias("p4"), F.lead("v", 3).over(w).alias("n3"),
                     F.count("*").over(Window.partitionBy("part")).alias("tot"))
    want = want.withColumn("chg", F.sum("c").over(upto)).drop("c").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_many_rows_under_few_order_values_are_spread(uncoalesced):
    spark = uncoalesced
    df = spark.range(0, 4000).select(F.lit(1).alias("conv"), (F.col("id") % 20).cast("int").alias("turn"), F.col("id").alias("line_no"))
    got = ordered.number_rows(df, ["conv"], ["turn", "line_no"], "rn", block_size=100)
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.sum("rn")).collect()]
    assert len(sizes) > 3 and max(sizes) < 2000
    assert got.agg(F.max("rn")).first()[0] == 4000


def test_nested_row_number_keeps_null_sequences(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1), (10**12, 1)], "part long, ord int")
    got = ordered.nested_row_number(df, "part", ["ord"], "rn")
    assert sorted((r.rn, r.part) for r in got.collect()) == [(1, None), (2, None), (3, 3), (4, 10**12)]


#: Analyses over a scan: each reads and deals its rows once.
ONE_READ = ["line_number", "annotate_structure", "segment_trim", "front_matter", "body_lines", "number_turns", "rank_marked", "row_number_all",
            "lag_lead", "fill_down", "fill_up", "scene_pick", "scene_at", "nth_level", "rel_position_works"]


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
@pytest.mark.parametrize("name", ONE_READ)
def test_final_adaptive_plan_reads_and_deals_rows_once(spark, name, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        df = queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "isFinalPlan=true" in plan and "RoundRobin" not in plan
    # a scan deals its rows by their block (struct k with field b): once for each scan of the analysis
    scans = 2 if name == "scene_pick" else 1
    dealt = set(re.findall(r"- Exchange hashpartitioning\(k#\d+, \d+\), REPARTITION_BY_COL, \[plan_id=(\d+)\]", plan))
    assert plan.count("FileScan") == 1 and len(dealt) == scans and plan.count("ReusedExchange") >= scans


def test_source_rows_are_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 5000, numPartitions=4).selectExpr("cast(id % 3 AS int) part", "cast(id AS int) ord", "cast(id AS string) v").mapInArrow(count, "part int, ord int, v string")
    got = ordered.ordered_scan(df, ["part"], ["ord"], fill_down=["v"], running={"n": (F.lit(1), True)}, shifts={"p": ("v", 1)}, group_total="tot", block_size=100)
    assert got.select("part", "n").count() == 5000
    seen.value = 0
    got.select("part", "n", "p").write.format("noop").mode("overwrite").save()
    assert seen.value == 5000


def spaced(spark, n, step):
    return spark.range(0, n).select(F.lit(1).alias("part"), (F.col("id") * step + F.pmod(F.xxhash64("id"), F.lit(step))).alias("at"), F.col("id"))


@pytest.mark.parametrize("step", [10**6, 10**12])
def test_million_spaced_keys_are_spread(uncoalesced, step):
    """Rows and summaries of every step of the scan, counted by task."""
    spark, n = uncoalesced, 10**6
    df = spaced(spark, n, step)
    got = ordered.number_rows(df, ["part"], ["at"], "rn")
    assert got.agg(F.max(F.abs(F.col("rn") - F.col("id") - 1))).first()[0] == 0
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 8 and max(sizes) < n / 4
    # groups of a level: blocks of the level below under one value of the next coarser block
    width = ordered.DEFAULT_BLOCK
    for level in (1, 2, 3):
        blocks = df.select(F.expr(f"at div {width ** level}").alias("b")).distinct()
        group = F.lit(0) if level == 3 else F.expr(f"b div {width}")
        assert blocks.groupBy(group.alias("g")).count().agg(F.max("count")).first()[0] <= width


def test_order_that_is_no_integer(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["a", "b", None]), f"k{i:04d}", float(i) / 3, i, rnd.choice([None, f"v{i}"])) for i in range(300)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "part string, key string, x double, i int, v string").withColumn("ts", F.timestamp_micros(F.col("i").cast("long") * 86_400_000_123))
    w = Window.partitionBy("part").orderBy("i")
    want = sorted(map(str, df.select("part", "i", F.row_number().over(w).alias("n"), F.lag("i", 2).over(w).alias("p"),
                                     F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("v")).collect()))
    for order in (["key"], ["x"], ["ts"], ["key", "i"]):
        got = ordered.ordered_scan(df, ["part"], order, running={"n": (F.lit(1), True)}, shifts={"p": ("i", 2)}, fill_down=["v"], block_size=16)
        assert got.columns == [*df.columns, "n", "p"]
        assert sorted(map(str, got.select("part", "i", "n", "p", "v").collect())) == want


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_first_different_values(spark, block):
    rnd = random.Random(block)
    rows = [(rnd.choice([1, 2, None]), o, i, rnd.choice(["a", "b", "c", "d", None])) for o in range(8) for i in range(9)]
    df = spark.createDataFrame(rows, "part int, o long, i int, v string")
    for order in (["o", "i"], [ordered.dense("o"), "i"]):
        got = ordered.ordered_scan(df, ["part"], order, firsts={"f": ("v", 3), "g": ("o", 2)}, group_total="n", block_size=block).collect()
        for r in got:
            mine = [x for x in rows if x[0] == r.part]
            assert r.f == list(dict.fromkeys(x[3] for x in mine if x[3]))[:3] and r.g == list(dict.fromkeys(x[1] for x in mine))[:2] and r.n == len(mine)
        assert len(got) == len(rows)


def test_negative_and_extreme_order_values(spark):
    ends = [-2**63, -2**63 + 1, -2**40, -65_537, -65_536, -1, 0, 1, 65_535, 65_536, 2**40, 2**63 - 1]
    df = spark.createDataFrame([(1, x, str(x)) for x in ends], "part int, at long, v string")
    for block in (2, 1 << 16):
        got = ordered.ordered_scan(df, ["part"], ["at"], running={"n": (F.lit(1), True)}, shifts={"p": ("v", 1)}, block_size=block)
        assert [(r.at, r.n, r.p) for r in got.orderBy("n").collect()] == [(x, k + 1, str(ends[k - 1]) if k else None) for k, x in enumerate(ends)]


def test_names_of_the_scan_do_not_clash(spark):
    df = spark.createDataFrame([(1, 1, "a", 5), (1, 2, None, 6)], "k int, o0 int, c0000 string, zz int")
    got = ordered.ordered_scan(df, ["k"], ["o0"], fill_down=["c0000"], running={"s0": (F.col("zz"), True)}, shifts={"i": ("zz", 1)}, group_total="total")
    assert [tuple(r) for r in got.orderBy("o0").collect()] == [(1, 1, "a", 5, 5, None, 2), (1, 2, "a", 6, 11, 5, 2)]
