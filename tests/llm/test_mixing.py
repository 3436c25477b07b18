from collections import Counter, defaultdict

import pytest
from helpers import WORD, corpus, docs_frame

from quillspark.llm import mixing


def water_fill(sizes, weights, total):
    """Targets by resharing the excess until no source is above twice its size."""
    target = dict.fromkeys(sizes, 0.0)
    open_, left = set(sizes), total
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * unit > 2 * sizes[s]}
        if not full:
            target.update({s: weights[s] * unit for s in open_})
            break
        target.update({s: 2.0 * sizes[s] for s in full})
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.fixture(scope="module")
def rows():
    return [(i, t, la, s) for i, t, la, s in corpus()] + [(1000 + k, "one two three", "en", f"s{k % 5}") for k in range(300)]


def test_targets_and_taken(spark, rows):
    got = mixing.plan(docs_frame(spark, rows), block_docs=8).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, *_ in rows)
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        assert r.taken in (0, r.size, 2 * r.size) and len(r.shards) * r.size == r.taken
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = water_fill(sizes, {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}, 1.5 * sum(sizes.values()))
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6


def test_reruns_and_layouts_agree(spark, rows):
    a = mixing.plan(docs_frame(spark, rows), block_docs=8).collect()
    b = mixing.plan(docs_frame(spark, rows[::-1]).repartition(7), block_docs=8).collect()
    assert Counter(map(str, a)) == Counter(map(str, b))


def test_tree_deals_quotas_exactly(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 37), (None, 5), ("z", 0)], "source string, draws long")
    got = mixing.split_tree(quotas, 8, "s").collect()
    assert len(got) == 32
    per = Counter()
    for r in got:
        per[r.source] += r.draws
    assert per == {"a": 1000, "b": 37, None: 5, "z": 0}
    shard = Counter()
    for r in got:
        shard[r.shard] += r.draws
    assert max(shard.values()) - min(shard.values()) <= 1
    with pytest.raises(ValueError):
        mixing.split_tree(quotas, 6, "s")


def test_drawn_rows_repeat_as_taken(spark, rows):
    rows = [r for r in rows if r[0] != 100]
    docs = docs_frame(spark, rows)
    want = {r.doc_id: r.taken // r.size for r in mixing.plan(docs, block_docs=8).collect() if r.size}
    drawn = mixing.draw(docs, block_docs=8)
    assert drawn.columns == [*docs.columns, "shard"]
    assert Counter(r.doc_id for r in drawn.collect()) == Counter({i: n for i, n in want.items() if n})


def test_nothing(spark):
    assert mixing.plan(docs_frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.plan(docs_frame(spark, [(1, None, "en", "a"), (2, " ", "en", None)])).collect()] == [0, 0]
