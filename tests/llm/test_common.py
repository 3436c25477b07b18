import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, components, low

from quillspark.llm import common


def test_words_of_batches(monkeypatch):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("aB é\n\t1\x00🙂") for _ in range(rnd.randint(0, 60))) for _ in range(300)] + [None, "", " ", "x" * 5000]
    data, off = common.text_buffers(pa.array(texts))
    names = {}
    for segment in (50, 2 << 20):
        monkeypatch.setattr(common, "SEGMENT", segment)
        for i, j in common.segments(off, segment):
            h, first, s, e = common.row_words(data, off, i, j)
            for r in range(i, j):
                words = WORD.findall(low(texts[r]))
                own = h[first[r - i]:first[r - i + 1]]
                assert len(own) == len(words)
                for x, w in zip(own.tolist(), words):
                    assert names.setdefault(w, x) == x
    assert len(set(names.values())) == len(names)


def test_sliced_columns_keep_their_rows():
    col = pa.array(["a b", None, "c", "a b"])[1:]
    data, off = common.text_buffers(col)
    h, first, _, _ = common.row_words(data, off, 0, 3)
    assert np.diff(first).tolist() == [0, 1, 2]


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rnd = random.Random(3)
    n = 200
    edges = {"path": [(i, i + 1) for i in rnd.sample(range(n), n)], "star": [(7, i) for i in range(n)],
             "random": [(rnd.randrange(n), rnd.randrange(n)) for _ in range(n // 2)], "none": []}[shape]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = components({x for e in edges for x in e}, edges)
    loops = {a for a, b in edges if a == b}
    assert {k: v for k, v in want.items() if k not in loops or k in got} == got


def test_marked_rows_are_the_keys_and_few_others(spark):
    df = spark.range(-20_000, 20_000).selectExpr("id as doc_id", "id * 2 as _BIT", "cast(id as string) as text")
    keys = spark.range(-20_000, 20_000, 20).selectExpr("id as doc_id")
    got = common.marked(df, keys, "doc_id", rows=10)
    assert got.columns == df.columns
    assert all(r.text == str(r.doc_id) and r["_BIT"] == 2 * r.doc_id for r in got.collect())
    assert got.join(keys, "doc_id").count() == 2_000
    assert got.count() < 2_000 + 40_000 / 10
    assert common.marked(df, keys, "doc_id") is df
