import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest
from helpers import corpus, docs_frame, low, prose

from quillspark.llm import resample

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, ngrams):
    w = WORDS.findall(low(text))
    return len(w), [" ".join(w[i:i + k]) for k in range(1, ngrams + 1) for i in range(len(w) - k + 1)]


def expected(rows, targets, ngrams, buckets, least, percent, seed=2024):
    count = lambda texts: Counter(crc32(f.encode()) % buckets for t in texts for f in features(t, ngrams)[1])
    s, t = count([r[1] for r in rows]), count(targets)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    out = []
    for i, text, *_ in rows:
        n, fs = features(text, ngrams)
        h = int(sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in fs)
        out.append([i, n, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    order = sorted((k for k, r in enumerate(out) if r[1] >= least), key=lambda k: (-out[k][4], out[k][0] is not None, out[k][0] or 0, out[k][2], out[k][3]))
    drawn = order[:len(order) * percent // 100]
    return [(*r, drawn.index(k) + 1 if k in drawn else None) for k, r in enumerate(out)]


@pytest.mark.parametrize("ngrams", [1, 2, 3])
def test_matches_brute_force(spark, ngrams):
    rows, rnd = corpus(), random.Random(4)
    targets = [prose(rnd, 60, 50), prose(rnd, 40, 900), None, "", "Ärger, W1 w2"]
    wanted = spark.createDataFrame([(t,) for t in targets], "text string")
    docs = docs_frame(spark, rows).repartition(3)
    table = resample.gains(docs, wanted, ngrams=ngrams, buckets=500)
    got = resample.rank(docs, table, ngrams=ngrams, min_words=5, percent=30).collect()
    want = expected(rows, targets, ngrams, 500, 5, 30)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r["rank"] is not None for r in got) == 30 * sum(r[1] >= 5 for r in want) // 100
    drawn = resample.resample(docs, wanted, ngrams=ngrams, buckets=500, min_words=5, percent=30)
    assert drawn.columns == docs.columns
    keep = {(w[0], r[1]) for w, r in zip(want, rows) if w[-1] is not None}
    assert {(r.doc_id, r.text) for r in drawn.collect()} == keep


def test_long_texts_are_split_without_loss():
    rnd = random.Random(5)
    text = " ".join(rnd.choice(["Ab", "c", "dé9", "x" * 40]) + rnd.choice(["", ",", " \n"]) for _ in range(3000)).encode()
    words = b" ".join(w for p in resample.pieces(text, 10) for w in p)
    assert words.decode() == " ".join(WORDS.findall(low(text.decode())))
    for n in (2, 3, 4):
        whole = Counter(crc32(f.encode()) for f in features(text.decode(), n)[1] if " " in f)
        old, resample.pieces.__defaults__ = resample.pieces.__defaults__, (7,)
        try:
            assert Counter(h for level in resample.longer(text, n) for h in level) == whole
        finally:
            resample.pieces.__defaults__ = old


def test_draws_the_target_like(spark):
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma"] if i % 5 == 0 else ["one", "two", "three"]) for _ in range(40)), "en", "a") for i in range(200)]
    targets = spark.createDataFrame([("alpha beta gamma " * 20,)], "text string")
    got = [r.doc_id for r in resample.resample(docs_frame(spark, rows), targets, percent=20).collect()]
    assert len(got) == 40 and all(i % 5 == 0 for i in got)


def test_empty_tables(spark):
    none = docs_frame(spark, [])
    table = resample.gains(none, none.select("text"))
    assert resample.rank(none, table).collect() == [] and table == [0] * resample.BUCKETS
    docs = docs_frame(spark, [(1, "a b " * 20, "en", "a")])
    assert [r["rank"] for r in resample.rank(docs, resample.gains(docs, none)).collect()] == [None]
