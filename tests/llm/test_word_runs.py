import random
from hashlib import sha256

import pytest
from helpers import WORD, corpus, docs_frame

from quillspark.llm import word_runs as wr


def expected(w, times=4, least=6):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(least, times * q) and not any(s == i and m == n for s, m, _ in out):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rnd, n, alphabet):
    w = [f"w{rnd.randrange(alphabet)}" for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        a, p = rnd.randrange(len(w) + 1), rnd.randint(1, 8)
        block = [f"w{rnd.randrange(alphabet)}" for _ in range(p)]
        w[a:a] = (block * 12)[:rnd.randint(2, 60)]
    return w


@pytest.mark.parametrize("times,least", [(4, 6), (2, 2), (3, 5), (2, 9)])
def test_runs_match_brute_force(times, least):
    rnd = random.Random(times * least)
    found = 0
    for _ in range(400):
        w = repetitive(rnd, rnd.randint(0, 60), rnd.choice([1, 2, 3, 30]))
        got = wr.word_runs(w, times, least)
        assert got == expected(w, times, least)
        found += len(got)
    assert found > 400


def test_forest_without_cutting_finds_the_same():
    rnd = random.Random(9)
    for _ in range(100):
        w = repetitive(rnd, 80, 3)
        forest = wr.SuffixForest()
        for x in w:
            forest.append(x)
        assert sorted((s, e - s + 1, p) for (s, p), e in forest.runs.items()) == sorted(expected(w))


def test_stretches_hold_every_run_and_only_frequent_words():
    rnd = random.Random(10)
    for n in (50, 2000):
        w = [rnd.randrange(3) if rnd.random() < 0.9 else rnd.randrange(10**6) for _ in range(n)]
        parts = list(wr.stretches(w))
        for a, b in parts:
            assert all(w[a:b].count(x) >= 4 for x in w[a:b])
        for s, m, _ in expected(w):
            assert any(a <= s and s + m <= b for a, b in parts)


def digest(i, text, rewrite=True):
    w = WORD.findall(text or "")
    w = wr.plant(i, w) if rewrite else w
    runs = expected(w)
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    best = min(((-n, s, p) for s, n, p in runs), default=None)
    tail = (None,) * 4 if best is None else (best[1], -best[0], best[2], -best[0] * 1000 // best[2])
    sha = lambda t: sha256(t.encode()).hexdigest()
    return (i, len(runs), *tail, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


def test_query_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [r for r in corpus() if len(r[1] or "") < 10_000]
    rows += [(1000 + k, " ".join(repetitive(rnd, 100, 4)), "en", "a") for k in range(60)]
    rows += [(2000, "a " * 500, "en", "a"), (2000, "a " * 500, "en", "a"), (2001, "a b a b a b a", "en", "a"), (2002, "a b\na\tb a b a b", "en", "a"),
             (2003, "ä " * 7 + "Ä", "de", "a"), (None, "x y " * 9, "en", "a")]
    docs = docs_frame(spark, rows).withColumnRenamed("component_id", "runs")
    got = wr.digests(wr.find(docs, rewrite=wr.plant)).collect()
    want = [digest(i, t) for i, t, *_ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r[1] > 0 for r in want) > 40
    plain = {r.doc_id: r for r in wr.find(docs).collect()}
    assert plain[2000].collapsed == "a" and plain[2002].collapsed == "a b" and plain[301].runs == [] and plain[301].collapsed == ""


def test_long_text_with_few_words(spark):
    rnd = random.Random(12)
    w = [f"w{rnd.randrange(4)}" for _ in range(20_000)] + ["p", "q", "r"] * 2000 + [f"w{rnd.randrange(4)}" for _ in range(20_000)]
    r = wr.find(docs_frame(spark, [(1, " ".join(w), "en", "a")])).first()
    assert (20_000, 6000, 3) in [tuple(x) for x in r.runs] and r.n_words == 46_000
    for s, n, p in r.runs:
        assert all(w[k] == w[k + p] for k in range(s, s + n - p)) and n >= max(6, 4 * p)
        assert (s == 0 or w[s - 1] != w[s - 1 + p]) and (s + n == len(w) or w[s + n] != w[s + n - p])


def test_empty_table(spark):
    assert wr.digests(wr.find(docs_frame(spark, []))).collect() == []
