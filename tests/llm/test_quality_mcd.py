import math
import random

import numpy as np
from helpers import WORD, corpus, docs_frame, prose

from quillspark.llm import quality_mcd as q


def base(text):
    t = text or ""
    w = WORD.findall(t)
    windows = list(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
    seen, dup = set(), 0
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)


def test_statistics_match_brute_force(spark):
    rows = [r for r in corpus() if r[0] != 305] + [
        (400, "a b c a b c\na b c\n\n a b c\na b c", "en", "a"), (401, "#x $$ é|é\n#x $$ é|é\n", "de", None), (402, "a A a A a", "en", "a"), (403, "x y\n" * 60, "en", "a")]
    got = q.judge(docs_frame(spark, rows)).collect()
    want = sorted(((i, *base(t)) for i, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=str) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_rejects_outliers_and_keeps_the_rest(spark):
    rnd = random.Random(7)
    rows = [(i, prose(rnd, rnd.randint(60, 300), 100_000), rnd.choice(["en", None]), rnd.choice(["a", None])) for i in range(400)]
    odd = [(1000 + k, " ".join(w + "$$$" for w in prose(rnd, 200, 100_000).split()), "en", "a") for k in range(8)]
    got = {r.doc_id: r.kept for r in q.judge(docs_frame(spark, rows + odd), subset=64).collect()}
    assert not any(got[i] for i, *_ in odd)
    assert all(got[i] for i, *_ in rows)


def test_cutoff_is_the_quantile():
    x = q.CUTOFF  # five degrees of freedom
    above = math.erfc(math.sqrt(x / 2)) + math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)
    assert abs(above - 1e-6) < 1e-8


def test_rejects_an_outlier_on_each_statistic(spark):
    rnd = random.Random(9)
    rows = [(i, prose(rnd, rnd.randint(60, 300), 100_000), "en", "a") for i in range(300)]
    words = [prose(rnd, 2, 100_000) for _ in range(100)]
    run = prose(rnd, 30, 100_000)
    odd = [(1000, prose(rnd, 20_000, 10**7), "en", "a"),  # words
           (1001, " ".join("w" * 9 + w for w in prose(rnd, 150, 100_000).split()), "en", "a"),  # word length
           (1002, " ".join(w + "$" * (k % 5 == 0) for k, w in enumerate(prose(rnd, 150, 100_000).split())), "en", "a"),  # symbols
           (1003, "\n".join(words[:70] + rnd.sample(words[:70], 30)), "en", "a"),  # 30 % repeated lines
           (1004, f"{run} {prose(rnd, 120, 100_000)} {run}", "en", "a")]  # a third of the words repeated
    got = {r.doc_id: r for r in q.judge(docs_frame(spark, rows + odd)).collect()}
    assert all(got[i].kept for i, *_ in rows)
    assert [(i, got[i].base_failed, got[i].kept) for i, *_ in odd] == [(i, False, False) for i, *_ in odd]
    assert 100 * got[1003].n_dup_lines == 30 * got[1003].n_lines and got[1003].n_repeat_words < 10


def test_small_groups_fall_back_to_their_language(spark):
    rnd = random.Random(10)
    long = lambda i, la, s: (i, " ".join(f"longlonglong{w}" for w in prose(rnd, rnd.randint(60, 300), 100_000).split()), la, s)
    short = lambda i, la, s: (i, prose(rnd, rnd.randint(60, 300), 100_000), la, s)
    rows = [long(i, "de", rnd.choice([f"s{i % 9}", None])) for i in range(120)] + [short(1000 + i, la, "a") for i in range(200) for la in ("en",)]
    rows += [long(2000, "en", "b"), short(2001, "de", "s1"), short(2002, "en", "b"), short(2003, "xx", "a"), short(2004, None, None)]
    got = {r.doc_id: r for r in q.judge(docs_frame(spark, rows), subset=64).collect()}
    assert len(got) == len(rows) and all(r.distance is not None for r in got.values())
    assert sorted(i for i, r in got.items() if not r.kept) == [2000, 2001]


def test_long_text_and_layout_do_not_matter(spark):
    rnd = random.Random(8)
    rows = [(i, prose(rnd, 80, 10_000), "en", "a") for i in range(90)] + [(500, prose(rnd, 300_000, 10**6), "en", "a")]
    a = {r.doc_id: (r.kept, r.n_words) for r in q.judge(docs_frame(spark, rows), subset=32).collect()}
    b = {r.doc_id: (r.kept, r.n_words) for r in q.judge(docs_frame(spark, rows[::-1]).repartition(9), subset=32).collect()}
    assert a == b and a[500][1] == 300_000


def test_mcd_ignores_a_quarter_of_bad_rows():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, q.DIM))
    x[:100] += 30
    mean, cov = q.mcd(x)
    assert np.abs(mean).max() < 0.3 and np.diag(cov).max() < 2


def test_nothing(spark):
    assert q.judge(docs_frame(spark, [])).collect() == []
    assert [r.kept for r in q.judge(docs_frame(spark, [(1, None, None, None)])).collect()] == [False]
