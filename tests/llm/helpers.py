"""Fixtures and brute-force counterparts shared by the tests."""

import itertools
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def low(text):
    return (text or "").translate(UPPER)


def docs_frame(spark, rows):
    """Rows (doc_id, text, lang, source) with a column that clashes with
    names the operators use."""
    return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "x", 1) for i, t, la, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, component_id string, size int")


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n))


def near(rnd, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
    return " ".join(words)


def corpus(seed=1):
    rnd = random.Random(seed)
    rows = [(i, prose(rnd, rnd.choice([3, 30, 120, 400])), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", None])) for i in range(40)]
    base = prose(rnd, 200)
    rows += [(100 + k, base, "en", "a") for k in range(4)]
    rows += [(200 + k, near(rnd, base, 2), "en", "a") for k in range(12)]
    rows += [(300, "", "en", "a"), (301, None, None, None), (302, " \n\t ", "en", "b"), (303, "Ab", "en", "b"), (304, "aB", "en", "b"),
             (305, prose(rnd, 30_000), "en", "b"), (306, "ÀÉ ß\x0bz " * 30, "fr", "a"), (100, base, "en", "a"), (None, base, "en", "a")]
    return rows


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text, k):
    w = WORD.findall(low(text))
    return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def jaccard_components(rows, k, percent):
    sets = {i: shingles(t, k) for i, t, *_ in rows if i is not None}
    links = []
    for (a, x), (b, y) in itertools.combinations(sets.items(), 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            links.append((a, b))
    return sets, components(sets, links)


