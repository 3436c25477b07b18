import random
import re

from helpers import docs_frame, low, prose

from quillspark.llm import license_scan as ls

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def expected(text, index):
    w = WORDS.findall(low(text))
    starts, labels = [], set()
    for phrase, label in ls.BASE:
        p = phrase.split()
        for i in range(len(w)):
            if w[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    base, best = sorted(labels), 0.0
    for (label, t, keys), anchors in zip(ls.TEMPLATES, index):
        t = t.split()
        for o in range(-len(t), len(w)):
            at = lambda k, o=o: w[o + k] if 0 <= o + k < len(w) else None
            if not all(at(k) == x for x, k in anchors):
                continue
            if not all(any([at(s + k) for k in range(len(key.split()))] == key.split() and t[s:s + len(key.split())] == key.split() for s in range(len(t))) for key in keys):
                continue
            share = sum(at(k) == x for k, x in enumerate(t)) / len(t)
            if share >= ls.MIN_SHARE:
                labels.add(label)
                best = max(best, share)
    return (len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted(labels)), max(best, 0.5 if starts else 0.0))


def test_matches_brute_force(spark):
    rnd = random.Random(2)
    notices = [t for _, t, _ in ls.TEMPLATES]
    rows = []
    for i in range(120):
        parts = [prose(rnd, rnd.randint(0, 30), 50)]
        for _ in range(rnd.randint(0, 3)):
            n = rnd.choice(notices).split()
            if rnd.random() < 0.5:
                n[rnd.randrange(len(n))] = "other"
            parts += [rnd.choice([" ", ", ", "\n"]).join(x.upper() if rnd.random() < 0.2 else x for x in n), prose(rnd, rnd.randint(0, 10), 50)]
        rows.append((i, " ".join(parts), "en", "a"))
    rows += [(500, None, None, None), (501, "", "en", "a"), (502, "MIT-License", "en", "a"), (503, "mit licensed", "en", "a"), (504, "licénse mit license" * 2, "en", "a"),
             (505, "mit license " * 20_000, "en", "a"), (502, "MIT-License", "en", "a"), (None, "Licensed under CC BY-NC 4.0.", "en", "a"), (506, "İ mit license", "en", "a")]
    docs = docs_frame(spark, rows)
    index = ls.postings(ls.TEMPLATES, ls.document_frequencies(docs, "text", sorted({w for _, t, _ in ls.TEMPLATES for w in t.split()})))
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in ls.scan(docs).collect()), key=str)
    want = [(i, *expected(t, index)) for i, t, *_ in rows]
    assert got == sorted([(*x[:-1], round(x[-1], 9)) for x in want], key=str)


def test_any_word_outside_the_key_phrases_may_differ(spark):
    rows = [(1, "Licensed under CC BY-NC 3.0", "en", "a")]
    for _, t, _ in ls.TEMPLATES:  # every single word changed, gone from its end or with one before
        w = t.split()
        for k in range(len(w)):
            rows.append((100 + len(rows), " ".join(["see", *w[:k], "other", *w[k + 1:], "end"]), "en", "a"))
            rows.append((100 + len(rows), " ".join(w[k:]), "en", "a"))
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in ls.scan(docs_frame(spark, rows)).collect()}
    assert got[1][5:] == ("cc-by-nc", round(6 / 7, 9))
    anything = [[] for _ in ls.TEMPLATES]
    want = {i: expected(t, anything) for i, t, *_ in rows}
    assert got == {i: (*x[:-1], round(x[-1], 9)) for i, x in want.items()}
    assert sum(x[-1] > 0.5 for x in want.values()) > 100


def test_template_without_key_phrase(spark):
    templates = (("odd", "one two two three four five six seven eight nine", ()), ("short", "alpha beta", ()))
    texts = ["one x two three four five y seven eight nine", "one x two three four five y seven z nine", "two two three four five six seven eight nine", "alpha beta", "alpha x", ""]
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in ls.scan(docs_frame(spark, [(k, t, "en", "a") for k, t in enumerate(texts)]), templates=templates).collect()}
    assert got == {0: ("odd", 0.8), 1: ("", 0.0), 2: ("odd", 0.9), 3: ("short", 1.0), 4: ("", 0.0), 5: ("", 0.0)}


def test_native_plan_and_empty_table(spark):
    docs = docs_frame(spark, [])
    assert ls.scan(docs).collect() == []
    plan = ls.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
