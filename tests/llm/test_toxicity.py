import random
import zlib

import numpy as np
from helpers import docs_frame, prose

from quillspark.llm import toxicity


def rows_and_labels(n=600):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.2
        text = prose(rnd, rnd.randint(5, 120))
        if toxic:
            words = text.split(" ")
            for _ in range(rnd.randint(1, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(["idiot", "Scum!", f"zlurp{rnd.randrange(50)}", f"zlurp{rnd.randrange(50)}"]))
            text = " ".join(words)
        rows.append((i, text, rnd.choice(["en", "de"]), "a"))
        labels.append((i, int(toxic), rnd.randint(0, 1)))
    return rows, labels


def test_held_out_accuracy_and_folds(spark):
    rows, labels = rows_and_labels()
    truth = {i: t for i, t, _ in labels}
    docs = docs_frame(spark, rows)
    tab = spark.createDataFrame(labels + [(None, 1, 0), (9999, None, None), (3, labels[3][1], 0)], "doc_id long, toxic int, quality int")
    got = toxicity.score(docs, toxicity.fit(docs, tab)).collect()
    assert [g.held_out for g in got] == [zlib.crc32(str(g.doc_id).encode()) % 5 == 0 for g in got]
    test = [g for g in got if g.held_out]
    assert sum(g.predicted == truth[g.doc_id] for g in test) >= 0.97 * len(test) and len(test) > 60
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for g in got)
    kept = toxicity.keep_clean(docs, toxicity.fit(docs, tab))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(g.doc_id for g in got if not g.predicted)


def test_scores_ignore_ids_labels_and_other_columns(spark):
    rows, labels = rows_and_labels(200)
    docs = docs_frame(spark, rows)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    moved = docs_frame(spark, [(i + 10**6, t, None, None) for i, t, *_ in rows])
    a = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    b = {r.doc_id - 10**6: r.score for r in toxicity.score(moved, model).collect()}
    assert a == b


def test_odd_rows_and_empty_tables(spark):
    rows = [(1, None, "en", "a"), (2, "", None, None), (2, "", None, None), (None, "idiot " * 50_000, "en", "a"), (4, " \n", "en", "a")]
    docs, none = docs_frame(spark, rows), spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, none)).collect()
    assert len({r.score for r in got if r.doc_id}) == 1 and [r.predicted for r in got if r.doc_id is None] == [1]
    assert toxicity.score(docs_frame(spark, []), toxicity.fit(docs_frame(spark, []), none)).collect() == []


def test_label_model_recovers_rates_and_discounts_copies():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    v = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < b) for a, b in [(0.6, 0.01), (0.5, 0.02), (0.4, 0.01), (0.3, 0.1)]], axis=1).astype(float)
    v = np.concatenate([v, v[:, :1], v[:, :1]], axis=1)  # two copies of the first voter
    p, share = toxicity.label_model(v)
    fired = v.any(axis=1)
    assert ((p > 0.5) == y)[fired].mean() > y[fired].mean() + 0.05  # better than taking every vote
    assert share[0] < 0.5 and share[2] > 0.7
