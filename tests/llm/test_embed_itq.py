import numpy as np
from helpers import components

from quillspark.llm import embed_itq


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, n_links string")


def data(n=400, groups=12, hot=150, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64))
    for g in range(groups):
        x[10 * g:10 * g + 6] = x[10 * g] + 0.12 * rng.normal(size=(6, 64))
    if hot:
        x[200:200 + hot] = x[200] + 0.08 * rng.normal(size=(hot, 64))
    return x.astype(np.float32)


def truth(x, bound=0.9):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    link = (u @ u.T >= bound) & ~np.eye(len(u), dtype=bool)
    return link


def test_links_against_brute_force(spark):
    x = data()
    link = truth(x)
    for block in (1024, 16):
        got = {r.vec_id: r for r in embed_itq.dedup(frame(spark, [(k, v.tolist()) for k, v in enumerate(x)]), block=block).collect()}
        n = np.array([got[k].n_links for k in range(len(x))])
        assert (n <= link.sum(axis=1)).all() and n.sum() >= 0.95 * link.sum()
        comp = components(range(len(x)), [(a, b) for a, b in zip(*np.where(link)) if a < b])
        assert np.mean([got[k].component_id == comp[k] for k in range(len(x))]) > 0.98
        assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_in_bands_of_cosine(spark):
    rng = np.random.default_rng(4)
    bands, pairs = ((0.9, 0.92), (0.92, 0.95), (0.95, 1.0)), 300
    x = rng.normal(size=(len(bands) * pairs, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cosine = np.concatenate([rng.uniform(lo + 1e-4, hi, pairs) for lo, hi in bands])[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)]).astype(np.float32)
    link = truth(both)
    assert (link.sum(axis=1) == 1).all()
    got = {r.vec_id: r for r in embed_itq.dedup(frame(spark, [(k, v.tolist()) for k, v in enumerate(both)]), sample=300).collect()}  # most vectors are not learned from
    found = np.array([got[k].n_links for k in range(len(x))]).reshape(len(bands), pairs).mean(axis=1)
    assert (found >= (0.9, 0.95, 0.98)).all(), found
    assert all((got[k + len(x)].component_id == k) == bool(got[k].n_links) for k in range(len(x)))


def test_odd_vectors_link_with_nothing(spark):
    x = data(60, 2, 0)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 64), (903, [None] + [1.0] * 63), (904, [float("nan")] + [1.0] * 63), (905, [float("inf")] + [1.0] * 63), (906, [1.0, 2.0])]
    copies = [(3, x[3].tolist()), (None, x[3].tolist()), (907, (1e-30 * x[3]).tolist()), (907, (1e-30 * x[3]).tolist())]
    got = embed_itq.dedup(frame(spark, rows + odd + copies)).collect()
    assert len(got) == len(rows + odd + copies)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    assert all(by[i][0].n_links == 0 and by[i][0].component_id == i and by[i][0].kept for i, _ in odd)
    assert {r.n_links for r in by[3] + by[None] + by[907]} == {by[3][0].n_links} and by[3][0].n_links >= 4
    assert {r.component_id for r in by[907] + by[None]} == {0}


def test_nothing(spark):
    assert embed_itq.dedup(frame(spark, [])).collect() == []
    assert [tuple(r) for r in embed_itq.dedup(frame(spark, [(5, None)])).collect()] == [(5, 0, 5, True)]
