import itertools
import random

import numpy as np
import pyarrow as pa
from helpers import components, docs_frame, near, prose

from quillspark.llm import line_dedup as ld
from quillspark.llm.common import text_buffers


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(line):
    """Normalised words of a line, by the docstring."""
    b = bytearray()
    for c in line.encode():
        c = c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c
        b.append(32 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c)
    return b" ".join(bytes(b).split())


def blocks(line):
    data, off = text_buffers(pa.array([line], pa.binary()))
    _, _, first, h, _, _ = ld.lines_of(data, off, 0, 1)
    return ld.simhash(h, first)[0].tolist()


def expected(rows):
    """Kept texts by comparing all pairs of distinct normalised lines."""
    places = {}
    docs = sorted({(i, t) for i, t, *_ in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    for d, (i, t) in enumerate(docs):
        for n, x in enumerate(t.split("\n")):
            if plain(x):
                places.setdefault(plain(x), []).append((d, n))
    own = {x: blocks(x) for x in places}
    links = [(a, b) for a, b in itertools.combinations(places, 2)
             if min(len(a), len(b)) >= 0.9 * max(len(a), len(b)) and any(x == y for x, y in zip(own[a], own[b]))
             and distance(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9)]
    group = components(list(places), links)
    first = {}
    for x, at in places.items():
        first[group[x]] = min(first.get(group[x], at[0]), *at) if len(at) > 1 else min(first.get(group[x], at[0]), at[0])
    gone = {at for x, all_at in places.items() for at in all_at if at != first[group[x]]}
    return {(i, t): "\n".join(x for n, x in enumerate(t.split("\n")) if (d, n) not in gone) for d, (i, t) in enumerate(docs)}, len(links)


def rows_of(seed=2):
    rnd = random.Random(seed)
    shared = [prose(rnd, n, 5000) for n in (4, 40, 60, 90, 300)]
    rows = []
    for i in range(30):
        lines = []
        for _ in range(rnd.randint(1, 8)):
            x = rnd.choice(shared) if rnd.random() < 0.5 else prose(rnd, rnd.randint(1, 60), 5000)
            lines.append(rnd.choice([x, x.upper() + "!!", near(rnd, x, 1) if len(x) > 150 else x, "", "--- ***"]))
        rows.append((i, "\n".join(lines), "en", "a"))
    rows += [(50, None, "en", "a"), (51, "", "en", "a"), (52, "\n\n", None, None), (53, rows[3][1], "en", "a"), (3, rows[3][1], "en", "b"), (None, shared[1], "en", "a"),
             (54, prose(rnd, 20_000, 5000), "en", "a"), (55, "É\r\né 12\n", "en", "a"), (56, "é 34", "en", "a")]
    return rows


def test_matches_comparison_of_all_lines(spark, monkeypatch):
    rows = rows_of()
    want, n_links = expected(rows)
    assert n_links > 3
    for most, cell in ((32, 500), (2, 3)):
        monkeypatch.setattr(ld, "MOST", most)
        monkeypatch.setattr(ld, "CELL", cell)
        docs = docs_frame(spark, rows)
        out = ld.dedup(docs)
        got = out.collect()
        assert set(out.columns) == {*docs.columns, "_n_lines", "_n_gone"} and len(got) == len(rows)
        texts = {i: t for i, t, *_ in rows}
        for r in got:
            t = texts[r.doc_id]
            assert r.text == (None if t is None else want[r.doc_id, t])


def test_edit_distance_bound():
    rnd = random.Random(1)
    for _ in range(400):
        a = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 14)))
        b = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 14)))
        d = distance(a, b)
        assert [ld.edit_within(a, b, k) for k in range(16)] == [d <= k for k in range(16)]


def test_many_pairs_at_once_as_one_by_one():
    rnd = random.Random(5)
    pairs = [changed(rnd, n, min(n, edits), kind) for n in (1, 3, 10, 12, 40, 150) for edits in (1, 2, 5, 20) for kind in ("typo", "new", "out", "in")]
    pairs += [(b"a" * n, b"a" * k + b"b" * (n - k)) for n in (0, 1, 9, 10, 11, 64, 400) for k in (0, 1, n * 9 // 10, n) if k <= n]
    pairs += [(b, a) for a, b in pairs] + [(b"ab" * 60, b"ba" * 60), (b"x", b"")]
    for elements in (1 << 17, 50):
        got = ld.alike(*(pa.array(x, pa.binary()) for x in zip(*pairs)), elements=elements)
        assert got.tolist() == [ld.similar(a, b) for a, b in pairs] and 0 < got.sum() < len(pairs)


def test_distances_of_long_rows_by_table_and_by_band():
    rnd = random.Random(8)
    for _ in range(400):
        a = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 30)))
        b = bytearray(a)
        for _ in range(rnd.randint(0, 8)):
            at = rnd.randint(0, len(b))
            b[at:at + rnd.randint(0, 1)] = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 1)))
        assert [ld.band_within(a, bytes(b), k) for k in range(12)] == [ld.edit_within(a, bytes(b), k) for k in range(12)]
    pairs = [changed(rnd, n, edits, kind) for n in (12, 60, 420, 800) for edits in (1, n // 12, n // 8) for kind in ("typo", "new", "out") for _ in range(3)]
    short, long = zip(*(sorted(p, key=len) for p in pairs))
    m, n = (np.array([len(x) for x in side]) for side in (short, long))
    most = (0.1 * n + 1e-9).astype(np.int64)
    want = [ld.similar(a, b) for a, b in pairs]
    for lot in (np.arange(len(m)), np.flatnonzero(most < 200)):  # distances of two bytes and of one
        use = lot[(n - m)[lot] <= most[lot]]
        got = ld._within([short[k] for k in use], [long[k] for k in use], m[use], n[use], most[use])
        assert got.tolist() == [want[k] for k in use] and 0 < got.sum() < len(use)


def test_linked_lines_are_compared_no_further(monkeypatch):
    rnd, asked, alike = random.Random(9), [], ld.alike
    monkeypatch.setattr(ld, "alike", lambda a, b: asked.append(len(a)) or alike(a, b))
    base, other = (changed(rnd, 60, 1, "new")[0] for _ in range(2))
    lines = [base + b" " + b"x" * k for k in range(6)] + [other, other + b" y", other + b" z"]
    h = [k + 1 for k in range(6)] + [7, 8, 7 + (1 << ld.LINE)]  # two lines of one short hash
    pairs = [(a, b) for a, b in itertools.combinations(range(1, 9), 2)]
    rows = [(0, a, b, None) for a, b in pairs] + [(0, x, 0, line) for x, line in zip(h, lines)] + [(1, 1, 2, None), (1, 1, 0, lines[0]), (1, 2, 0, lines[1])]
    batch = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["grp", "u", "v", "line"])
    for most in (40_000, 5):
        asked.clear()
        links = [tuple(r.values()) for b in ld.search_pairs([batch.slice(k, 7) for k in range(0, len(batch), 7)], most) for r in b.to_pylist()]
        group = components(h, links)
        assert {group[x] for x in h[:6]} == {1} and {group[x] for x in h[6:]} == {7}
        assert sum(asked) < len(pairs)
    assert list(ld.search_pairs([])) == []


def test_keys_travel_packed():
    """Nine bytes a key; only keys sent more than once come back, a line sent twice under one counts once."""
    key, line = np.array([5 << 52 | 7 << 20, 5 << 52 | 9 << 20, 3 << 52], np.uint64), np.array([2**39 + 1, 4, 6], np.uint64)
    sent = [ld.packed([(key, line)]), ld.packed([(key[:1], line[:1])]), ld.packed([(key[1:2], line[2:])])]
    assert [len(k) for k in sent[0].column(1).to_pylist()] == [9, 18]
    table = pa.Table.from_batches(sent).sort_by("bucket")
    got = [r for b in ld.repeated(table.to_batches()) for r in b.to_pylist()]
    assert [(r["key"], r["h"]) for r in got] == [(5 << 32 | 7, 2**39 + 1), (5 << 32 | 9, 4), (5 << 32 | 9, 6)]


def test_simhash_of_long_lines_counts_every_word():
    rnd = random.Random(3)
    line = (prose(rnd, 1500, 10**6) + " the the the").encode()
    data, off = text_buffers(pa.array([b"a b", line, b"c"], pa.binary()))
    _, _, first, h, _, _ = ld.lines_of(data, off, 0, 3)
    got = ld.simhash(h, first)
    assert got[1].tolist() == blocks(line) and got[0].tolist() == blocks(b"a b")
    own = np.unique(h[first[1]:first[2]])
    ones = sum((int(ld.mix(own[k:k + 1], 11)[0]) & 1) for k in range(len(own)))
    assert got[1][0] & 1 == (2 * ones > len(own))


def changed(rnd, n, edits, kind):
    """A line of n words, and it with ``edits`` words replaced, mistyped, taken out or put in."""
    a = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 8))) for _ in range(n)]
    b = list(a)
    for k in sorted(rnd.sample(range(n), edits), reverse=True):
        if kind == "out":
            del b[k]
        elif kind == "in":
            b.insert(k, "new")
        elif kind == "typo":
            at = rnd.randrange(len(b[k]))
            b[k] = b[k][:at] + "z" + b[k][at + 1:] if b[k][at] != "z" else b[k][:at] + "y" + b[k][at + 1:]
        else:
            b[k] = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(len(b[k])))
    return " ".join(a).encode(), " ".join(b).encode()


RECALL = [(6, 1, "typo"), (10, 1, "typo"), (12, 1, "typo"), (12, 1, "new"), (12, 1, "out"), (12, 1, "in"), (20, 1, "new"), (20, 2, "typo"), (20, 2, "new"),
          (30, 1, "new"), (30, 3, "typo"), (50, 1, "typo"), (50, 3, "new"), (50, 5, "typo"), (100, 5, "new"), (100, 10, "typo")]


def recall(n, edits, kind, pairs=400):
    """Share of the pairs alike by edit distance alone that meet under a key."""
    rnd = random.Random(f"{n} {edits} {kind}")
    alike = [(a, b) for a, b in (changed(rnd, n, edits, kind) for _ in range(pairs)) if ld.similar(a, b)]
    keys = ld.blocks_of([x for p in alike for x in p]).reshape(len(alike), 2, -1)
    return len(alike), float((keys[:, 0] == keys[:, 1]).any(axis=1).mean())


def test_recall_of_edit_similar_lines():
    for case in RECALL:
        n, found = recall(*case)
        assert n >= 50 and found >= 0.9, (case, n, found)


def test_one_mistyped_word_goes(spark):
    rnd = random.Random(11)
    pairs = [changed(rnd, n, 1, "typo") for n in (6, 10, 12, 15, 20, 30, 50) for _ in range(12)]
    rows = [(2 * k + s, p[s].decode(), "en", "a") for k, p in enumerate(pairs) for s in (0, 1)]
    got = {r.doc_id: r._n_gone for r in ld.dedup(docs_frame(spark, rows)).collect()}
    assert not any(got[2 * k] for k in range(len(pairs))) and sum(got[2 * k + 1] for k in range(len(pairs))) >= 0.95 * len(pairs)


def test_nothing(spark):
    assert ld.dedup(docs_frame(spark, [])).collect() == []
