"""Periodic runs of words (operator 13).

A run is a stretch of consecutive words with smallest period q that no
neighbouring word extends keeping q, at least ``TIMES`` periods and ``LEAST``
words long. Words are appended one by one to a suffix automaton whose
suffix-link tree is kept as a link-cut forest: the states on one preferred path
share the place where their strings ended last. Appending word i makes the path
from its state to the root preferred, and so meets every segment of old colour.
A segment whose longest string (length L) ended last at j has that string at j
and at i; for d = i - j <= L these overlap or touch, a square of period d, and
words j - L + 1 to i have period d. L is the longest for j, so the stretch
can't be extended to the left, and j is the last end, so no smaller period
holds. The last i that shows a start and period is the run's end.

Each word of a run occurs ``TIMES`` times in it. So words that are rarer in a
stretch of text cut it, again and again until nothing is left to cut; the
automaton takes the stretches that remain. No run is lost by that, since a
neighbour that extended one would occur ``TIMES`` times too. Every text is one
row and stays in one task; memory is in proportion to its words (about 1 kB for
a word of a remaining stretch).

Defined cases: a null, blank or empty text has no words and no runs; a null id
is read as the empty one; equal rows give equal results, each its own; an empty
table gives no rows. Only id and text are read, so further columns don't clash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import ship, text_buffers

TIMES, LEAST = 4, 6
#: Stretches of fewer words are counted by a Counter, longer ones by numpy.
SHORT = 256


def stretches(ids: list[int], times: int = TIMES, least: int = LEAST):
    """Bounds of the parts of ``ids`` that can hold runs, in no order."""
    todo = [(0, len(ids))]
    while todo:
        a, b = todo.pop()
        if b - a < least:
            continue
        part = ids[a:b]
        if b - a < SHORT:
            n = Counter(part)
            cuts = [k for k, x in enumerate(part, a) if n[x] < times]
        else:
            _, at, n = np.unique(part, return_inverse=True, return_counts=True)
            cuts = (np.flatnonzero(n[at] < times) + a).tolist()
        if cuts:
            todo += [(x + 1, y) for x, y in pairwise([a - 1, *cuts, b]) if y - x > least]
        else:
            yield a, b


class SuffixForest:
    """Suffix automaton of a growing word sequence with link-cut access.

    State 0 is the root. ``up`` holds splay parents inside a preferred path and
    the path's parent at its splay root, ``ended`` (at splay roots) the place
    where the path's strings ended last, -1 for none.
    """

    def __init__(self, times: int = TIMES, least: int = LEAST):
        self.next, self.link, self.length = [{}], [-1], [0]
        self.left, self.right, self.up, self.ended = [-1], [-1], [-1], [-1]
        self.whole, self.size = 0, 0
        self.times, self.least = times, least
        #: (start, period) of each run so far: its last word.
        self.runs: dict[tuple[int, int], int] = {}

    def _state(self, length: int, moves: dict) -> int:
        self.next.append(moves)
        self.length.append(length)
        for column in (self.link, self.left, self.right, self.up, self.ended):
            column.append(-1)
        return len(self.length) - 1

    def splay(self, x: int) -> None:
        """Makes ``x`` the splay root of its preferred path."""
        left, right, up = self.left, self.right, self.up
        y = up[x]
        while y >= 0 and (left[y] == x or right[y] == x):
            z = up[y]
            if z >= 0 and (left[z] == y or right[z] == y):
                # two steps: first the parent (same side) or x itself (other side)
                if (left[z] == y) == (left[y] == x):
                    self._rotate(y, z)
                else:
                    self._rotate(x, y)
                    y = z
            self._rotate(x, y)
            y = up[x]

    def _rotate(self, x: int, y: int) -> None:
        """``x``, child of ``y``, takes its place (and colour, if ``y`` is a splay root)."""
        left, right, up = self.left, self.right, self.up
        self.ended[x] = self.ended[y]
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b >= 0:
            up[b] = y
        up[y], up[x] = x, z
        if z >= 0:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def _access(self, x: int, i: int) -> None:
        """Recolours the path from ``x`` to the root to ``i``; squares that its
        segments of old colour show go to ``runs``."""
        left, right, up, ended, length, runs = self.left, self.right, self.up, self.ended, self.length, self.runs
        times, least, below = self.times, self.least, -1
        while x >= 0:
            self.splay(x)
            j = ended[x]
            if right[x] >= 0:
                ended[right[x]] = j  # deeper states keep their colour on a path of their own
            right[x] = below
            if j >= 0:
                d, most = i - j, length[x]
                if most + d >= times * d and most + d >= least:
                    runs[j - most + 1, d] = i
            below, x = x, up[x]
        ended[below] = i

    def append(self, word: int) -> None:
        i, moves, link, length = self.size, self.next, self.link, self.length
        new, p = self._state(i + 1, {}), self.whole
        while p >= 0 and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        if p < 0:
            parent = 0
        else:
            parent = q = moves[p][word]
            if length[p] + 1 != length[q]:
                parent = self._split(q, length[p] + 1)
                while p >= 0 and moves[p].get(word) == q:
                    moves[p][word] = parent
                    p = link[p]
        link[new] = self.up[new] = parent
        self.whole, self.size = new, i + 1
        self._access(new, i)

    def _split(self, q: int, length: int) -> int:
        """A state for the strings of ``q`` up to ``length``, put just above it
        on its preferred path, whose colour they share."""
        c = self._state(length, dict(self.next[q]))
        self.link[c], self.link[q] = self.link[q], c
        self.splay(q)
        above = self.left[c] = self.left[q]
        if above >= 0:
            self.up[above] = c
        self.left[q], self.up[c] = c, q
        return c


def word_runs(words: list, times: int = TIMES, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    number: dict = {}
    ids = [number.setdefault(w, len(number)) for w in words]
    out = []
    for a, b in stretches(ids, times, least):
        forest = SuffixForest(times, least)
        for x in ids[a:b]:
            forest.append(x)
        out += [(a + start, end - start + 1, period) for (start, period), end in forest.runs.items()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list, runs) -> list:
    """``words`` without those that stand in a run after its first period."""
    change = [0] * (len(words) + 1)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    inside, out = 0, []
    for w, c in zip(words, change):
        inside += c
        if not inside:
            out.append(w)
    return out


def plant(doc_id, words: list) -> list:
    """Of a tenth of the documents, by a hash of the id, the words from some
    place on repeat a stretch of the text."""
    h = 0 if doc_id is None else crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


RUNS = "array<struct<start:long,length:long,period:long>>"


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES, least: int = LEAST,
         rewrite: Callable | None = None) -> DataFrame:
    """One row per document: id, ``n_words``, ``runs`` and the text ``collapsed``
    to the words that stand outside the repeats of runs, joined by blanks.
    ``rewrite(id, words)`` may give other words first."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = [id_col, "n_words", "runs", "collapsed"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            data, off = text_buffers(batch.column(1))
            ns, found, texts = [], [], []
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                words = data[off[k]:off[k + 1]].tobytes().split()
                words = rewrite(doc_id, words) if rewrite else words
                runs = word_runs(words, times, least)
                ns.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                texts.append(b" ".join(collapsed(words, runs) if runs else words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(found, kind), pa.array(texts, pa.string())], names=names)

    ship(docs.sparkSession)
    return d.mapInArrow(run, f"`{id_col}` {d.schema[0].dataType.simpleString()}, n_words long, runs {RUNS}, collapsed string")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document the number of runs, the longest (ties: smallest start, then
    period) and digests of all runs and of the collapsed text."""
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    return found.select(id_col, "runs", "collapsed", longest.alias("best")).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), (-best["n"]).alias("length"), best["period"].alias("period"),
        F.expr("(-best.n * 1000) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
