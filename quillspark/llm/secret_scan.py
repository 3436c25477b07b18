"""Secret scans by a battery of randomness tests (operator 12).

Three fixed patterns give the base spans. The method adds runs of 20 or more
characters of ``A-Za-z0-9+/_-`` that look generated. For such a run the
smallest alphabet of ``ENCODINGS`` that holds all its symbols is inferred, and
three statistics are taken on it:

* chi-squared, against equal shares of the alphabet's symbols;
* runs, the number of changes of character class (upper, lower, digit, other)
  between neighbours; of alphabets of one class, changes of half;
* serial correlation of neighbours' ranks in the alphabet.

Each is judged twice. Against equal and independent symbols it gives a
two-sided (chi-squared: upper) p-value, the three are combined by Fisher's
method, and a run that this rejects below ``REJECT`` is no generated secret. Against
the ordinary text of the corpus (frequencies, class changes and correlation of
neighbours of the same alphabet, counted over all shorter runs of all documents) it
gives the probability to look as random by chance, again combined by Fisher's method.
The discoveries among all runs of the corpus are controlled by the
Benjamini-Hochberg rule at ``FDR``, weighted by length: a run of n symbols may
have a p-value up to n / (sum of all n) * FDR * (number of discoveries), so a
short run, which shows little, needs more evidence. The rule is read off a histogram of
log10(n / p) in steps of 0.01, so only bounded counts come to the driver.

The p-values rest on normal approximations and a Chernoff bound (class
changes), and Fisher's method takes the tests as independent; the rate is
nominal therefore. A run that overlaps a base span is not listed again.

Defined cases: a null or empty text has no spans; very long texts are searched
whole; rows that repeat an id are each searched; of equal starts the kinds come
in the order of ``KINDS``; an empty table gives no rows. Only id and text are
read, so further columns don't clash.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import cut, segments, ship, text_buffers, word_spans

KINDS = ("assign", "access", "hex", "random")
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_RANDOM = 6, 20, 24, 20
REJECT, FDR = 0.001, 0.01
PRIOR = 100
#: Highest log10(n / p) that the histogram tells apart.
TOP = 60
_ASSIGN = re.compile(rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
DIGITS, LOWER, UPPER = b"0123456789", bytes(range(97, 123)), bytes(range(65, 91))
#: Alphabets from small to large.
ENCODINGS = {"decimal": DIGITS, "hex": DIGITS + LOWER[:6], "HEX": DIGITS + UPPER[:6], "lower": LOWER, "upper": UPPER, "base32": UPPER + DIGITS[2:8],
             "base36": DIGITS + LOWER, "BASE36": DIGITS + UPPER, "letters": UPPER + LOWER, "base62": UPPER + LOWER + DIGITS,
             "base64": UPPER + LOWER + DIGITS + b"+/", "base64url": UPPER + LOWER + DIGITS + b"-_", "all": UPPER + LOWER + DIGITS + b"+/-_"}


def _not_of(symbols: bytes) -> np.ndarray:
    out = np.ones(256, bool)
    out[list(symbols)] = False
    return out


_TOKEN_GAP, _HEX_GAP = _not_of(ENCODINGS["all"]), _not_of(ENCODINGS["hex"])
_MEMBERS = [frozenset(s) for s in ENCODINGS.values()]
_CONTINUATION = bytes(range(0x80, 0xC0))


def _classes(symbols: bytes) -> np.ndarray:
    """Class of each byte: upper, lower, digit or other; in an alphabet of one
    class, its lower or upper half."""
    kind = [0 if b in UPPER else 1 if b in LOWER else 2 if b in DIGITS else 3 for b in symbols]
    if len(set(kind)) == 1:
        kind = [2 * k >= len(symbols) for k in range(len(symbols))]
    out = np.zeros(256, np.int64)
    out[list(symbols)] = kind
    return out


def _ranks(symbols: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(symbols)] = np.arange(len(symbols))
    return out


_CLASS = [_classes(s) for s in ENCODINGS.values()]
_RANK = [_ranks(s) for s in ENCODINGS.values()]
#: Of each alphabet, the chances that two, and three, symbols are of one class.
_SAME = [tuple(float(((np.bincount(c[list(s)], minlength=4) / len(s)) ** p).sum()) for p in (2, 3)) for s, c in zip(ENCODINGS.values(), _CLASS)]


def _long(data, off, gap, least):
    """Spans of at least ``least`` bytes without a byte of ``gap``, and their rows."""
    s, e = word_spans(data, off, gap)
    at = np.flatnonzero(e - s >= least)
    return s[at], e[at], np.searchsorted(off, s[at], side="right") - 1


def pair_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pair, n)``: neighbours a, b (as 128 a + b) of all texts, both of the
    largest alphabet and in a run too short to be tested."""

    def run(batches):
        total = np.zeros(1 << 14, np.int64)
        for batch in batches:
            data, off = text_buffers(batch.column(0))
            for i, j in segments(off):
                o, part = off[i:j + 1], data[off[i]:off[j]]
                fits = ~_TOKEN_GAP[part]
                for s, e, _ in zip(*_long(data, o, _TOKEN_GAP, MIN_RANDOM)):
                    fits[s - o[0]:e - o[0]] = False
                both = fits[:-1] & fits[1:]
                ends = o[1:-1] - o[0] - 1  # last byte of a text that another follows
                both[ends[(ends >= 0) & (ends < len(both))]] = False
                for lo in range(0, len(both), 1 << 20):
                    at = np.flatnonzero(both[lo:lo + (1 << 20)]) + lo
                    total += np.bincount(part[at].astype(np.int64) * 128 + part[at + 1], minlength=1 << 14)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["pair", "n"])

    ship(texts.sparkSession)
    return texts.select(text_col).mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def ordinary(texts: DataFrame, text_col: str = "text") -> list[tuple[float, float, float, float]]:
    """Of each alphabet, in ordinary text: sums of squared and of cubed symbol
    frequencies, rate of class changes and correlation of neighbours. An alphabet
    of several classes counts ``PRIOR`` pairs more of the largest alphabet's values
    (what is rare in the corpus says little); others, and the largest, one pair
    of equal, independent symbols."""
    n = np.zeros(1 << 14)
    for r in pair_counts(texts, text_col).collect():
        n[r["pair"]] = r["n"]
    n = n.reshape(128, 128)
    out: list = []
    for symbols, kind, rank in reversed(list(zip(ENCODINGS.values(), _CLASS, _RANK))):  # the largest first
        s = list(symbols)
        m, kind, rank = n[np.ix_(s, s)] + 1 / len(s) ** 2, kind[s], rank[s]
        f, g = m.sum(axis=1) / m.sum(), m.sum(axis=0) / m.sum()
        x, y = rank - f @ rank, rank - g @ rank
        spread = math.sqrt((f @ x ** 2) * (g @ y ** 2))
        mine = (float(f @ f), float((f ** 3).sum()), float(m[kind[:, None] != kind[None, :]].sum() / m.sum()), float(x @ m @ y / m.sum() / spread) if spread > 0 else 0.0)
        if out and symbols not in (DIGITS, LOWER, UPPER):
            mine = tuple((m.sum() * a + PRIOR * b) / (m.sum() + PRIOR) for a, b in zip(mine, out[0]))
        out.append(mine)
    return out[::-1]


def _tail(z: float) -> float:
    """Probability of a standard normal above ``z``."""
    return max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300)


def _fisher(*p: float) -> float:
    """Fisher's combination of three p-values (chi-squared, six degrees of freedom)."""
    half = -sum(math.log(min(x, 1.0)) for x in p)
    return math.exp(-half) * (1 + half + half * half / 2)


def inferred(token: bytes) -> int:
    """Index of the smallest alphabet that holds the token."""
    symbols = frozenset(token)
    return next(k for k, m in enumerate(_MEMBERS) if symbols <= m)


def battery(token: bytes, text: list[tuple[float, float, float, float]]) -> tuple[float, float]:
    """Combined p-values of a token: of equal, independent symbols, and of
    ordinary text to look as random."""
    k = inferred(token)
    n, size = len(token), len(_MEMBERS[k])
    t = np.frombuffer(token, np.uint8)
    square, cube, rate, related = text[k]

    # chi-squared; gamma of the same mean and variance, by cube roots
    count = np.bincount(t, minlength=256)
    meet = float((count * (count - 1)).sum())
    chi = size / n * (meet + n) - n
    mean, var = size - 1.0, 2 * (size - 1.0) * (n - 1) / n
    shape = mean * mean / var
    even = _tail(((max(chi, 0.0) / mean) ** (1 / 3) - 1 + 1 / (9 * shape)) * math.sqrt(9 * shape))
    expect = n * (n - 1) * square
    spread = math.sqrt(max(4 * n * (n - 1) * (n - 2) * (cube - square ** 2) + 2 * n * (n - 1) * square * (1 - square), 1e-9))
    even_text = _tail((expect - meet) / -spread) if spread else 0.5

    # changes of class
    kind = _CLASS[k][t]
    changes = int((kind[1:] != kind[:-1]).sum())
    same, three = _SAME[k]
    var = (n - 1) * same * (1 - same) + 2 * (n - 2) * (three - same ** 2)
    turns = 2 * _tail((abs(changes - (n - 1) * (1 - same)) - 0.5) / math.sqrt(var))
    v = changes / (n - 1)
    turns_text = 1.0
    if v > rate:  # Chernoff bound of a binomial's upper tail
        apart = v * math.log(v / rate) + ((1 - v) * math.log((1 - v) / (1 - rate)) if v < 1 else 0.0)
        turns_text = max(math.exp(-(n - 1) * apart), 1e-300)

    # neighbours' correlation
    x = _RANK[k][t]
    x = x - x.mean()
    power = float(x @ x)
    r = float(x[1:] @ x[:-1]) / power if power else 1.0
    serial = 2 * _tail(abs(r + 1 / n) * math.sqrt(n))
    serial_text = _tail(((r - related) if related < 0 else (related - r)) * math.sqrt(n))
    return _fisher(even, turns, serial), _fisher(even_text, turns_text, serial_text)


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of the two patterns that need the text's order."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_VALUE]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return out


def row_spans(column, text) -> list[list[tuple[int, int, int, float | None, float | None]]]:
    """Per text of an Arrow column its (start, kind, end, log10(n / p), n), in
    code points; the last two only of runs tested, kind 3 those not rejected,
    kind 4 the rest, which count as tested."""
    data, off = text_buffers(column)
    out: list = []
    for i, j in segments(off):
        o = off[i:j + 1]
        spans: list = [[] for _ in range(j - i)]
        for s, e, r in zip(*(x.tolist() for x in _long(data, o, _HEX_GAP, MIN_HEX))):
            spans[r].append((s, 2, e, None, None))
        tokens = [(s, e, r) for s, e, r in zip(*(x.tolist() for x in _long(data, o, _TOKEN_GAP, MIN_RANDOM)))]
        for r in range(j - i):
            lo = int(o[r])
            spans[r] += [(lo + s, k, lo + e, None, None) for s, k, e in base_spans(data[lo:int(o[r + 1])].tobytes())]
        for s, e, r in tokens:
            run = data[s:e].tobytes()
            core = run.strip(b"+/_-")
            if len(core) >= MIN_RANDOM:
                s += len(run) - len(run.lstrip(b"+/_-"))
                e = s + len(core)
                even, by_text = battery(core, text)
                known = any(a < e and s < b for a, k, b, *_ in spans[r] if k < 3)
                spans[r].append((s, 4 if known or even < REJECT else 3, e, min(math.log10(len(core) / max(by_text, 1e-300)), float(TOP)), len(core)))
        for r in range(j - i):
            out.append(_code_points(data[int(o[r]):int(o[r + 1])], int(o[r]), sorted(spans[r], key=lambda x: x[:2])))
    return out


def _code_points(part: np.ndarray, lo: int, spans: list) -> list:
    if not spans:
        return []
    places = sorted({x for s, _, e, *_ in spans for x in (s - lo, e - lo)})
    at, n, last, text = {}, 0, 0, part.tobytes()
    for p in places:
        n += len(text[last:p].translate(None, _CONTINUATION))
        at[p], last = n, p
    return [(at[s - lo], k, at[e - lo], level, size) for s, k, e, level, size in spans]


SPANS = "array<struct<start:long,kind:int,end:long,level:double,n:long>>"


def threshold(found: DataFrame, fdr: float = FDR) -> float:
    """Least log10(n / p) of a discovery by the length-weighted rule; infinite if none.
    ``found`` has ``spans`` with the tested runs. One row for each step of 0.01 comes to the driver."""
    tested = found.select(F.explode("spans").alias("s")).where("s.level is not null")
    bins = sorted(map(tuple, tested.groupBy(F.floor(F.col("s.level") * 100)).agg(F.count("*"), F.sum("s.n")).collect()))
    every, above, best = sum(size for _, _, size in bins), 0, math.inf
    for step, n, _ in reversed(bins):
        above += n
        if 10 ** (-step / 100) * every <= fdr * above:
            best = step / 100
    return best


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per document: id and ``spans`` (start, end, kind), by start, then kind."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    text = ordinary(d)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("level", pa.float64()), ("n", pa.int64())]))
    fields = [f.name for f in kind.value_type]

    def run(batches):
        for batch in batches:
            spans = [[dict(zip(fields, x)) for x in row] for row in row_spans(batch.column(1), text)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["id", "spans"])

    ship(docs.sparkSession)
    found = cut(d.mapInArrow(run, f"id {d.schema[0].dataType.simpleString()}, spans {SPANS}"))
    least = threshold(found, fdr)
    kept = F.filter("spans", lambda s: (s["kind"] < 3) | ((s["kind"] == 3) & (s["level"] >= least)))
    named = F.transform(F.array_sort(kept), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                               F.get(F.array(*map(F.lit, KINDS)), s["kind"]).alias("kind")))
    return found.select(F.col("id").alias(id_col), named.alias("spans"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans as text."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] != KINDS[3])
    return found.select(id_col, *map(count, KINDS[:3]), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
