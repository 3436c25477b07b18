"""Fuzzy line dedup over the whole corpus (operator 7).

Lines are normalised (A-Z lowered, digits as 0, ASCII punctuation and white
space as gaps). Every distinct normalised line gets a SimHash of its distinct
words, of ``BLOCKS`` * ``BITS`` bits. One changed word in ten moves about 30 of
these bits, so whole blocks alone find few such lines; ``BANDS`` keys more are
made of the least hashes of its word pairs, ``ROWS`` to a key, and in lines of
fewer than ``SHORT`` words of the line without one of its words. Two lines that
agree in one key, as lines with fewer than ``BLOCKS`` differing bits must, and
whose lengths fit, are compared; an edit similarity of ``SIMILAR`` or more
links them. Of every connected group of lines, equal ones included, the first
occurrence (by document, then line) stays.

Scale: keys travel packed, nine bytes each: four of the key (its first bits
name the bucket) and five of the line's hash. Two lines whose five bytes agree
only add candidates. Short lists of a key become pairs, longer ones are
compared in bounded cells. The texts are read again once, for the occurrences
(rows of four numbers) and the lines that a bitmap of the candidates marks;
lines it marks by chance find no candidate. The pairs of a group of lines meet
in one task, which has every text once and compares no further what is linked
by then. Edit distances are counted for many pairs at once, those of very long
lines one by one. The joins back to occurrences of a hot line can be split
by adaptive execution.

Defined cases: lines without a word stay; null and empty texts have no lines
and stay as they are; rows of equal id and text count as one document; a null
id comes first.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.cells import MET, grouped_pairs, list_groups, pairs_of_runs, runs_of, squares
from quillspark.llm.common import _LOWER, NOT_ALNUM, components, cut, gaps, mix, row_words, segments, shared_dir, text_buffers, word_hashes, word_spans

BLOCKS, BITS, SIMILAR, MOST, CELL = 8, 28, 0.9, 32, 500
#: Keys of least pair hashes, hashes to a key, and words from which lines have all of them.
BANDS, ROWS, SHORT = 14, 4, 10
KEYS = BLOCKS + BANDS
#: Width of a length band, as a ratio; lines near a border fall into both.
BAND = 2.0
#: Bits of a key that name its bucket, bits of a line's hash that go with it, keys packed at once.
BUCKET, LINE, PACK = 12, 40, 1 << 20
#: Bits of the candidates' bitmap, at most (beyond, more lines are marked by chance).
MARKS = 30

_GAP = gaps(NOT_ALNUM)
_TABLE = _LOWER.copy()
_TABLE[48:58] = _LOWER[48]
#: The normalised byte of each byte; gaps are blanks.
_PLAIN = np.where(_GAP, 32, _TABLE - np.uint64(1)).astype(np.uint8)
#: Odd factors: each orders the word pairs anew.
_ODD = mix(np.arange(1 + BANDS * ROWS, dtype=np.uint64), 41) | np.uint64(1)
_LANES = np.uint64(0x0101010101010101)
_PACKED = np.dtype([("key", "<u4"), ("low", "<u4"), ("high", "u1")])


def lines_of(data, off, i, j, hashes: bool = True):
    """Of rows i..j: per line with words its row, number in the row, first
    word (with a closing entry), the word hashes, word starts and ends."""
    s, e = word_spans(data, off[i:j + 1], _GAP)
    h = word_hashes(data, s, e, _TABLE) if hashes else None
    lo, hi = int(off[i]), int(off[j])
    breaks = np.flatnonzero(data[lo:hi] == 10) + lo
    starts = np.union1d(off[i:j], breaks + 1)
    starts = starts[starts < hi]
    row = np.searchsorted(off[:j + 1], starts, side="right") - 1
    number = np.searchsorted(breaks, starts) - np.searchsorted(breaks, off[row])
    first = np.searchsorted(s, starts)
    has = np.diff(np.append(first, len(s))) > 0
    return row[has], number[has], np.append(first[has], len(s)), h, s, e


def line_hashes(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    count = np.diff(first)
    place = np.arange(len(h)) - np.repeat(first[:-1], count)
    return mix(np.add.reduceat(mix(h ^ mix(place.astype(np.uint64), 3), 4), first[:-1]), 5) if len(count) else np.zeros(0, np.uint64)


def pair_bands(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Keys of every line's least hashes of neighbouring words. A line of n
    words, fewer than ``SHORT``, has in the first n columns the line without
    its first, second, ... word, so that one changed word is always found."""
    n, count = len(first) - 1, np.diff(first)
    pair = mix(h, 31)
    pair[:-1] += h[1:] * _ODD[0]
    inner = np.ones(len(h), bool)
    inner[first[1:][count > 1] - 1] = False  # the last word has no right neighbour
    pair[first[:-1][count == 1]] = mix(h[first[:-1][count == 1]], 32)
    pair = mix(pair[inner], 33)
    start = np.concatenate(([0], np.cumsum(np.maximum(count - 1, 1))[:-1]))
    out = np.empty((n, BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(n, band, np.uint64)
        for k in range(ROWS):
            key = mix(key ^ np.minimum.reduceat(pair * _ODD[1 + band * ROWS + k], start), 34)
        out[:, band] = key
    line = np.repeat(np.arange(n), count)
    use = (count < SHORT)[line]
    if use.any():
        place = np.arange(len(h)) - first[line]
        word = mix(h ^ mix(place.astype(np.uint64), 35), 36)
        rest = np.add.reduceat(word, first[:-1])[line] - word
        out[line[use], place[use]] = mix(rest[use] ^ mix(count[line[use]].astype(np.uint64), 37), 38)
    return out.view(np.int64)


def simhash(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Keys of every line: the blocks (one integer each) of the SimHash of its
    distinct words (else the commonest words would make lines alike), then
    its ``pair_bands``."""
    n = len(first) - 1
    if not n:
        return np.zeros((0, KEYS), np.int64)
    bands = pair_bands(h, first)
    key = (np.repeat(np.arange(n, dtype=np.uint64), np.diff(first)) << np.uint64(40)) | (h >> np.uint64(24))
    order = np.argsort(key)
    key, h = key[order], h[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    h, first = h[new], np.searchsorted(key[new] >> np.uint64(40), np.arange(n + 1, dtype=np.uint64))
    count = np.diff(first)
    # eight 8-bit counters ride in one word, so runs hold at most 255 words
    runs = -(-count // 255)
    start = np.repeat(first[:-1], runs) + 255 * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    own = np.cumsum(runs) - runs
    words = -(-BLOCKS * BITS // 64)
    bits = np.zeros((n, words, 8, 8), bool)
    for word in range(words):
        x = mix(h, 11 + word)
        for bit in range(8):  # of every byte
            sums = np.add.reduceat((x >> np.uint64(bit)) & _LANES, start)
            ones = sums.view(np.uint8).reshape(-1, 8).astype(np.int64)
            if len(ones) > n:
                ones = np.add.reduceat(ones, own)
            bits[:, word, :, bit] = 2 * ones > count[:, None]
    bits = bits.reshape(n, -1)[:, :BLOCKS * BITS].reshape(n, BLOCKS, BITS)
    return np.concatenate((bits @ (np.int64(1) << np.arange(BITS, dtype=np.int64)), bands), axis=1)


def lengths(first, s, e) -> np.ndarray:
    """Bytes of the normalised lines: words and one gap between them."""
    return np.add.reduceat(e - s + 1, first[:-1]) - 1 if len(first) > 1 else np.zeros(0, np.int64)


def bands(length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band of each length, and of the length a similar longer line may have."""
    return (np.floor(np.log(length) / math.log(BAND)).astype(np.int64),
            np.floor(np.log(length / SIMILAR) / math.log(BAND)).astype(np.int64))


def edit_within(a: bytes, b: bytes, most: int) -> bool:
    """Whether the edit distance is at most ``most`` (bit-parallel columns)."""
    if abs(len(a) - len(b)) > most:
        return False
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    other = np.flatnonzero(x[:n] != y[:n])
    i = int(other[0]) if len(other) else n
    other = np.flatnonzero(x[len(a) - n + i:] != y[len(b) - n + i:])
    j = n - i - 1 - int(other[-1]) if len(other) else n - i
    a, b = a[i:len(a) - j], b[i:len(b) - j]
    if not a or not b:
        return len(a) + len(b) <= most
    where: dict[int, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full, top, up, down, score = (1 << len(a)) - 1, 1 << (len(a) - 1), (1 << len(a)) - 1, 0, len(a)
    for k, c in enumerate(b):
        same = where.get(c, 0)
        diag = (((same & up) + up) ^ up) | same | down
        grow, fall = down | ~(diag | up) & full, up & diag
        score += bool(grow & top) - bool(fall & top)
        if score - (len(b) - 1 - k) > most:
            return False
        grow = (grow << 1 | 1) & full
        up, down = (fall << 1) & full | ~(diag | grow) & full, grow & diag
    return score <= most


def similar(a: bytes, b: bytes) -> bool:
    return edit_within(a, b, int((1 - SIMILAR) * max(len(a), len(b)) + 1e-9))


def band_within(a: bytes, b: bytes, most: int) -> bool:
    """``edit_within`` for long rows: columns hold only the places that so
    many edits reach, ``most`` above and below the diagonal."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return False
    if most > len(b) or not b:
        return edit_within(a, b, most)
    x = np.frombuffer(a, np.uint8)
    where = {c: int.from_bytes(np.packbits(x == c, bitorder="little").tobytes(), "little") for c in np.unique(x).tolist()}
    wide = 2 * most + 2
    full, top = (1 << wide) - 1, wide - 1
    up, down, score, begin = full >> most + 1 << most + 1, 0, most, most + 1 - wide
    edge, give_up, side = len(a) - most, 2 * most + len(b) - len(a), top - 1
    for k, c in enumerate(b):
        same = where.get(c, 0)
        same = (same >> begin if begin > 0 else same << -begin) & full
        begin += 1
        diag = ((((same & up) + up) ^ up) | same | down) & full
        grow, fall = down | full ^ (diag | up), diag & up
        if k < edge:  # along the band's last diagonal, then along the last row
            score += not diag >> top
        else:
            score += (grow >> side & 1) - (fall >> side & 1)
            side -= 1
        if score > give_up:
            return False
        diag >>= 1
        up, down = fall | full ^ (diag | grow), diag & grow
    return score <= most


def alike(a: pa.Array, b: pa.Array, elements: int = 1 << 16) -> np.ndarray:
    """``similar`` of many pairs, the rows of two columns."""
    a, b = a.to_pylist(), b.to_pylist()
    m, n = (np.array([len(x) for x in y], np.int64) for y in (a, b))
    low, high = np.minimum(m, n), np.maximum(m, n)
    most = ((1 - SIMILAR) * high + 1e-9).astype(np.int64)
    out = np.zeros(len(m), bool)
    todo = np.flatnonzero(high - low <= most)
    # pairs of about as many edits go together, in the order of their difference in length
    step = (np.log2(most + 1) * 2).astype(np.int64)
    todo = todo[np.lexsort(((high - low)[todo], step[todo]))]
    while len(todo):
        # as many pairs as fit by diagonals and by bytes
        fit = (np.arange(1, len(todo) + 1) * (np.maximum.accumulate(most[todo]) + 1) <= elements) & (np.cumsum(high[todo]) <= 32 * elements)
        fit &= step[todo] == step[todo[0]]
        lot, todo = np.split(todo, [max(1, int(fit.argmin()) if not fit.all() else len(fit))])
        pairs = [(a[k], b[k]) if len(a[k]) <= len(b[k]) else (b[k], a[k]) for k in lot.tolist()]
        short, long = [x for x, _ in pairs], [y for _, y in pairs]
        out[lot] = _quickest(short, long, low[lot], high[lot], most[lot])
    return out


def _quickest(short: list, long: list, m, n, most) -> np.ndarray:
    """Whether ``most`` edits lead from one row to the other, by the way whose
    steps take least time (nanoseconds, measured) for so many pairs so long."""
    def reached(within):
        return _reached(*(_windows(*text_buffers(pa.array(x, pa.binary()))) for x in (short, long)), m, n, within)

    wide, count = int(most.max()) + 1, len(m)
    table = (int((m + n).max()) * (9_000 + count * wide // 4)) if wide < 60_000 else math.inf
    places = 50 * count * wide * wide + (50_000 + 30 * int(n.max())) * wide
    single = int((1_100 * n + n * n * 9 // 100).sum())
    if places <= min(table, single):
        return reached(most)
    if table <= single:
        return _within(short, long, m, n, most)
    out = reached(np.minimum(most, 32)) if n.max() > 20_000 else np.zeros(count, bool)  # first those that few edits tell
    for k in np.flatnonzero(~out).tolist():
        out[k] = band_within(long[k], short[k], int(most[k]))
    return out


def _within(short: list, long: list, m, n, most) -> np.ndarray:
    """Whether ``most`` edits lead from one row to the other: the table of edit
    distances by antidiagonals, of all pairs at once (a column each), on the
    diagonals that a path of so many edits can touch. Distances are cut off
    above every ``most``."""
    kind, top = (np.uint8, 200) if most.max() < 200 else (np.uint16, 60_000)
    out, live = np.zeros(len(m), bool), np.argsort(m + n, kind="stable")
    short, long, m, n, most = [short[k] for k in live.tolist()], [long[k] for k in live.tolist()], m[live], n[live], most[live]
    shift, ends = n - m, m + n
    low = -2 * int(-(-(most - shift).max() // 4))  # the first diagonal, even
    half = max(1, int(-(-((most + shift) // 2 - low).max() // 2)))  # even diagonals but one
    pad, size, last = half + 2 - low, int(n.max()), int(ends[-1])

    def columns(rows):
        own = np.zeros((size + 2 * pad, len(rows)), np.uint8)
        own[pad:pad + size] = np.frombuffer(b"".join([r.ljust(size) for r in rows]), np.uint8).reshape(len(rows), size).T
        return own

    x, y = columns(short)[::-1].copy(), columns(long)
    y_gone = over = 0  # rows of y cut off, columns that have ended
    even, odd = np.full((half + 1, len(m)), top, kind), np.full((half + 2, len(m)), top, kind)
    even[-low // 2] = 0
    out[live[ends == 0]] = True
    at_end, one = (np.bincount(ends, minlength=last + 1) > 0).tolist(), kind(1)

    def sides():
        """Of the even and of the odd antidiagonals: cells, their neighbours before and behind, room for sums and marks."""
        room, marks = np.empty_like(even), np.empty(even.shape, bool)
        return [(even, odd[:-1], odd[1:], room, marks, marks.view(np.uint8)),
                (odd[1:-1], even[:-1], even[1:], room[1:], marks[1:], marks[1:].view(np.uint8))]

    views = sides()
    for step in range(1, last + 1):
        cell, before, behind, room, marks, differ = views[step & 1]
        first, rows = low + (step & 1), half + 1 - (step & 1)
        i, j = size + pad - ((step - first) >> 1), ((step + first) >> 1) - 1 + pad - y_gone
        np.not_equal(x[i:i + rows], y[j:j + rows], marks)
        np.add(cell, differ, cell)
        np.minimum(before, behind, room)
        np.add(room, one, room)
        np.minimum(cell, room, cell)
        if at_end[step]:
            start, over = over, int(np.searchsorted(ends, step, side="right"))
            done = np.arange(start, over)
            out[live[done]] = cell[(shift[done] - first) >> 1, done] <= most[done]
        if step % 32 == 0:
            np.minimum(even, top, out=even)
            np.minimum(odd, top, out=odd)
            keep = np.minimum(even.min(axis=0), odd.min(axis=0)) <= most
            keep[:over] = False
            left = np.flatnonzero(keep)
            if not len(left):
                break
            if len(left) < 0.6 * len(keep):
                # the rows still to be read, of the pairs still open
                x, y, y_gone = x[:i + rows], y[j:], y_gone + j
                x, y, even, odd = (z.take(left, axis=1) for z in (x, y, even, odd))
                views = sides()
                live, shift, most, ends, over = live[left], shift[left], most[left], ends[left], 0
    return out


def _windows(data, off):
    """The eight bytes from each byte on of some rows, and where the rows begin."""
    own = np.zeros(int(off[-1] - off[0]) + 8, np.uint8)
    own[:-8] = data[off[0]:off[-1]]
    return np.ndarray((len(own) - 7,), "<u8", own, strides=(1,)).copy(), off[:-1] - off[0]


def _reached(first, second, m, n, most):
    """Whether ``most`` edits lead from one row to the other: on every
    diagonal the furthest place that 0, 1, 2, ... edits reach."""
    (x, at), (y, to) = first, second
    out, live, shift = np.zeros(len(m), bool), np.arange(len(m)), n - m
    far, wide = np.zeros((len(m), 1), np.int64), 0
    for edits in range(int(most.max()) + 1):
        if edits:
            old, wide = far, wide + 1
            far = np.full((len(live), 2 * wide + 1), -1, np.int64)
            far[:, 1:-1] = old + 1
            np.maximum(far[:, :-2], old + 1, out=far[:, :-2])  # a byte of the first row left out
            np.maximum(far[:, 2:], old, out=far[:, 2:])  # a byte of the second put in
        # diagonals from which the edits left can lead to the end
        need = int((most - edits + np.abs(shift)).max())
        if wide > need:
            far, wide = far[:, wide - need:wide + need + 1], need
        side = np.arange(-wide, wide + 1)
        end = np.minimum(m[:, None], n[:, None] - side)
        far = np.minimum(far, end)
        u, v = at[:, None], to[:, None] + side
        other = x[u + far] ^ y[v + far]
        same = np.bitwise_count((other - np.uint64(1)) & ~other) >> 3
        far += same
        np.minimum(far, end, out=far)
        go = np.flatnonzero((same == 8) & (far < end))
        flat, last, v = far.reshape(-1), end.reshape(-1), v.reshape(-1)
        while len(go):
            other = x[at[go // len(side)] + flat[go]] ^ y[v[go] + flat[go]]
            same = np.bitwise_count((other - np.uint64(1)) & ~other) >> 3
            flat[go] = np.minimum(flat[go] + same, last[go])
            go = go[(same == 8) & (flat[go] < last[go])]
        place = shift + wide
        near = (place >= 0) & (place <= 2 * wide)
        done = near & (far[np.arange(len(m)), np.where(near, place, 0)] == m)
        out[live[done]] = True
        keep = ~done & (most > edits)
        if not keep.any():
            break
        if not keep.all():
            far, live, shift, m, n, most, at, to = (z[keep] for z in (far, live, shift, m, n, most, at, to))
    return out


def blocks_of(lines: list[bytes]) -> np.ndarray:
    """Keys of normalised lines."""
    data, off = text_buffers(pa.array(lines, pa.binary()))
    out = [np.zeros((0, KEYS), np.int64)]
    for i, j in segments(off):
        h, first, _, _ = row_words(data, off, i, j, _GAP, _TABLE)
        out.append(simhash(h, first))
    return np.concatenate(out)


def cell_lots(sides, lines, block, label, lot: int = 256, most: int = 8192):
    """Growing lots of pairs (i, k) of a cell's lines that share a key, without
    those ``label`` shows to be linked by then. A pair that shares several keys
    is compared in the list of the first one only."""
    side, size, held = np.array(sides), np.array([len(x) for x in lines]), []
    shared = (block == block[0]).all(axis=0)
    own = int(shared.argmax()) if shared.any() else None  # none: a line is here by its short hash only
    for i in np.flatnonzero(side != 1).tolist():
        other = side == 1 if side[i] == 0 else np.arange(len(side)) > i
        at = np.flatnonzero(other & (label != label[i]) & (np.minimum(size, size[i]) >= SIMILAR * np.maximum(size, size[i]) - 1e-9))
        same = block[at] == block[i]
        held += [(i, k) for k in at[same.any(axis=1) if own is None else same.argmax(axis=1) == own].tolist()]
        if len(held) >= lot:
            yield held
            held, lot = [], min(2 * lot, most)
    if held:
        yield held


def search(cells, root: dict) -> list[tuple[int, int]]:
    """Links that connect each cell (ids, sides, lines) of normalised lines;
    the lots of all cells are compared together. ``root`` keeps what is linked."""
    def find(x):
        while (y := root.get(x, x)) != x:
            root[x] = x = root.get(y, y)
        return x

    block, at, live, out = blocks_of([x for _, _, lines in cells for x in lines]), 0, [], []
    for ids, sides, lines in cells:
        label = np.array([find(x) for x in ids])
        live.append((ids, lines, label, cell_lots(sides, lines, block[at:at + len(ids)], label)))
        at += len(ids)
    while live:
        live = [(cell, lot) for cell in live if (lot := next(cell[3], None))]
        asked = [(ids, lines, label, i, k) for (ids, lines, label, _), lot in live for i, k in lot if find(ids[i]) != find(ids[k])]
        yes = alike(*(pa.array([x[1][x[n]] for x in asked], pa.binary()) for n in (3, 4)))
        for n in np.flatnonzero(yes).tolist():
            ids, _, label, i, k = asked[n]
            u, v = find(ids[i]), find(ids[k])
            if u != v:
                root[v] = u
                out.append((ids[i], ids[k]))
            if label[i] != label[k]:
                label[label == label[k]] = label[i]
        live = [cell for cell, _ in live]
    return out


def search_cells(batches, most: int = 4096):
    """Links of all cells in batches (cell, id, side, line) sorted by cell, a
    few thousand lines at once."""
    held, size, root = [], 0, {}

    def links():
        got = search(held, root)
        if len(root) > 500_000:
            root.clear()  # what it knows only saves comparisons
        return pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], names=["u", "v"])

    for _, cell in runs_of(batches, 3):
        held.append(cell)
        size += len(cell[0])
        if size >= most:
            yield links()
            held, size = [], 0
    if held:
        yield links()


def packed(held) -> pa.RecordBatch:
    """Rows ``(bucket, keys)`` of lists of keys and lines."""
    key, line = (np.concatenate(x) for x in zip(*held))
    order = np.argsort((key >> np.uint64(64 - BUCKET)).astype(np.uint16), kind="stable")
    key, line = key[order], line[order]
    rows = np.empty(len(key), _PACKED)
    rows["key"], rows["low"], rows["high"] = key >> np.uint64(32 - BUCKET), line, line >> np.uint64(32)
    bucket = (key >> np.uint64(64 - BUCKET)).astype(np.int32)
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    off = (np.append(at, len(key)) * _PACKED.itemsize).astype(np.int32)
    keys = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(off), pa.py_buffer(rows.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(bucket[at]), keys], names=["bucket", "keys"])


def block_keys(docs: DataFrame) -> DataFrame:
    """``(bucket, keys)``: packed keys of distinct lines to meet under."""
    def run(batches):
        seen: set = set()
        held, size = [], 0
        for b in batches:
            data, off = text_buffers(b.column(0))
            for i, j in segments(off):
                if off[i] == off[j]:
                    continue
                _, _, first, h, s, e = lines_of(data, off, i, j)
                line = line_hashes(h, first)
                if not len(line):
                    continue
                new = np.unique(line, return_index=True)[1]
                new = np.sort(new[[x not in seen for x in line[new].tolist()]])
                long, line = lengths(first, s, e)[new], line[new]
                if len(seen) < 500_000:  # lines this task has sent already
                    seen.update(line.tolist())
                if not len(new):
                    continue
                count = np.diff(first)
                use = np.zeros(len(count), bool)
                use[new] = True
                h, first = h[np.repeat(use, count)], np.append(0, np.cumsum(count[new]))
                blocks, (low, high) = simhash(h, first), bands(long)
                for at in (low, high):
                    use = np.ones(len(line), bool) if at is low else high > low
                    if not use.any():
                        continue
                    key = mix(blocks[use].astype(np.uint64) ^ mix(at[use].astype(np.uint64)[:, None] * np.uint64(KEYS) + np.arange(KEYS, dtype=np.uint64), 21), 22)
                    held.append((key.ravel(), np.repeat(line[use] & np.uint64((1 << LINE) - 1), KEYS)))
                    size += key.size
                if size >= PACK:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    return docs.select("text").mapInArrow(run, "bucket int, keys binary")


def repeated(batches):
    """Batches (key, line, size) sorted by key, of the keys that several lines
    have, from rows (bucket, keys) sorted by bucket."""
    for bucket, (held,) in runs_of(batches, 1):
        rows = np.frombuffer(b"".join(held), _PACKED)
        key = rows["key"].copy()
        order = np.argsort(key)
        key = key[order]
        same = np.concatenate(([False], key[1:] == key[:-1], [False]))
        rows = rows[order[same[1:] | same[:-1]]]
        if not len(rows):
            continue
        key, line = rows["key"].astype(np.int64) | bucket << 32, rows["low"].astype(np.int64) | rows["high"].astype(np.int64) << 32
        order = np.lexsort((line, key))
        key, line = key[order], line[order]
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (line[1:] != line[:-1])))  # tasks may have sent the same line
        key, line = key[new], line[new]
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(line), pa.array(np.ones(len(key), np.int32))], names=["key", "h", "n"])


def marks(met: DataFrame) -> np.ndarray:
    """Bitmap of the lines in ``met``, by the first bits of their hashes."""
    lines = met.select(F.explode(F.when(F.col("kind") == 0, F.array("u", "v")).otherwise(F.array("v"))).alias("line")).distinct()
    bits = min(MARKS, max(15, math.ceil(math.log2(32 * (lines.count() + 1)))))
    place = lines.select(F.shiftright("line", LINE - bits).alias("place"))
    out = np.zeros((1 << (bits - 15), 1 << 12), np.uint8)
    for r in place.groupBy(F.shiftright("place", 15).alias("n")).agg(F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << 15) - 1)).alias("map")).toLocalIterator():
        out[r.n] = np.frombuffer(r.map, np.uint8)
    return out.ravel()


def occurrences(docs: DataFrame, marked: np.ndarray) -> DataFrame:
    """``(k, doc_id, line_no, h, line)`` of every line with words of
    ``docs(k, doc_id, text)``; ``line``, normalised, where a line is marked and
    first met by its task. Written to the shared folder."""
    spark, down = docs.sparkSession, LINE - int(math.log2(8 * len(marked)))
    sent = spark.sparkContext.broadcast(marked)

    def run(batches):
        mark, seen = sent.value, set()
        for b in batches:
            data, off = text_buffers(b.column(2))
            for i, j in segments(off):
                if off[i] == off[j]:
                    continue
                row, number, first, h, s, e = lines_of(data, off, i, j)
                if not len(row):
                    continue
                line = line_hashes(h, first)
                place = ((line & np.uint64((1 << LINE) - 1)) >> np.uint64(down)).astype(np.int64)
                plain, lo, texts = _PLAIN[data[off[i]:off[j]]].tobytes(), int(off[i]), [None] * len(row)
                for n in np.flatnonzero(mark[place >> 3] >> (place & 7) & 1).tolist():
                    if (own := int(line[n])) not in seen:
                        texts[n] = b" ".join(plain[s[first[n]] - lo:e[first[n + 1] - 1] - lo].split())
                        if len(seen) < 500_000:
                            seen.add(own)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(number.astype(np.int64)), pa.array(line.view(np.int64)), pa.array(texts, pa.binary())],
                                                 names=["k", "doc_id", "line_no", "h", "line"])

    schema = "k long, doc_id long, line_no long, h long, line binary"
    folder = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    docs.select("k", "doc_id", "text").mapInArrow(run, schema).write.parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _asked(h, lines, u, v):
    """Ends (indexes of lines) of the pairs (u, v) of short hashes; hashes
    that several lines share stand for each of them. ``h`` is sorted by them."""
    short = h & ((1 << LINE) - 1)
    first, last = ([np.searchsorted(short, x, side=side) for x in (u, v)] for side in ("left", "right"))
    count = [b - a for a, b in zip(first, last)]
    times = count[0] * count[1]
    place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    width = np.repeat(count[1], times)
    return np.repeat(first[0], times) + place // np.maximum(width, 1), np.repeat(first[1], times) + place % np.maximum(width, 1)


def linked(h, lines, u, v):
    """Links that connect the similar ones of the pairs (u, v) of short hashes
    among lines ``lines`` of hashes ``h``. Ends that are connected already are
    compared no further."""
    order = np.lexsort((h, h & ((1 << LINE) - 1)))
    h = h[order]
    new = np.concatenate(([True], h[1:] != h[:-1])) if len(h) else np.zeros(0, bool)
    h, lines = h[new], lines.take(pa.array(order[new]))
    i, j = _asked(h, lines, u, v)
    root, out = np.arange(len(h)), []

    def settle():
        while (root[root] != root).any():
            root[:] = root[root]

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    # of every line the first pair, then of every two groups the first pair, then all others
    key = j
    for turn in range(3):
        settle()
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
        if not len(i):
            break
        key = j if turn == 0 else np.minimum(root[i], root[j]) * len(h) + np.maximum(root[i], root[j]) if turn == 1 else np.arange(len(i))
        at = np.unique(key, return_index=True)[1]
        a, b = i[at], j[at]
        yes = alike(lines.take(pa.array(a)), lines.take(pa.array(b)))
        for x, y in zip(a[yes].tolist(), b[yes].tolist()):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((h[x], h[y]))
        i, j = np.delete(i, at), np.delete(j, at)
    return np.array(out, np.int64).reshape(-1, 2)


def search_pairs(batches, most: int = 40_000):
    """Links among the pairs of groups in batches (group, u, v, line) sorted
    by group: rows with a line give it and, as u, its hash, others a pair."""
    held, size = [], 0

    def links(rows):
        line = rows.column(3).is_valid().to_numpy(zero_copy_only=False)
        h, u, v = (rows.column(k).filter(pa.array(use)).to_numpy() for k, use in ((1, line), (1, ~line), (2, ~line)))
        got = linked(h, rows.column(3).filter(pa.array(line)), u, v)
        return pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["u", "v"])

    def together():
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        return rows[0] if rows else None

    for b in batches:
        held.append(b)
        size += len(b)
        if size < most:
            continue
        rows = together()
        group = rows.column(0).to_numpy()
        at = int(np.searchsorted(group, group[-1]))  # the last group may go on
        if at:
            yield links(rows.slice(0, at))
        held, size = [rows.slice(at)], len(rows) - at
    if size:
        yield links(together())


def candidates(docs: DataFrame) -> DataFrame:
    """``(kind, u, v)``: pairs of lines that meet under a key, and lists."""
    met = block_keys(docs).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: pairs_of_runs(repeated(it), MOST, 0), MET)
    return cut(met.select("kind", "u", "v").distinct())


def groups(met: DataFrame, lines: DataFrame) -> DataFrame:
    """``(id, component)`` of line hashes that are linked to another."""
    texts = (lines.where("line is not null").select(F.col("h").bitwiseAND((1 << LINE) - 1).alias("id"), "h", "line")
             .repartition("id").dropDuplicates(["id", "h"]))
    asked = grouped_pairs(met.where("kind = 0").select("u", "v"))
    ends = asked.select("grp", F.explode(F.array("u", "v")).alias("id")).distinct().join(texts, "id")
    pairs = (asked.select("grp", "u", "v", F.lit(None).cast("binary").alias("line")).union(ends.select("grp", "h", F.lit(0).cast("long"), "line"))
             .repartition("grp").sortWithinPartitions("grp"))
    members = squares(list_groups(met.where("kind = 1").select(F.col("u").alias("list"), F.col("v").alias("id"))).withColumn("weight", F.lit(1)), CELL)
    sets = members.join(texts, "id").select("cell", F.col("h").alias("id"), "side", "line")
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # cells are more work than their bytes tell
    sets = sets.repartition(parts, "cell").sortWithinPartitions("cell", "id")
    return components(pairs.mapInArrow(search_pairs, "u long, v long").union(sets.mapInArrow(search_cells, "u long, v long")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.xxhash64(id_col, text_col).alias("k"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(k, gone)``: for each document key the numbers of lines that go."""
    d = keyed(docs, id_col, text_col)
    met = candidates(d)
    lines = occurrences(d, marks(met))
    found = groups(met, lines).withColumnRenamed("id", "h")
    # documents of equal id and text count once: a line's number there is the same
    alone = lines.groupBy("h").agg(F.min(F.struct("doc_id", "k", "line_no")).alias("first"), F.count("*").alias("n"))
    named = cut(alone.join(found, "h", "left").where("component is not null or n > 1").select("h", "component", "first"))
    linked = named.where("component is not null")
    first = linked.groupBy("component").agg(F.min("first").alias("first"))
    stay = linked.select("h", "component").join(first, "component").select("h", "first").union(named.where("component is null").select("h", "first"))
    gone = lines.select("h", "k", "line_no").join(stay, "h").where("k <> first.k or line_no <> first.line_no").select("k", "line_no")
    return gone.groupBy("k").agg(F.collect_set("line_no").alias("gone"))


def dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, the text without its repeated lines, with
    ``_n_lines`` (lines that have words) and ``_n_gone``."""
    out = removals(docs, id_col, text_col)
    key = F.xxhash64(id_col, text_col)
    cols = [F.col(c) for c in docs.columns if c != text_col]

    def kept(lines):
        left = F.array_except(F.sequence(F.lit(0).cast("long"), F.size(lines).cast("long") - 1), F.col("_gone"))
        return F.array_join(F.transform(left, lambda i: F.get(lines, i.cast("int"))), "\n")

    # a function's argument, so that a text is split once and not for each of its lines
    short = F.get(F.transform(F.array(F.split(F.col(text_col), "\n", -1)), kept), 0)
    joined = docs.withColumn("_k", key).join(out.select(F.col("k").alias("_k"), F.col("gone").alias("_gone")), "_k", "left")
    return joined.select(*cols, F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(short).alias(text_col),
                         F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F][^\n]*")), F.lit(0)).alias("_n_lines"),
                         F.coalesce(F.size("_gone"), F.lit(0)).alias("_n_gone"))
