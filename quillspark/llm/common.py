"""Shared helpers: checkpoints, word hashes of Arrow text, components."""

from __future__ import annotations

import math
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of the contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(col):
    """A-Z lowered, every other character as it is."""
    return F.translate(col, ASCII_UPPER, ASCII_UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where it is unset, a
    scratch folder serves a local session; a cluster must name one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written reliably to the shared folder, its lineage cut."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


# ---------------------------------------------------------------- word hashes
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that one numpy step takes; longer texts are cut between words.
SEGMENT = 1 << 20
_powers: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _pow(n: int):
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, _INVERSE)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalising scrambler of 64-bit values (wraps modulo 2**64)."""
    h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gaps(extra=()) -> np.ndarray:
    """Bytes that separate words: ASCII white space and ``extra``."""
    out = _SPACE.copy()
    out[list(extra)] = True
    return out


#: ASCII control, space and punctuation bytes: all but digits and letters.
NOT_ALNUM = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of an Arrow string column (null: empty)."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    arr = arr.cast(pa.large_binary()).fill_null(b"") if arr.null_count or not pa.types.is_large_binary(arr.type) else arr
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(arr.buffers()[2], np.uint8) if len(arr) and arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, off


def word_spans(data: np.ndarray, off: np.ndarray, separator=_SPACE):
    """Starts and ends of words in ``data[off[0]:off[-1]]``; a row's end ends a word."""
    lo, hi = int(off[0]), int(off[-1])
    inside = ~separator[data[lo:hi]]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = off[(off > lo) & (off < hi)] - lo
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~(inside[1:] & ~first[1:])
    return np.flatnonzero(first) + lo, np.flatnonzero(last) + lo + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table=_LOWER) -> np.ndarray:
    """64-bit hash of each span after the byte table (A-Z lowered), independent
    of place. Spans come in order; long stretches are taken in steps."""
    out, i = np.zeros(len(starts), np.uint64), 0
    while i < len(starts):
        lo = int(starts[i])
        j = len(starts) if ends[-1] - lo <= 2 * SEGMENT else max(i + 1, int(np.searchsorted(ends, lo + 2 * SEGMENT, side="right")))
        power, inverse = _pow(int(ends[j - 1]) - lo + 1)
        run = np.zeros(len(power), np.uint64)
        np.cumsum(table[data[lo:int(ends[j - 1])]] * power[:-1], out=run[1:], dtype=np.uint64)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((run[e] - run[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def segments(off: np.ndarray, most: int = SEGMENT):
    """Row ranges of at most ``most`` bytes (a longer row stands alone)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, j
        i = j


def row_words(data: np.ndarray, off: np.ndarray, i: int, j: int, separator=_SPACE, table=_LOWER):
    """Of rows i..j: word hashes in order, per row the index of its first word
    (with a closing entry), and the words' starts and ends."""
    o = off[i:j + 1]
    s, e = word_spans(data, o, separator)
    return word_hashes(data, s, e, table), np.searchsorted(s, o), s, e


# ---------------------------------------------------------------- components
def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``(id, component)`` for all ends of ``edges(u, v)``: the smallest id reachable.

    Alternating large-star and small-star steps: each replaces the edges of a
    node by edges to its smallest neighbour, so a group of any shape becomes a
    star around its smallest member after a number of rounds that grows with
    the logarithm of its diameter. Minima are aggregated before the shuffle;
    the join that gives them back to the edges of a hub can be split by
    adaptive execution. Rounds are checkpointed; only three numbers that tell
    whether anything changed come to the driver.
    """
    e = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    state = None
    for _ in range(rounds):
        # large star: every larger neighbour of a node, to the node's minimum
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: a node and its smaller neighbours, to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def small_side(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """Marks the narrow, materialised side of a join for broadcast if a count
    shows it to be small; beyond that the join shuffles."""
    return F.broadcast(df) if df.count() <= rows else df


def marked(df: DataFrame, keys: DataFrame, key: str, rows: int = 200_000) -> DataFrame:
    """``df`` before it is shuffled for a join with the materialised ``keys``:
    rows whose key a bitmap of ``keys`` marks, one in 16 of the others among
    them. As it is where ``small_side`` needs no shuffle."""
    n = keys.count()
    if n <= rows:
        return df
    bits = min(28, math.ceil(math.log2(16 * n)))
    place = F.shiftrightunsigned(F.xxhash64(key), 64 - bits)
    block, bit, held = (free(df.columns, x) for x in ("_block", "_bit", "_map"))
    maps = (keys.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias(block))
            .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND((1 << 15) - 1)).alias(held)))
    at = df.withColumns({block: F.shiftright(place, 15), bit: place.bitwiseAND((1 << 15) - 1)}).join(F.broadcast(maps), block)
    return at.where(f"bit_get(cast(conv(hex(substring({held}, cast({bit} div 8 as int) + 1, 1)), 16, 10) as long), cast({bit} % 8 as int)) = 1").select(*df.columns)


def free(columns, name: str) -> str:
    """``name``, with underscores put before it until no column has it (names
    are compared as Spark does, without regard to case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


_shipped: set = set()


def ship(spark: SparkSession) -> SparkSession:
    """Gives the executors' Python this package, once per application."""
    import shutil
    from pathlib import Path

    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="llm-code-")
        sc.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(sc.applicationId)
    return spark
