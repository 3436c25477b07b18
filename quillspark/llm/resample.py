"""Target-distribution importance resampling (operator 11).

Documents are drawn towards a target collection by hashed word n-grams. One
256-byte table lower-cases A-Z and blanks every separator of the UTF-8 bytes,
``bytes.split`` gives the words, and ``zlib.crc32`` of a blank and the next
word, seeded by the hash so far, turns the hash of an n-gram into that of the
next longer one. Tasks reduce their features with Counters to at most
``buckets`` sums, which Spark adds up; a bucket's gain is the logarithm of its
smoothed share in the targets over that in the documents. A document's weight
is the sum of its features' gains; with Gumbel noise from a hash of its id, the
highest scores are a draw without replacement in proportion to the weights.

The corpus is read twice, once for the counts and once for the weights. Only
bucket counts (``buckets`` rows) come to the driver. The narrow scored rows are
range-partitioned by score, so ranks need neither a global window nor a limit.

Defined cases: a null, blank or wordless text has no features, weight 0 and, as
it has too few words, no rank; texts of any length are split piece by piece; a
null id takes its noise from the empty id; ties go to the smaller id (null
first), then to fewer features and less weight, and of equal rows each has a
rank of its own; an empty document table gives no rows, an empty target table
leaves gains that only prefer rarer buckets.
"""

from __future__ import annotations

from collections import Counter
from hashlib import sha256
from math import floor, log
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import NOT_ALNUM, SEGMENT, cut, free, ship, text_buffers
from quillspark.operators.ordered import sorted_row_number

NGRAMS, BUCKETS, SEED, MIN_WORDS, PERCENT = 2, 10_000, 2024, 20, 10
#: Words whose gain a task remembers; others are hashed again.
REMEMBERED = 200_000
_FOLD = bytes(32 if b in NOT_ALNUM else b + 32 if 65 <= b <= 90 else b for b in range(256))


def pieces(text: bytes, most: int = SEGMENT):
    """Lists of the words of a text, about ``most`` bytes at a time."""
    text, at = text.translate(_FOLD), 0
    while at < len(text):
        end = text.find(b" ", at + most)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def longer(text: bytes, ngrams: int):
    """Lists of the hashes of all runs of 2 to ``ngrams`` words. A run's hash
    grows from that of the run without its last word, over pieces too."""
    ends = [None] * ngrams  # hash of the run of k + 1 words that ends the piece before
    for words in pieces(text):
        level = list(map(crc32, words))
        for k in range(1, ngrams):
            seeds = [ends[k - 1], *level[:-1]] if level else []
            if level:
                ends[k - 1] = level[-1]
            level = [None if s is None else crc32(b" " + w, s) for w, s in zip(words, seeds)]
            yield [h for h in level if h is not None]


def rows(batch, column: int):
    data, off = text_buffers(batch.column(column))
    for i in range(batch.num_rows):
        yield data[off[i]:off[i + 1]].tobytes()


def bucket_counts(texts: DataFrame, text_col: str = "text", *, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, n)`` of all features of all texts."""

    def run(batches):
        total = [0] * buckets
        for batch in batches:
            for text in rows(batch, 0):
                for words in pieces(text):
                    for w, n in Counter(words).items():
                        total[crc32(w) % buckets] += n
                if ngrams > 1:
                    for hashes in longer(text, ngrams):
                        for h, n in Counter(hashes).items():
                            total[h % buckets] += n
        found = [(b, n) for b, n in enumerate(total) if n]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["bucket", "n"])

    ship(texts.sparkSession)
    return texts.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, targets: DataFrame, *, text_col: str = "text", target_col: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS) -> list[int]:
    """Per bucket, 1000 times the logarithm of its share in the targets over
    its share in the documents, both smoothed by one, rounded down."""
    counted = [{r["bucket"]: r["n"] for r in bucket_counts(d, c, ngrams=ngrams, buckets=buckets).collect()} for d, c in ((docs, text_col), (targets, target_col))]
    s, t = counted
    every, wanted = (float(sum(c.values()) + buckets) for c in (s, t))
    return [floor(1000 * log((t.get(b, 0) + 1) * every / ((s.get(b, 0) + 1) * wanted))) for b in range(buckets)]


class _Gains(dict):
    """Gain of a word, remembered."""

    def __init__(self, table):
        super().__init__()
        self.table = table

    def __missing__(self, word):
        g = self.table[crc32(word) % len(self.table)]
        if len(self) < REMEMBERED:
            self[word] = g
        return g


def noise(seed, doc_id) -> int:
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return floor(-1000 * log(-log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, table: list[int], *, id_col: str = "doc_id", text_col: str = "text", ngrams: int = NGRAMS, seed=SEED,
          names: tuple[str, str, str, str] = ("n_words", "n_features", "weight", "score")) -> DataFrame:
    """``docs`` with four long columns: words, features, weight and score."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    columns = [*docs.columns, *names]
    i_col, t_col = columns.index(id_col), columns.index(text_col)

    def run(batches):
        known = _Gains(table)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(i_col).to_pylist(), rows(batch, t_col)):
                n = weight = more = 0
                for words in pieces(text):
                    n += len(words)
                    weight += sum(map(known.__getitem__, words))
                if ngrams > 1:
                    for hashes in longer(text, ngrams):
                        more += len(hashes)
                        weight += sum(table[h % len(table)] for h in hashes)
                out.append((n, n + more, weight, weight + noise(seed, doc_id)))
            new = [pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=columns)

    ship(docs.sparkSession)
    return docs.mapInArrow(run, fields + "".join(f", `{n}` long" for n in names))


def rank(docs: DataFrame, table: list[int], *, id_col: str = "doc_id", text_col: str = "text", ngrams: int = NGRAMS, seed=SEED,
         min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document, given the ``gains``: id, n_words, n_features, weight,
    score and, if drawn, its rank (1, 2, ... from the highest score down)."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scored = cut(weigh(d, table, id_col="id", ngrams=ngrams, seed=seed).drop("text"))
    fit = scored.where(F.col("n_words") >= min_words)
    drawn = fit.count() * percent // 100
    # the row number in the written table tells equal rows apart
    keyed = fit.select("*", (-F.col("score")).alias("order"), F.monotonically_increasing_id().alias("row"))
    ranked = sorted_row_number(keyed, [], ["order", "id", "n_features", "weight", "row"], "rank")
    out = ranked.select(*scored.columns, F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank"))
    rest = scored.where(F.col("n_words") < min_words).select("*", F.lit(None).cast("long").alias("rank"))
    return out.unionAll(rest).withColumnRenamed("id", id_col)


def resample(docs: DataFrame, targets: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", ngrams: int = NGRAMS,
             buckets: int = BUCKETS, seed=SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """The drawn documents, all their columns. Rows that repeat an id with the
    same features and weight come together if one of them is drawn."""
    table = gains(docs, targets, text_col=text_col, target_col=target_col, ngrams=ngrams, buckets=buckets)
    wanted = rank(docs, table, id_col=id_col, text_col=text_col, ngrams=ngrams, seed=seed, min_words=min_words, percent=percent).where("rank is not null")
    mine = tuple(free(docs.columns, n) for n in ("n_words", "n_features", "weight", "score"))
    got = weigh(docs, table, id_col=id_col, text_col=text_col, ngrams=ngrams, seed=seed, names=mine)
    keys = wanted.select(F.col(id_col).alias("k0"), F.col("n_features").alias("k1"), F.col("weight").alias("k2")).distinct()
    same = got[id_col].eqNullSafe(keys["k0"]) & (got[mine[1]] == keys["k1"]) & (got[mine[2]] == keys["k2"])
    return got.join(keys, same, "left_semi").select(*docs.columns)
