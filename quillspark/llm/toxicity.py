"""Toxicity by weak supervision (operator 6).

Voters are words of a lexicon and patterns (a word, or a word's first four or
five bytes) that in labelled training rows come up in toxic documents and
hardly elsewhere, as many of them as it takes to reach every toxic row twice. A
generative label model looks at the voters' votes alone: by
EM it estimates how often each votes on toxic and on other documents, and how
far voters agree beyond that; voters that move together share their weight. Its
posteriors are the targets of a linear classifier, and that classifier scores
every document.

Fitting takes at most ``FIT`` labelled rows, chosen by hash among those that
are not held out; everything the driver sees is bounded by ``FIT`` and
``VOTERS``. Scoring maps whole texts in Arrow batches, without a shuffle.
Scores depend on texts alone.

Defined cases: null, empty and blank texts get the score of no vote; labels
with nulls and unlabelled documents take no part in fitting; without labelled
rows of both kinds the lexicon decides; rows that repeat an id are scored each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import _LOWER, NOT_ALNUM, cut, gaps, segments, text_buffers, word_hashes, word_spans

#: Lexicon voters, in any language of the corpus.
LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting", "idiota", "imbécil", "idiote", "dummkopf")
FIT, VOTERS, FOLDS = 20_000, 400, 5
#: A pattern votes if it is in so many toxic rows and so pure.
LEAST_ROWS, LEAST_SHARE, PURITY = 3, 0.005, 0.95
PREFIXES = (4, 5)
_GAP = gaps(NOT_ALNUM)


def held_out(id_col):
    return F.crc32(F.encode(id_col.cast("string"), "UTF-8")) % FOLDS == 0


def patterns(data, off, i, j):
    """(row, hash) of every word and word beginning of rows i..j."""
    s, e = word_spans(data, off[i:j + 1], _GAP)
    row = np.searchsorted(off, s, side="right") - 1
    rows, out = [row], [word_hashes(data, s, e)]
    for k in PREFIXES:
        long = e - s > k
        rows.append(row[long])
        out.append(word_hashes(data, s[long], s[long] + k, _LOWER) ^ np.uint64(k))
    return np.concatenate(rows), np.concatenate(out)


def lexicon_hashes(lexicon=LEXICON) -> np.ndarray:
    data, off = text_buffers(pa.array([w.encode() for w in lexicon], pa.binary()))
    return word_hashes(data, off[:-1], off[1:])


def votes(column, voters: np.ndarray):
    """(row, voter index, times) of the voters found in each text; ``voters`` is sorted."""
    data, off = text_buffers(column)
    sieve = np.zeros(1 << 16, bool)
    sieve[(voters & np.uint64(0xFFFF)).astype(np.int64)] = True
    found = [np.zeros((0, 2), np.int64)]
    for i, j in segments(off):
        if off[i] == off[j]:
            continue
        row, h = patterns(data, off, i, j)
        may = sieve[(h & np.uint64(0xFFFF)).astype(np.int64)]
        row, h = row[may], h[may]
        at = np.minimum(np.searchsorted(voters, h), len(voters) - 1)
        ok = voters[at] == h
        found.append(np.stack([row[ok], at[ok]], axis=1))
    pair, times = np.unique(np.concatenate(found), axis=0, return_counts=True)
    return pair[:, 0], pair[:, 1], times


def mine(labelled: DataFrame, n_toxic: int, most: int) -> np.ndarray:
    """Hashes of the patterns that mark toxic rows of ``labelled(text, toxic)``."""
    def count(batches):
        for b in batches:
            data, off = text_buffers(b.column(0))
            toxic = np.asarray(b.column(1).cast(pa.int64()))
            for i, j in segments(off):
                if off[i] == off[j]:
                    continue
                row, h = patterns(data, off, i, j)
                pair = np.unique(np.stack([h, row.astype(np.uint64)], axis=1), axis=0)
                h, at = np.unique(pair[:, 0], return_inverse=True)
                bad = np.bincount(at, weights=toxic[pair[:, 1].astype(np.int64)], minlength=len(h)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(h)).astype(np.int64))], names=["h", "bad", "n"])

    got = (labelled.select("text", "toxic").mapInArrow(count, "h long, bad long, n long").groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
           .where((F.col("bad") >= max(LEAST_ROWS, LEAST_SHARE * n_toxic)) & (F.col("bad") >= PURITY * F.col("n")))
           .orderBy(F.desc("bad"), "h").limit(most).select("h").toArrow())  # at most VOTERS
    return np.array(got.column(0), dtype=np.int64).view(np.uint64)


def choose(v: np.ndarray, toxic: np.ndarray, least: float, cover: int = 2) -> np.ndarray:
    """Voters that together reach the toxic rows ``cover`` times: the one that
    adds most comes next, until none adds ``least`` rows."""
    need, hits, out = np.full(int(toxic.sum()), cover), v[toxic].copy(), []
    while len(out) < v.shape[1]:
        gain = ((need > 0) @ hits)
        best = int(gain.argmax())
        if gain[best] < max(least, 1):
            break
        out.append(best)
        need = need - hits[:, best]
        hits[:, best] = 0
    return np.array(sorted(out), int)


def kinds_of(v: np.ndarray, least: float = 0.1) -> np.ndarray:
    """Group of each voter: voters that come up together are of one kind."""
    corr = np.corrcoef(v + 1e-12 * np.arange(len(v))[:, None] / max(1, len(v)), rowvar=False).reshape(v.shape[1], -1)
    kind = np.arange(v.shape[1])
    for i, j in np.argwhere(np.triu(corr > least, 1)):
        kind[kind == kind[j]] = kind[i]
    return np.unique(kind, return_inverse=True)[1]


def label_model(v: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of each row of the 0/1 vote matrix, and each voter's share of
    weight after its correlations.

    Toxic rows are of several kinds (insults of one language go together), so
    the model is a mixture of one clean class and a toxic class for each kind
    of voter. EM finds how often each voter votes in each class. Halfway,
    agreement that the classes don't explain divides the voters' weight.
    """
    n, m = v.shape
    kind = kinds_of(v)
    k = kind.max() + 1
    some = v.any(axis=1)
    q = np.full((n, k + 1), 0.02 / k)  # class 0 is the clean one
    q[np.arange(n), 1 + np.argmax(np.stack([v[:, kind == c].sum(axis=1) for c in range(k)], axis=1), axis=1)] += np.where(some, 0.88, 0)
    q[:, 0] = 1 - q[:, 1:].sum(axis=1)
    share = np.ones(m)
    for step in range(rounds):
        size = q.sum(axis=0) + 1
        rate = (q.T @ v + 0.05) / (size[:, None] + 0.1)
        odds = np.log(size / size.sum()) + (v * share) @ np.log(rate).T + ((1 - v) * share) @ np.log(1 - rate).T
        q = np.exp(odds - odds.max(axis=1, keepdims=True))
        q /= q.sum(axis=1, keepdims=True)
        if step == rounds // 2:
            rest = v - q @ rate
            cov = rest.T @ rest
            scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = np.maximum(cov / np.outer(scale, scale), 0)
            np.fill_diagonal(corr, 0)
            share = 1 / (1 + np.where(corr > 0.2, corr, 0).sum(axis=1))
    return 1 - q[:, 0], share


def fit_linear(x: np.ndarray, p: np.ndarray, penalty: float = 0.5, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft targets by Newton steps; the last weight is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(x.shape[1]), np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(ridge), x.T @ (p - q) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def matrix(n: int, row, voter, times, m: int) -> np.ndarray:
    """Votes, and the logarithm of all hits, of n rows."""
    x = np.zeros((n, m + 1))
    x[row, voter] = 1
    np.add.at(x[:, m], row, times)
    x[:, m] = np.log1p(x[:, m])
    return x


def fit(docs: DataFrame, labels: DataFrame, *, most: int = FIT, voters: int = VOTERS):
    """Voter hashes and weights learnt from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``."""
    use = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    use = cut(use.dropDuplicates(["doc_id"]).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))  # bounded by ``most``
    rows = cut(docs.join(F.broadcast(use), "doc_id").select("text", "toxic"))
    words = np.unique(lexicon_hashes())
    n_toxic = use.where("toxic = 1").count()
    if n_toxic:
        words = np.unique(np.concatenate([words, mine(rows, n_toxic, voters)]))

    def vote(batches):
        for b in batches:
            row, voter, times = votes(b.column(0), words)
            at = np.searchsorted(row, np.arange(b.num_rows + 1))
            cut_up = lambda a: pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(a.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([cut_up(voter), cut_up(times), b.column(1)], names=["voter", "times", "toxic"])

    got = rows.mapInArrow(vote, "voter array<int>, times array<int>, toxic int").limit(2 * most).toArrow()  # one row per labelled row
    voter, times, toxic = got.column("voter").to_pylist(), got.column("times").to_pylist(), np.array(got.column("toxic")) == 1
    if not any(voter):
        return words, np.concatenate([np.full(len(words), 4.0), [0.0, -2.0]])
    row = np.repeat(np.arange(len(voter)), [len(x) for x in voter])
    x = matrix(len(voter), row, np.array([y for z in voter for y in z], int), np.array([y for z in times for y in z], float), len(words))
    if toxic.any():
        used = choose(x[:, :-1], toxic, LEAST_SHARE / 2 * n_toxic)
        words, x = words[used], matrix(len(voter), *_only(row, voter, times, used), len(used))
    p, share = label_model(x[:, :-1])
    x[:, :-1] *= share  # correlated voters share their weight in the classifier too
    w = fit_linear(x, p)
    w[:-2] *= share
    return words, w


def _only(row, voter, times, used):
    """Votes of the chosen voters, renumbered."""
    voter, times = np.array([y for z in voter for y in z], int), np.array([y for z in times for y in z], float)
    ok = np.isin(voter, used)
    return row[ok], np.searchsorted(used, voter[ok]), times[ok]


def score(docs: DataFrame, model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every document."""
    words, w = model
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = d.schema[0].dataType.simpleString()

    def run(batches):
        for b in batches:
            n = b.num_rows
            row, voter, times = votes(b.column(1), words)
            odds = np.bincount(row, weights=w[voter], minlength=n) + w[-2] * np.log1p(np.bincount(row, weights=times, minlength=n)) + w[-1]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(odds, -30, 30))))], names=["doc_id", "score"])

    s = d.mapInArrow(run, f"doc_id {kind}, score double")
    return s.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the model doesn't call toxic."""
    words, w = model
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            row, voter, times = votes(b.column(at), words)
            odds = np.bincount(row, weights=w[voter], minlength=b.num_rows) + w[-2] * np.log1p(np.bincount(row, weights=times, minlength=b.num_rows)) + w[-1]
            yield b.filter(pa.array(odds < 0))

    return docs.mapInArrow(run, docs.schema)
