"""Licence scan with a positional rare-token index (operator 10, native).

The words of a few licence notices form the templates. Their document
frequencies are counted over the whole corpus; a template's postings are the
words of highest IDF of its mandatory key phrases, with their positions. In a
file that holds those words, the places of each word, less its position in the
template, are intersected: what remains are the offsets at which the template
may stand. An offset counts when the template's key phrases stand there and
the share of its words found in place reaches ``MIN_SHARE``. As the key phrases
must stand in place anyway, no alignment is lost by asking for their words
first; words outside of them may differ, whatever their IDF. A template
without a key phrase is looked for from its rarest places, one more than may
differ.

Scale: one pass counts a few hundred template words (bounded by the templates,
and only these counts reach the driver), one pass scans; no text is shuffled,
and texts without a template's posted words are only searched for them.

Defined cases: a null or empty text has no words, places or labels and score
0; repeated rows are scanned each; of words of equal frequency the
alphabetically first is the rarer; a base phrase without an aligned notice
scores ``PHRASE_SCORE``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import lower_ascii

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Fixed phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Notices: label, words, key phrases that must stand in place. Fixed values.
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge",)),
    ("apache", "licensed under the apache license version 2 0", ("apache license",)),
    ("gpl", "licensed under the gnu general public license version 3", ("gnu general public license",)),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license", ("gnu general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ("source and binary forms",)),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("reserved", "all rights reserved", ("rights reserved",)),
)
RARE, MIN_SHARE, PHRASE_SCORE = 3, 0.8, 0.5


def document_frequencies(docs: DataFrame, text: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows each word of the bounded vocabulary stands."""
    words = F.split(lower_ascii(F.col(text)), GAP)
    found = docs.select(F.explode(F.array_intersect(words, F.array(*[F.lit(v) for v in vocabulary]))).alias("word"))
    return {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}  # one row per template word


def _keys(text: str, keys) -> list[tuple[int, list[str]]]:
    """Each key phrase's words and its first position in the template."""
    words, out = text.split(), []
    for key in keys:
        k = key.split()
        out.append((next(i for i in range(len(words)) if words[i:i + len(k)] == k), k))
    return out


def postings(templates, frequency: dict[str, int], rare: int = RARE) -> list[list[tuple[str, int]]]:
    """Per template the ``rare`` words of highest IDF among those of its key
    phrases, and their positions: words that stand wherever it stands."""
    out = []
    for _, text, keys in templates:
        must = {(w, at + k) for at, key in _keys(text, keys) for k, w in enumerate(key)}
        out.append(sorted(must, key=lambda a: (frequency.get(a[0], 0), *a))[:rare])
    return out


def proposals(text: str, frequency: dict[str, int], min_share: float) -> list[tuple[str, int]]:
    """The rarest places of a template, so many that the share of words in
    place can't reach ``min_share`` without one of them."""
    words = text.split()
    places = sorted(((w, k) for k, w in enumerate(words)), key=lambda a: (frequency.get(a[0], 0), *a))
    may_differ = max((d for d in range(len(words)) if (len(words) - d) / len(words) >= min_share), default=0)
    return places[:may_differ + 1]


def _at(words, i, phrase: list[str]):
    """Whether the phrase's words stand from place ``i`` on."""
    ok = F.lit(True)
    for k, p in enumerate(phrase):
        ok = ok & F.coalesce(F.get(words, i + k) == p, F.lit(False))
    return ok


def _places(words, word: str):
    return F.array_compact(F.transform(words, lambda x, i: F.when(x == word, i)))


def _before(places, n: int):
    return F.transform(places, lambda i: i - n)


def _offsets(words, anchors: list[tuple[str, int]]):
    """Where the template may begin: its posted words stand in their places."""
    out = None
    for word, pos in anchors:
        here = _before(_places(words, word), pos)
        out = here if out is None else F.array_intersect(out, here)
    return out


def _phrase_starts(words, phrase: list[str]):
    found = _before(_places(words, phrase[-1]), len(phrase) - 1)
    return F.filter(found, lambda i: _at(words, i, phrase))


def _share(words, template: list[str], keys: list[tuple[int, list[str]]]):
    """Share of the template's words in place at an offset, 0 without its keys."""
    def at(o):
        ok, n = F.lit(True), F.lit(0)
        for pos, key in keys:
            ok = ok & _at(words, o + pos, key)
        for k, word in enumerate(template):
            n = n + F.when(F.get(words, o + k) == word, 1).otherwise(0)
        return F.when(ok, n / F.lit(float(len(template)))).otherwise(0.0)
    return at


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, base=BASE,
         rare: int = RARE, min_share: float = MIN_SHARE) -> DataFrame:
    """Counts, places, labels and score of every document."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    vocabulary = sorted({w for _, t, _ in templates for w in t.split()})
    frequency = document_frequencies(d, "text", vocabulary)
    index = postings(templates, frequency, rare)
    # per template, sets of words of which one must be there whole
    sets = [[a] if a else [[x] for x in proposals(t, frequency, min_share)] for a, (_, t, _) in zip(index, templates)]
    d = d.select("doc_id", lower_ascii(F.coalesce("text", F.lit(""))).alias("low"))

    def holds(words):
        ok = F.lit(True)
        for w in words:
            ok = ok & F.contains("low", F.lit(w))
        return ok

    may = F.lit(False)
    for phrase in [p.split() for p, _ in base] + [[w for w, _ in a] for s in sets for a in s]:
        may = may | holds(phrase)
    # only texts that may hold something are split into words
    d = d.select("doc_id", F.regexp_count("low", F.lit(WORDS)).cast("long").alias("n_words"),
                 F.when(may, F.split(F.trim(F.regexp_replace("low", GAP, " ")), " ")).alias("w"))
    starts = []
    for phrase, _ in base:
        p = phrase.split()
        starts.append(F.coalesce(F.when(F.array_contains("w", p[-1]), _phrase_starts(F.col("w"), p)), F.array().cast("array<int>")))
    shares = []
    for (_, text, keys), ways in zip(templates, sets):
        share = _share(F.col("w"), text.split(), _keys(text, keys))
        best = []
        for anchors in ways:
            full = F.lit(True)
            for word, _ in anchors:
                full = full & F.array_contains("w", word)
            best.append(F.coalesce(F.when(full, F.array_max(F.transform(_offsets(F.col("w"), anchors), share))), F.lit(0.0)))
        shares.append(F.greatest(*best, F.lit(0.0)))
    d = d.select("doc_id", "n_words", F.when(F.col("w").isNotNull(), F.struct(
        *[s.alias(f"b{k}") for k, s in enumerate(starts)], *[s.alias(f"t{k}") for k, s in enumerate(shares)])).alias("f"))
    none = F.array().cast("array<int>")
    every = F.concat(*[F.coalesce(F.col(f"f.b{k}"), none) for k in range(len(base))])
    base_labels = F.array_compact(F.array(*[F.when(F.size(F.col(f"f.b{k}")) > 0, F.lit(label)) for k, (_, label) in enumerate(base)]))
    found = F.array_compact(F.array(*[F.when(F.col(f"f.t{k}") >= min_share, F.lit(label)) for k, (label, _, _) in enumerate(templates)]))
    best = F.greatest(*[F.when(F.col(f"f.t{k}") >= min_share, F.col(f"f.t{k}")).otherwise(0.0) for k in range(len(templates))], F.lit(0.0))
    d = d.select("doc_id", "n_words", every.alias("every"), base_labels.alias("base"), found.alias("found"), best.alias("best"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return d.select("doc_id", "n_words", F.size("every").cast("long").alias("n_base"),
                    F.array_min("every").cast("long").alias("first_word"), F.array_max("every").cast("long").alias("last_word"),
                    joined(F.col("base")).alias("base_labels"), joined(F.concat("base", "found")).alias("labels"),
                    F.greatest("best", F.when(F.size("every") > 0, PHRASE_SCORE).otherwise(0.0)).cast("double").alias("score"))
