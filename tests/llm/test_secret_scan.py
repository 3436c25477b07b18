import random
import re
import string
from hashlib import sha256

import pytest
from helpers import corpus, docs_frame, prose

from quillspark.llm import secret_scan as ss

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
WORD, B62 = re.compile(r"[^\x20\x09-\x0D]+"), string.ascii_letters + string.digits


def base(text):
    text = text or ""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], ss.KINDS.index(s[0])))


def token(rnd, n, symbols=B62):
    return "".join(rnd.choice(symbols) for _ in range(n))


def texts(rnd):
    join = [" = ", ":", '="', "' :  '", "==", " ", "=:"]
    keys = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "tokens", "ſecret", "toKen"]
    for i in range(150):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            parts += [prose(rnd, rnd.randint(0, 9), 30), rnd.choice(["é", "", "日本 ", "\n"]),
                      rnd.choice([rnd.choice(keys) + rnd.choice(join) + token(rnd, rnd.randint(3, 40)), "AKIA" + token(rnd, rnd.randint(10, 20), string.ascii_uppercase + "0189"),
                                  token(rnd, rnd.randint(20, 44), "0123456789abcdef"), "password=token: " + token(rnd, 9), "AKIAKIA" + token(rnd, 14, "AB9")])]
        yield i, rnd.choice(["", " ", ","]).join(parts), "en", "a"


def spans(row):
    return [(s.kind, s.start, s.end) for s in row.spans]


def test_base_spans_match_plain_patterns(spark):
    rows = [*texts(random.Random(1)), *corpus(), (900, "é token = abcdef", "en", "a"), (901, "token=abcdef" * 3000, "en", "a"), (902, "f" * 100_000, "en", "a")]
    docs = docs_frame(spark, rows).withColumnRenamed("component_id", "spans")
    got = ss.digests(ss.scan(docs)).collect()
    want = []
    for i, t, *_ in rows:
        b = base(t)
        count = [sum(k == kind for k, *_ in b) for kind in ss.KINDS[:3]]
        want.append((i, *count, sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest()))
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, want))
    assert min(sum(w[k] for w in want) for k in (1, 2, 3)) > 20
    by_text = {t: base(t) for _, t, *_ in rows}
    for r in ss.scan(docs).collect():
        found = [s for s in spans(r) if s[0] != "random"]
        assert found in by_text.values() and spans(r) == sorted(spans(r), key=lambda s: (s[1], ss.KINDS.index(s[0])))


def test_generated_tokens_are_found_and_text_is_left(spark):
    rnd = random.Random(2)
    words = [w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() for w in r.text.split() if len(w) < 24]
    rows, planted = [], {}
    for i in range(600):
        text = " ".join(rnd.choice(words) for _ in range(60))
        if i % 3 == 0:
            t = token(rnd, rnd.choice([24, 32, 40, 64]), rnd.choice([B62, B62 + "+/", string.ascii_uppercase + "234567"])).strip("+/_-")
            planted[i] = ("random", len(text) + 3, len(text) + 3 + len(t))
            text += f" é {t} end"
        elif i % 3 == 1:
            text += rnd.choice([" https://host/articles/archive/2024/section/page-of-all-the-weather", " interdisciplinarycounterrevolutionaries", " 2024-11-05T10-22-33-mountain-weather",
                                " mountain_weather_paper_of_the_rivers_1", " " + "-" * 50, " " + "ab" * 30, " 0123456789abcdefghijklmnopqrstuvwxyz"])
        rows.append((i, text, "en", "a"))
    got = {r.doc_id: spans(r) for r in ss.scan(docs_frame(spark, rows)).collect()}
    assert sum(planted[i] in got[i] for i in planted) >= 0.97 * len(planted)
    assert sum(any(k == "random" for k, *_ in got[i]) for i in got if i not in planted) <= 2


@pytest.mark.parametrize("name", ["hex", "base32", "base36", "base62", "base64", "lower", "decimal"])
def test_even_symbols_are_seldom_rejected(name):
    rnd = random.Random(name)
    text = [(0.08, 0.01, 0.02, 0.1)] * len(ss.ENCODINGS)
    symbols = ss.ENCODINGS[name].decode()
    for n in (20, 40, 200):
        p = sorted(ss.battery(token(rnd, n, symbols).encode(), text)[0] for _ in range(400))
        assert p[3] > 1e-5 and 0.3 < p[200] < 0.85 and sum(x < ss.REJECT for x in p) <= 8


def test_alphabet_is_the_smallest():
    names = list(ss.ENCODINGS)
    for t, name in (("123", "decimal"), ("12af", "hex"), ("12AF", "HEX"), ("abc", "hex"), ("xyz", "lower"), ("AB2", "HEX"), ("XY7", "base32"), ("XY9", "BASE36"), ("xY", "letters"),
                    ("xY1", "base62"), ("x/Y", "base64"), ("x-Y", "base64url"), ("x-/Y", "all")):
        assert names[ss.inferred(t.encode())] == name


def test_threshold_is_the_weighted_rule(spark):
    rnd = random.Random(3)
    rows = [[(rnd.uniform(0, 4) if rnd.random() < 0.7 else rnd.uniform(4, 30), rnd.randint(20, 60)) for _ in range(rnd.randint(0, 4))] for _ in range(200)]
    df = spark.createDataFrame([([(0, 3, 1, x, n) for x, n in r] + [(0, 2, 5, None, None)],) for r in rows], f"spans {ss.SPANS}")
    flat = [(x, n) for r in rows for x, n in r]
    every = sum(n for _, n in flat)
    least = ss.threshold(df)
    fits = [x for x, _ in flat if 10 ** -x * every <= 0.01 * sum(y >= x for y, _ in flat)]
    assert fits and least - 0.011 <= min(fits) <= least + 0.011
    assert ss.threshold(df.limit(0)) == float("inf")


def test_pairs_are_counted_inside_texts_only(spark):
    rows = [(1, "ab1", "en", "a"), (2, "b2 éc", "en", "a"), (3, None, "en", "a"), (4, "", "en", "a"), (5, "ab " * 600_000, "en", "a"), (6, "xy" * 10 + " yx", "en", "a")]
    got = {chr(r.pair // 128) + chr(r.pair % 128): r.n for r in ss.pair_counts(docs_frame(spark, rows).coalesce(1)).collect()}
    assert got == {"ab": 600_001, "yx": 1, "b1": 1, "b2": 1}


def test_empty_table(spark):
    assert ss.digests(ss.scan(docs_frame(spark, []))).collect() == []
