import csv
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quillspark.operators import catalog, ordered, relational as R, sentiment
from quillspark.sources import read_csv_header, read_lines, read_tsv, write_csv


def test_read_lines_keeps_blanks_and_file_names(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "corpus")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("one\n\nthree\n")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("x\r\ny")
    got = sorted(tuple(r) for r in read_lines(spark, d).collect())
    assert got == [("a.txt", 1, "one"), ("a.txt", 2, ""), ("a.txt", 3, "three"), ("b.txt", 1, "x"), ("b.txt", 2, "y")]


def test_csv_blank_string_and_tsv(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "names.csv")
    with open(p, "w") as f:
        f.write("name,gender,speaker_clean,nameshort\nAnna,F,ANNA.,Anna\n,M,Diener.,NA\n")
    schema = StructType([StructField(c, StringType()) for c in ["name", "gender", "speaker_clean", "nameshort"]])
    rows = read_csv_header(spark, p, schema, blank_as_empty=["name"]).orderBy("gender").collect()
    assert rows[1].name == "" and rows[1].nameshort is None
    t = os.path.join(tmpdir_path, "lex.tsv")
    with open(t, "w") as f:
        f.write('gut|ADJX\t0.37\tgute,guter\n"arg|ADJX\t-0.5\t\n')
    ts = StructType([StructField("Wort_POS", StringType()), StructField("Wert", DoubleType()),
                     StructField("Inflektionen", StringType())])
    lex = read_tsv(spark, t, ts).collect()
    assert lex[1].Wort_POS == '"arg|ADJX' and lex[1].Inflektionen is None
    out = os.path.join(tmpdir_path, "out")
    write_csv(spark.createDataFrame([("a", None)], "x string, y string"), out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    lines = text.splitlines()
    assert set(lines) == {"x,y", "a,NA"} and lines.count("a,NA") == 1


def test_build_lexicon_keeps_duplicates(spark):
    neg = spark.createDataFrame([("arg|ADJX", -0.5, "arge,arger"), ("schlecht", -0.7, None)],
                                "Wort_POS string, Wert double, Inflektionen string")
    pos = spark.createDataFrame([("gut|ADJX", 0.4, "gut,gute"), ("arg|ADJX", 0.1, "arge")],
                                "Wort_POS string, Wert double, Inflektionen string")
    lex = sentiment.build_lexicon(neg, pos)
    got = sorted(tuple(r) for r in lex.collect())
    assert ("neg", -0.7, "schlecht") in got and ("pos", 0.1, "arg") in got
    assert got.count(("neg", -0.5, "arge")) == 1 and ("pos", 0.1, "arge") in got
    # the base word "gut" comes back as an inflection: kept twice unless deduped
    assert lex.count() == 9 and sentiment.build_lexicon(neg, pos, dedupe=True).count() == 8


def catalogue(spark):
    meta = spark.createDataFrame(
        [(1, "Tarzan", "Burroughs, Edgar Rice", "en", True), (2, "Tarzan II", "Burroughs, Edgar Rice", "en", True),
         (3, "Crusoe", "Defoe, Daniel", "en", True), (4, "Crusoe fr", "Defoe, Daniel", "fr", True),
         (5, "No text", "Defoe, Daniel", "en", False), (6, "Anon", None, "en", True)],
        "work_id int, title string, author string, language string, has_text boolean")
    subjects = spark.createDataFrame([(1, "Tarzan (Fictitious character)"), (2, "Tarzan (Fictitious character)"),
                                      (2, "Apes -- Fiction"), (3, "Crusoe, Robinson"), (4, "Crusoe, Robinson"),
                                      (5, "Crusoe, Robinson"), (6, "Apes -- Fiction")],
                                     "work_id int, subject string")
    authors = spark.createDataFrame([("Burroughs, Edgar Rice", 1875), ("Defoe, Daniel", 1660), (None, 1700)],
                                    "author string, birthdate int")
    return meta, subjects, authors


def test_select_works_and_minus(spark):
    meta, subjects, _ = catalogue(spark)
    apes = catalog.select_works(meta, subjects, subject_pattern="Apes", language="en")
    assert sorted(r.work_id for r in apes.collect()) == [2, 6]
    tarzan = catalog.select_works(meta, subjects, subject_pattern="Tarzan", language="en")
    rest = catalog.select_works(meta, subjects, subject_pattern="Apes", language="en", minus=tarzan)
    assert [r.work_id for r in rest.collect()] == [6]
    defoe = catalog.select_works(meta, author_patterns=["Defoe", "Daniel"], language="en")
    assert [r.work_id for r in defoe.collect()] == [3]


def test_subject_counts_period(spark):
    meta, subjects, authors = catalogue(spark)
    allc = {r.subject: r.n for r in catalog.subject_counts(subjects).collect()}
    assert allc["Crusoe, Robinson"] == 3
    withtext = {r.subject: r.n for r in catalog.subject_counts(subjects, meta, has_text_col="has_text").collect()}
    assert withtext["Crusoe, Robinson"] == 2
    period = {r.subject: r.n for r in catalog.subject_counts(subjects, meta, authors=authors,
                                                             born=(1600, 1800)).collect()}
    # NULL author matches the NULL author born 1700 (%in% matches NA)
    assert period == {"Crusoe, Robinson": 3, "Apes -- Fiction": 1}


def test_name_profile(spark):
    _, _, _ = catalogue(spark)
    authors = spark.createDataFrame([("Austen, Jane", 1775), ("Scott, Walter", 1771), ("Smith, Zed", 1760),
                                     ("Old, Anne", 1650)], "author string, birthdate int")
    names = spark.createDataFrame([("Jane", 1800, 90, 1), ("Jane", 1950, 0, 500), ("Walter", 1820, 0, 80)],
                                  "name string, year int, female int, male int")
    got = {r.gender: r.n for r in catalog.name_profile(authors, names, born=(1700, 1800), years=(1789, 1850)).collect()}
    assert got == {"female": 1, "male": 1, None: 1}


def test_relational_helpers(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "p"), (None, "q")], "k int, w string")
    assert R.join_on(a, b, ["k"]).count() == 2              # NULL matches NULL
    assert R.join_on(a, b, ["k"], null_safe=False).count() == 1
    assert R.semi_in(a, "k", b).count() == 2
    u = R.union_labelled({"neg": a, "pos": b}, "src")
    assert u.columns == ["src", "k", "v", "w"] and u.count() == 4
    p = R.pivot_fill(spark.createDataFrame([("t", "positive", 2)], "t string, s string, n int"),
                     ["t"], "s", ["negative", "positive"])
    assert [tuple(r) for r in p.collect()] == [("t", 0, 2)]
    srt = R.arrange(spark.createDataFrame([(None,), (2,), (1,)], "x int"), ("x", "desc"))
    assert [r.x for r in srt.collect()] == [2, 1, None]
    assert [r.x for r in R.arrange(srt, "x").collect()] == [1, 2, None]
    assert F is not None


def test_read_lines_in_splits(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "big")
    os.makedirs(d)
    lines = [("" if i % 7 == 0 else f"line {i} " + "x" * (i % 13)) for i in range(1, 1501)]
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    with open(os.path.join(d, "b.txt"), "w") as f:
        f.write("only\nthree\nlines")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")      # many splits per file
    try:
        got = read_lines(spark, d, whole_files=False)
        rows = sorted((r.filename, r.line_no, r.line) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = sorted([("a.txt", i, t) for i, t in enumerate(lines, 1)] +
                  [("b.txt", 1, "only"), ("b.txt", 2, "three"), ("b.txt", 3, "lines")])
    assert rows == want


def test_read_lines_with_neighbours(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "nb")
    os.makedirs(d)
    with open(os.path.join(d, "p.txt"), "w") as f:
        f.write("a\n\nb\nc\n")
    got = sorted(tuple(r) for r in read_lines(spark, d, neighbours={"prev1": 1, "prev2": 2, "next1": -1}).collect())
    assert got == [("p.txt", 1, "a", None, None, ""), ("p.txt", 2, "", "a", None, "b"),
                   ("p.txt", 3, "b", "", "a", "c"), ("p.txt", 4, "c", "b", "", None)]


def both_modes(spark, folder, **options):
    got = [sorted(map(tuple, read_lines(spark, folder, whole_files=w, **options).collect()), key=str) for w in (False, True)]
    assert got[0] == got[1]
    return got[0]


def test_line_ends_and_blank_lines(spark, tmpdir_path):
    texts = {"a": "a\n\n", "b": "a\n\n\n", "c": "", "d": "x\ry\r\nz", "e": "\n", "f": "no end", "g": "tail\r"}
    want = {"a": ["a", ""], "b": ["a", "", ""], "c": [], "d": ["x", "y", "z"], "e": [""], "f": ["no end"], "g": ["tail"]}
    d = os.path.join(tmpdir_path, "ends")
    os.makedirs(d)
    for name, text in texts.items():
        with open(os.path.join(d, name + ".txt"), "w", newline="") as f:
            f.write(text)
    assert both_modes(spark, d) == sorted([(n + ".txt", k, x) for n, xs in want.items() for k, x in enumerate(xs, 1)], key=str)


def test_same_name_in_two_folders(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "same")
    for sub, text in (("a", "1\n2\n3\n"), ("b", "4\n5\n")):
        os.makedirs(os.path.join(d, sub))
        with open(os.path.join(d, sub, "x.txt"), "w") as f:
            f.write(text)
    got = both_modes(spark, d + "/*", path_col="path", neighbours={"prev": 1, "next2": -2})
    assert sorted((r[1].split("/")[-2], r[0], *r[2:]) for r in got) == [
        ("a", "x.txt", 1, "1", None, "3"), ("a", "x.txt", 2, "2", "1", None), ("a", "x.txt", 3, "3", "2", None),
        ("b", "x.txt", 1, "4", None, None), ("b", "x.txt", 2, "5", "4", None)]


def test_csv_round_trip(spark, tmpdir_path):
    rows = [(1, 'say "hi", you', "two\nlines"), (2, None, "a,b"), (3, " blank ", '"')]
    schema = StructType.fromDDL("k int, x string, y string")
    df = spark.createDataFrame(rows, schema)
    out = os.path.join(tmpdir_path, "csv")
    write_csv(df, out)
    assert sorted(map(tuple, read_csv_header(spark, out, schema).collect())) == rows
    with_rows = os.path.join(tmpdir_path, "rows")
    write_csv(df, with_rows, row_numbers=["k"])
    assert all(open(os.path.join(with_rows, f)).readline().startswith('"",k,') for f in os.listdir(with_rows) if f.endswith(".csv"))
    wide = StructType.fromDDL("`row` int, k int, x string, y string")
    assert sorted(map(tuple, read_csv_header(spark, with_rows, wide).collect())) == [(k, k, x, y) for k, x, y in rows]


def test_long_stop_lists_and_tables_agree(spark):
    from quillspark.operators import position
    from quillspark.operators.tokens import remove_stopwords, unnest_tokens
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 37 + k * 11) % 90}" for k in range(60))) for i in range(20)], "doc_id int, text string")
    short = [f"w{k}" for k in range(0, 90, 3)]
    long = short + [f"never{k}" for k in range(20_000)]
    tokens = unnest_tokens(docs, "text")
    table = spark.createDataFrame([(w,) for w in long], "word string")
    rows = lambda d: sorted(map(tuple, d.collect()))
    want = rows(remove_stopwords(tokens, short))
    assert want == rows(remove_stopwords(tokens, long)) == rows(remove_stopwords(tokens, table))
    at = rows(position.text_positions(docs, stop_words=short))
    assert at == rows(position.text_positions(docs, stop_words=long))
    general = position.relative_position(remove_stopwords(tokens, table), ["doc_id"], ["tpos"])
    assert at == rows(general)


def test_null_in_a_stop_list_removes_null_tokens(spark):
    from quillspark.operators.tokens import remove_stopwords
    t = spark.createDataFrame([("a",), (None,), ("b",)], "word string")
    assert [r.word for r in remove_stopwords(t, ["a", None]).collect()] == ["b"]
    assert remove_stopwords(t, ["a"]).count() == 2


def test_catalogue_joins_match_null_ids(spark):
    meta = spark.createDataFrame([(1, "en", True), (None, "en", True)], "work_id int, language string, has_text boolean")
    subjects = spark.createDataFrame([(1, "s"), (None, "s")], "work_id int, subject string")
    assert catalog.select_works(meta, subjects, subject_equals="s").count() == 2
    assert [r.n for r in catalog.subject_counts(subjects, meta, has_text_col="has_text").collect()] == [2]


def test_shared_folder_must_be_named_on_a_cluster(monkeypatch):
    import pytest

    from quillspark import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())


def csv_text(rnd, n, newline="\n"):
    """Rows with line breaks, quotes, separators and blanks in quoted fields, as write.csv makes them."""
    out = ['"id","note","x"']
    for i in range(n):
        note = rnd.choice(["plain", "two\nlines", "a\n\nb", 'say ""hi""\nnow', "a,b", "", "\n", 'q""', "é\n" * rnd.randint(1, 30), "NA"])
        out.append(f'{i},{"NA" if note == "NA" else chr(34) + note + chr(34)},{rnd.choice(["1.5", "NA", "-2"])}')
        if rnd.random() < 0.05:
            out.append("")
    return newline.join(x.replace("\n", newline) for x in out) + newline


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_csv_with_line_breaks_is_read_in_splits(spark, tmpdir_path, newline):
    rnd = random.Random(len(newline))
    folder = Path(tmpdir_path, "csv")
    folder.mkdir()
    (folder / "large.csv").write_bytes(csv_text(rnd, 4000, newline).encode())
    (folder / "small.csv").write_bytes(csv_text(rnd, 3, newline).rstrip().encode())
    (folder / "head.csv").write_bytes(b'"id","note","x"')
    schema = StructType.fromDDL("id int, note string, x double")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = read_csv_header(spark, str(folder), schema)
        assert spark.read.text(str(folder / "large.csv"), lineSep="\n").rdd.getNumPartitions() > 8
        rows = sorted(map(str, map(tuple, got.collect())))
        whole = sorted(map(str, map(tuple, read_csv_header(spark, str(folder), schema, whole_files=True).collect())))
        assert read_csv_header(spark, str(folder / "large.csv"), schema, whole_files=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got.schema == schema and len(rows) == 4003 and rows == whole
    with open(folder / "large.csv", newline="") as f:
        want = [r for r in csv.reader(f) if r][1:]
    blank = read_csv_header(spark, str(folder / "large.csv"), schema, blank_as_empty=["note"]).where("note is not null").orderBy("id").collect()
    notes = {int(r[0]): r[1].replace("\r\n", "\n") for r in want}
    assert len(blank) == 4000 and all(r.note == ("" if notes[r.id] in ("", "NA") else notes[r.id]) for r in blank)


def test_locale_order(spark):
    words = ["b", "a", "A", "á", "Ä", "z", "Z", "ä", "B", "co-op", "coop", "e", "é", "ñ", "n", "o", "10", "2", None, "a"]
    df = spark.createDataFrame([(w, k) for k, w in enumerate(words)], "w string, k int")
    order = ["10", "2", "a", "A", "á", "ä", "Ä", "b", "B", "co-op", "coop", "e", "é", "n", "ñ", "o", "z", "Z"]
    codes = {r.w: r.code for r in ordered.alphabetical_code(df, "w", collation="en").collect()}
    assert codes == {w: k for k, w in enumerate(order, 1)}
    assert {r.w: r.code for r in ordered.alphabetical_code(df, "w").collect()}["Z"] < codes["Z"]
    swedish = {r.w: r.code for r in ordered.alphabetical_code(df, "w", collation="sv").collect()}
    assert swedish["ä"] > swedish["z"] and codes["ä"] < codes["b"]
    got = R.arrange(df, "w", ("k", "desc"), collation="en")
    assert got.dtypes == df.dtypes and [r.w for r in got.collect()] == order[:2] + ["a"] + order[2:] + [None]
    assert [r.w for r in R.arrange(df, ("w", "desc"), "k", collation="en").collect()][-1] is None
    # canonically equal texts stay levels of their own
    two = spark.createDataFrame([("\u00e9",), ("e\u0301",), ("f",)], "w string")
    assert sorted(r.code for r in ordered.alphabetical_code(two, "w", collation="en").collect()) == [1, 2, 3]
