"""Golden test on a small invented play (our own text)."""

from pyspark.sql import functions as F

from quillspark.operators import structure
from quillspark.sources.text import text_lines

PLAY = [
    "Some header",            # 1
    "The Little Play",        # 2  start marker
    "Persons.",               # 3
    "Anna. A woman.",         # 4
    "",                       # 5
    "First Act.",             # 6  body starts (next line of 5)
    "",                       # 7
    "",                       # 8
    "First Scene. A room.",   # 9
    "Anna sits.",             # 10
    "",                       # 11
    "",                       # 12
    "ANNA.",                  # 13
    "Good day.",              # 14
    "",                       # 15
    "BERT (quietly).",        # 16
    "Day.",                   # 17
    "Second Scene.",          # 18
    "",                       # 19
    "ANNA.",                  # 20
    "Yes.",                   # 21
    "Yes again.",             # 22
    "End of the Little Play",  # 23 end marker
    "trailer",                # 24
]


def lines(spark):
    df = spark.createDataFrame([(1, "\n".join(PLAY))], "work int, text string")
    return text_lines(df, "text", neighbours=structure.NEIGHBOURS)


def test_segment_and_front_matter(spark):
    seg = structure.mark_segments(lines(spark), ["work"], ["line_no"],
                                  start=F.col("prev1") == "The Little Play",
                                  end=F.col("line") == "End of the Little Play", block_size=4)
    assert sorted(r.line_no for r in seg.collect()) == list(range(3, 23))
    front, body = structure.split_front_matter(seg, ["work"], ["line_no"],
                                               body_start=F.col("next1") == "First Act.", block_size=4)
    assert sorted(r.line_no for r in front.collect()) == [3, 4]
    assert min(r.line_no for r in body.collect()) == 5


def annotated(spark):
    return structure.annotate_structure(
        lines(spark), ["work"], ["line_no"], act_pattern="Act", scene_literal="Scene.",
        scene_fixes={"Second Scene.": "Secund Scene."}, block_size=3)


def test_annotate_structure(spark):
    got = {r.line_no: r for r in annotated(spark).collect()}
    # line 6 has no stage-description mark yet (NULL) and is dropped like in R
    assert 6 not in got and 9 not in got and 10 not in got
    # a heading after a blank line counts as a speaker line too (R rule)
    assert got[7].scene_description == "scene_descr_end" and got[7].speaker == "First Act."
    assert got[11].scene_description == "scene_descr_end"
    assert got[11].speaker == "First Scene. A room."
    assert got[14].speaker == "ANNA." and got[14].scene == "First Scene. A room."
    assert got[17].speaker == "BERT (quietly)."
    assert got[18].scene == "Secund Scene." and got[18].speaker == "BERT (quietly)."
    assert got[21].speaker == "ANNA." and got[21].akt == "First Act."


def test_clean_speakers_and_turns(spark):
    cast = spark.createDataFrame([("Anna Smith", "F", "ANNA.", "Anna"), ("Bert", "M", "BERT.", "Bert")],
                                 "name string, gender string, speaker_clean string, nameshort string")
    d = structure.clean_speakers(annotated(spark), cast, drop_patterns=("Act", "Scene"))
    rows = {r.line_no: r for r in d.collect()}
    assert rows[17].speaker_clean == "BERT" and rows[17].activity == "(quietly)."
    # speaker lines are blanked and dropped, unknown speakers keep NULL cast
    assert 13 not in rows and 16 not in rows and rows[14].nameshort == "Anna"
    assert rows[17].nameshort is None
    d2 = structure.clean_speakers(annotated(spark), cast, aliases={"BERT": "BERT."}, drop_patterns=("Act", "Scene"))
    assert {r.line_no: r.nameshort for r in d2.collect()}[17] == "Bert"
    turns = structure.number_turns(d2, ["work"], ["line_no"], block_size=2)
    t = sorted((r.line_no, r.speaker_clean, r.dialrank) for r in turns.collect())
    ranks = [x[2] for x in t]
    assert ranks == sorted(ranks) and ranks[0] == 1
    # consecutive rows of one speaker share a turn; a new speaker opens the next
    by_line = {x[0]: x[2] for x in t}
    assert by_line[21] == by_line[22] and by_line[17] < by_line[21]


def test_number_turns_last_row_and_null_speaker(spark):
    df = spark.createDataFrame([(1, i, s) for i, s in enumerate(["a", "a", "b", None, "b", "a"], 1)],
                               "w int, pos int, sp string")
    got = structure.number_turns(df, ["w"], ["pos"], speaker="sp", block_size=2)
    # NULL speaker: the comparison is NULL, so no turn ends at or before it
    assert [r.dialrank for r in got.orderBy("pos").collect()] == [1, 1, 2, 2, 2, 3]
    assert [r.turnswitch for r in got.orderBy("pos").collect()] == \
        [None, "turnswitch", None, None, "turnswitch", "turnswitch"]
