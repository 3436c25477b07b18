import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from helpers import WORD, jaccard_components
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after each stage, the input first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        if len(out) < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"]


def test_toxic_documents_go_and_others_stay(spark, stages):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    labelled = [r for r in stages[0] if r.doc_id in toxic]
    # a handful of labelled toxic rows teach little here; clean documents stay
    assert sum(r.doc_id in kept for r in labelled if not toxic[r.doc_id]) == sum(not toxic[r.doc_id] for r in labelled)
    assert sum((r.doc_id in kept) != toxic[r.doc_id] for r in labelled) >= 0.95 * len(labelled)


def test_lines_stay_once(stages):
    lines = Counter(" ".join(x.lower().split()) for r in stages[2] for x in r.text.split("\n") if x.strip())
    assert max(lines.values()) == 1 and all(r.n_chars == len(r.text) for r in stages[2])
    before = {" ".join(x.lower().split()) for r in stages[1] for x in r.text.split("\n") if x.strip()}
    assert len(lines) >= 0.9 * len(before)


def test_one_of_each_near_duplicate_group(stages):
    rows = [(r.doc_id, r.text) for r in stages[2]]
    comp = jaccard_components(rows, corpus_pipeline.WORDS, corpus_pipeline.PERCENT)[1]
    assert sorted(r.doc_id for r in stages[3]) == sorted(i for i, _ in rows if comp[i] == i)


def test_mixture_takes_its_share(stages):
    words = lambda rows: sum(len(WORD.findall(r.text)) for r in rows)
    assert words(stages[4]) == pytest.approx(1.5 * words(stages[3]), rel=0.1)
    assert max(Counter(r.doc_id for r in stages[4]).values()) <= 2


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, len(library.encode(r.text, add_special_tokens=False).ids)) for r in stages[4])
    assert Counter((r.doc_id, r.n_tokens) for r in stages[5]) == want


def test_run_gives_the_stages_rows(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1]))
