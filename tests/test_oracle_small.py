"""A slice of the driver's correctness gate: registered analyses against
their DuckDB SQL on the smallest tables (the full run is
``tools/check_oracle.py``)."""

import math

import duckdb
import pytest
from conftest import SF_SMALL

from quillspark.plans.oracle import oracle_sql
from quillspark.plans.queries import queries

TABLES = ["customer", "supplier", "part", "orders", "lineitem", "events", "nation",
          "documents", "pages", "labels", "conversations"]
NAMES = ["word_counts", "tf_idf", "top_terms", "sentiment_arc", "sentiment_decile", "tfidf_decile",
         "cooccurrence_share", "number_turns", "annotate_structure", "segment_trim", "fill_up", "lag_lead",
         "words_per_role", "build_lexicon", "name_profile", "select_works", "pivot_fill", "weighted_mean",
         "compare_vocab", "alpha_code", "play_network", "row_number_all", "subject_counts_period", "scene_sizes"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def rows(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, sorted(tuple(norm(x) for x in r) for r in zip(*data))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, name):
    got = rows(queries()[name](spark, SF_SMALL).toArrow())
    want = rows(con.sql(oracle_sql()[name]).to_arrow_table())
    assert got == want
