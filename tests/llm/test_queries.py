import duckdb
import pytest

from quillspark.llm import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(oracle.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    got = queries.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(cols)
    assert sorted(map(str, map(tuple, got.select(*cols).collect()))) == sorted(map(str, cur.fetchall()))


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
