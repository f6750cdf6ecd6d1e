"""The registered queries of the subpackage on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from starloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {n.split("_")[0] for n in queries.QUERIES}
    assert set(queries.QUERIES) <= set(E.queries()) and set(queries.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(found.fetchall())


def test_op7_counts_each_kind(spark, tmp_dir):
    rows = [(1, "mail ann@b.org or bob@c.org"), (2, "host 10.0.0.1"), (3, "4111 1111 1111 1111"), (4, "call +1 (555) 010-1234"),
            (5, "nothing"), (6, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op7_pii(spark, tmp_dir).orderBy("doc_id").select("n_email", "n_ip", "n_card", "n_phone").collect()
    assert [tuple(r) for r in got] == [(2, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0, 0, 0, 0), (0, 0, 0, 0)]
