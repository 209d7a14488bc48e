"""The registered queries: SQL where there is some, whole tables everywhere."""

import duckdb
import pytest

from check import TABLES, digest
from conftest import SF
from scholar_lake.llm.oracles import ORACLES
from scholar_lake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, db, name):
    assert digest(QUERIES[name](spark, SF).toPandas()) == digest(db.execute(ORACLES[name]).df())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES and n not in ("pipeline", "op8_decontamination")])
def test_one_row_per_document(spark, name):
    got = sorted(r[0] for r in QUERIES[name](spark, SF).select("doc_id").collect())
    assert got == sorted(r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())
