"""Every registered query against its SQL on the smallest data."""

import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from check import TABLES, digest
from conftest import SF
from scholar_lake.plans.oracles import ORACLES
from scholar_lake.plans.queries import QUERIES, _dealt


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_the_rest_works_without_the_optional_subpackage():
    code = ("import sys\nclass No:\n    def find_spec(self, name, path=None, target=None):\n"
            "        if name in ('scholar_lake.llm', 'corpus_pipeline'):\n            raise ModuleNotFoundError(name=name)\n"
            "sys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nprint(len(e.queries()), len(e.oracle_sql()))")
    done = subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(entry_point.__file__), capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES))]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    assert digest(QUERIES[name](spark, SF).toPandas()) == digest(db.execute(ORACLES[name]).df())


def test_tasks_over_tables_of_numbers_are_sized_by_rows(spark):
    """A few bytes of such rows become much nested data, so the bytes that a task reads say nothing about its memory."""
    rows = spark.range(0, 100_000, 1, 1).withColumnRenamed("id", "l_orderkey")
    counted = _dealt(rows, 1000).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
    assert counted.agg(F.max("n")).first()[0] < 2000 and counted.agg(F.sum("n")).first()[0] == 100_000
    assert _dealt(rows.limit(0), 1000).count() == 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
