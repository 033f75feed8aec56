"""Every registered query against its SQL on the test tables."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tests.conftest import TESTDATA
from wordweave.functions.threshold import Threshold
from wordweave.plans import similarity_jobs as jobs

SF = TESTDATA / "sf0.001"

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


# Queries of the part that can be left out are tested beside it.
OWN = sorted(name for name in registry.queries() if name != "pipeline" and not re.match(r"op\d+_", name))


def test_every_query_has_sql():
    assert set(OWN) <= registry.oracle_sql().keys()


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    found = registry.queries()[name](spark, str(SF))
    expected = con.sql(registry.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    rows = sorted(tuple(r[c] for c in columns) for r in found.collect())
    assert rows == sorted(expected.select(*columns).fetchall())


def test_entry(spark):
    groups = registry.entry(spark)
    assert groups.columns == ["set_lo", "set_hi", "similarity", "n_lo", "n_hi"]
    pairs = F.when(F.col("set_lo") == F.col("set_hi"), F.expr("n_lo * (n_lo - 1) div 2")).otherwise(F.col("n_lo") * F.col("n_hi"))
    assert groups.agg(F.sum(pairs)).first()[0] == 1109


@pytest.mark.parametrize("name", OWN)
def test_no_ordered_limit_in_a_plan(spark, name):
    plan = registry.queries()[name](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize(
    ("threshold", "n_pairs"), [(Threshold(1, 2, False), 1118), (Threshold(4, 5, True), 1109), (Threshold(4, 5, False), 1109)]
)
def test_pair_counts(spark, threshold, n_pairs):
    docs = spark.read.parquet(str(SF / "documents.parquet")).select("doc_id", "text")
    assert jobs.similar_lines(docs, threshold, max_count=400).count() == n_pairs


def test_naive_similarity_compares_all_lines(spark, monkeypatch):
    monkeypatch.setattr(registry, "FIRST_LINES", 3)
    found = registry.naive_similarity(spark, str(SF))
    expected = registry.similar_groups_with_texts(spark, str(SF))
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))
