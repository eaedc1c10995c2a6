"""Every registered query that has SQL gives the same result as DuckDB on the smallest tables."""

import os

import pytest

from tabweave.catalog import QUERIES, SQL
from tools.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
# Trained models are covered at their own size in test_models; here the rest runs.
TRAINED = {n for n, f in QUERIES.items() if f.__module__.endswith(".models")} | {"tree_shap_forest", "tree_shap_boosted"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """The queries run as they do outside of tests, with generated code."""
    settings = ("spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")
    before = [spark.conf.get(s) for s in settings]
    spark.conf.set(settings[0], "true")
    spark.conf.set(settings[1], "FALLBACK")
    yield
    for s, v in zip(settings, before):
        spark.conf.set(s, v)


def test_registry():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(SQL) - TRAINED))
def test_same_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).df()) == ""


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert entry.queries().keys() >= entry.oracle_sql().keys()
