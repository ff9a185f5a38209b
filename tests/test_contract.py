"""Every registered query against its SQL twin, and the shape of all plans."""

import duckdb
import pytest

import __spark_entry__ as contract
from helpers import DATA, comparable, table_views
from intentloom.plans import catalog

SMALL = f"{DATA}/sf0.001"
# those of the optional subpackage have tests of their own
QUERIES = {k: v for k, v in contract.queries().items() if k in catalog.QUERIES}
TWINS = {k: v for k, v in contract.oracle_sql().items() if k in QUERIES}
# fitted by an iterative optimizer; the accuracy is checked in test_classify
WITHOUT_TWIN = {"train_classifier_ml"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    table_views(connection, SMALL)
    yield connection
    connection.close()


def test_twins_are_complete():
    assert set(QUERIES) - set(TWINS) == WITHOUT_TWIN
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    report = contract.entry(spark)
    assert report.columns == [
        "section_no", "section", "label", "precision", "recall", "f1", "support"
    ]
    assert report.count() > 3


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, database, name):
    query = QUERIES[name](spark, SMALL)
    found = query.toArrow()
    expected = database.sql(TWINS[name]).to_arrow_table()
    assert comparable(found) == comparable(expected)
    assert found.num_rows > 0
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_the_query_without_a_twin_covers_its_table(spark, database):
    found = QUERIES["train_classifier_ml"](spark, SMALL)
    ids = [r["id"] for r in found.collect()]
    expected = database.sql("select doc_id from documents order by 1").fetchall()
    assert sorted(ids) == [i for (i,) in expected]
