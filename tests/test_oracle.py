"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import core
from checks.compare import compare, duck
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"
QUERIES, SQL = core.QUERIES, core.ORACLE


@pytest.fixture(scope="module")
def db():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    plans = []

    def run(*args):
        df = QUERIES[name](*args)
        plans.append(plan_of(df))
        return df

    ok, note = compare(spark, db, SF, name, run, SQL.get(name))
    assert ok, note
    assert "CartesianProduct" not in plans[0] and "BroadcastNestedLoopJoin" not in plans[0]
    # Only the similarity of names leaves the JVM.
    assert "EvalPython" not in plans[0] or "_key_similarity" in plans[0]


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"district_name", "poi_count"} <= set(rows[0].asDict())
