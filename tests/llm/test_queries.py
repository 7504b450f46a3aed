"""The registered queries on the smallest tables: with SQL against it, the others for their shape."""

import pytest

from checks.compare import compare, duck
from poilake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, db, name):
    plans = []

    def run(*args):
        df = queries.QUERIES[name](*args)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    ok, note = compare(spark, db, SF, name, run, queries.ORACLE.get(name))
    assert ok, note
    assert "CartesianProduct" not in plans[0] and "BroadcastNestedLoopJoin" not in plans[0]
    if name.split("_")[0] in ("op2", "op3", "op8"):
        assert "Python" not in plans[0] and "Pandas" not in plans[0] and "Arrow" not in plans[0]
