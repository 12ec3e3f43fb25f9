"""Every registered query against its check SQL on the smallest scale, and the joins its plan must avoid."""

import pytest
from check_oracles import compare

import __spark_entry__ as entry_points
from stratamart.queries import REGISTRY

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas",
          "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(name, spark, duck, sf_dir):
    q = REGISTRY[name]
    df = q.run(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BANNED if b in plan]
    if q.sql is None:
        assert df.count() > 0
    else:
        assert compare(df, duck, q.sql) is None


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).count() == 150
