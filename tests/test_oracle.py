import os

import pytest

from ratevane.plans import catalogue
from tests import oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.FOLDER), reason="no tables here")


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, name):
    oracle.agree(spark, catalogue.QUERIES[name], catalogue.SQL[name])


def test_point_in_time_plans_one_exchange(spark):
    plan = catalogue.QUERIES["price_asof_day"](spark, oracle.FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3 and "NestedLoop" not in plan and "Cartesian" not in plan
