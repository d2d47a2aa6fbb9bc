import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from comparing import duck_rows, spark_rows
from conftest import SF

from pairquarry.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    assert spark_rows(registry.QUERIES[name](spark, SF)) == duck_rows(duck.sql(registry.ORACLE_SQL[name]))


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
