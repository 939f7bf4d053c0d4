from __future__ import annotations

from pathlib import Path

import pytest
from oracle import SF, assert_same

from folioscope.plans import catalogue

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query_agrees_with_sql(spark, name):
    assert_same(catalogue.QUERIES[name](spark, SF), catalogue.ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
