"""Plans are what scale asks for: pruned scans, pushed filters, no Python, no nested-loop joins over tables."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from oracle import SF

from folioscope.plans import catalogue

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the driver's tables aren't here")


def plan(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(mode.fromString("formatted"))


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(catalogue.QUERIES[name](spark, SF))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_scans_are_pruned_and_filters_pushed(spark):
    text = plan(catalogue.QUERIES["rate_limit"](spark, SF))
    assert re.search(r"PushedFilters: .*EqualTo\(event_type,error\)", text)
    assert "props" not in re.search(r"ReadSchema: (.*)", text)[1]
    text = plan(catalogue.QUERIES["coverage_by_source"](spark, SF))
    assert all("text" not in m for m in re.findall(r"ReadSchema: (.*)", text))
