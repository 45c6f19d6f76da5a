"""The driver's contract; holds with and without the training-data subpackage."""

from __future__ import annotations

import importlib.util
import os

import pytest

import __spark_entry__ as entry
from fojas.operators import eav
from fojas.plans import catalog

DATA = "/root/testdata/sf0.001"


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert ("p1_found" in entry.queries()) == (importlib.util.find_spec("fojas.llm") is not None)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")
def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "marca" in df.columns
    assert eav.p4_found(spark, DATA).columns == ["documento_id", "campo", "valor"]
