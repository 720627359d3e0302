"""Every registered query against its SQL, on the generated tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from checks.catalog import QUERIES
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no generated tables here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    sql = entry_module.oracle_sql()[name]
    assert compare(entry_module.queries()[name](spark, FOLDER), connect(FOLDER), sql) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
