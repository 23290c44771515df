"""Every registered query against its SQL check on the driver's tables."""

from __future__ import annotations

import re

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.01"


def own(names):
    """The queries of this library without those for training data, which have tests of their own."""
    return [n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)]


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", own(entry.oracle_sql()))
def test_equals_check(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def test_every_query_has_a_check():
    assert set(own(entry.queries())) == set(own(entry.oracle_sql()))


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 12
