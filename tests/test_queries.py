"""Every registered query against its check SQL on the smallest tables."""

import os

import compare as tool
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return tool.duck(SF_DIR)


# The corpus operators have tests of their own.
NAMES = sorted(n for n, fn in entry.queries().items() if fn.__module__.startswith("plumbline.queries."))


def test_every_query_has_a_check():
    assert set(NAMES) <= set(entry.oracle_sql())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["state_name", "addresses"] and df.count() > 0


# Queries whose result may be empty on tables this small.
MAY_BE_EMPTY = {"label_points_in_states", "voter_cluster_sizes"}


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    message = tool.compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert message is None or (message == "no rows" and name in MAY_BE_EMPTY)
