"""Every registered query at the smallest scale against its check SQL."""

import pytest

from marquee.plans import all_queries
from tests.check import compare

QUERIES, CHECK_SQL = all_queries()


def test_every_check_has_a_query():
    assert set(CHECK_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    problem, _ = compare(spark, "/root/testdata/sf0.001", QUERIES[name], CHECK_SQL.get(name))
    assert problem is None


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
