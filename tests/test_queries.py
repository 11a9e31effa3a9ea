"""Every registered query against its SQL, over whole test tables."""

import os

import pytest

from catalog import IDS, QUERIES, SQL
from compare import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

# Rows of the survey's operator inventory.
SURVEY = [
    f"{letter}{i}"
    for letter, n in (("A", 12), ("B", 9), ("C", 21), ("D", 12), ("E", 12), ("F", 4), ("G", 25), ("J", 32))
    for i in range(1, n + 1)
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert name in SQL
    assert difference(QUERIES[name](spark, SF), duck, SQL[name]) is None


def test_every_survey_row_has_a_query():
    covered = {i for ids in IDS.values() for i in ids.split()}
    assert [i for i in SURVEY if i not in covered] == []


def test_comparison_sees_a_wrong_value(spark, duck):
    wrong = SQL["group_sum"].replace("sum(price)", "sum(price + 1)")
    assert wrong != SQL["group_sum"]
    assert difference(QUERIES["group_sum"](spark, SF), duck, wrong) is not None


def test_entry_points(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 25
    assert set(contract.oracle_sql()) <= set(contract.queries())
