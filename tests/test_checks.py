"""Every query with comparison SQL, against DuckDB on the smallest tables."""

import pytest

from checks import trained  # noqa: F401
from checks.catalog import BUILDS, SQL
from checks.data import Data
from checks.run import connect, same

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    return Data(spark, FOLDER)


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, data, duck):
    result = BUILDS[name](data)
    assert same(result.collect(), result.columns, duck.execute(SQL[name])) == ""


def test_names():
    assert len(BUILDS) >= 130 and set(SQL) <= set(BUILDS)
    assert not any(n.startswith("op") or "pipeline" in n for n in BUILDS)


def test_audits_find_no_leak(data):
    for name in ("l1_outcome_leaks", "l2_cancellation_leaks"):
        assert BUILDS[name](data).first().changed == 0


def test_comparison_queries(data):
    assert [tuple(r) for r in BUILDS["e2_results_match"](data).collect()] == [
        ("same rows, other names and columns", True), ("other rows", False)]
    assert tuple(BUILDS["e3_answer_scores"](data).first()) == (4, 5, 0.8)
