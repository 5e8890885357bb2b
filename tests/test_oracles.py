"""Every registered query against its SQL twin."""
import pytest

from conftest import SF_DIR
from ledgerline.plans.catalog import ORACLES, QUERIES
from oracle import compare


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    rows, difference = compare(spark, duck, QUERIES[name], ORACLES[name], SF_DIR)
    assert difference is None
    assert rows > 0
