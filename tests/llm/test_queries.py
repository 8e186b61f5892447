"""Every query of this subpackage with SQL gives its rows."""

import pytest

from loamfold.llm import queries

from .sql import same_rows


@pytest.mark.parametrize("name", ["op6_suffix_arrays", "op8_superminhash", "op11_learned_rank_cuts"])
def test_query_against_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    assert same_rows(queries.RUNNERS[name](spark, folder), queries.ORACLES[name], folder) == 1000


def test_codes_against_sql(spark, folder):
    name = "op13_equal_average_search"
    assert same_rows(queries.RUNNERS[name](spark, folder), queries.ORACLES[name], folder) == 500


def test_all_thirteen_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.RUNNERS) == list(range(1, 14))
