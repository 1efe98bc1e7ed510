"""Every registered query against its SQL."""

import pytest
from oracle import same

from fedspark.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert same(df, ORACLES[name], FOLDER) is None
    else:
        assert df.count() > 0


def test_time_functions_agree(spark):
    assert list(QUERIES["fn_now"](spark, FOLDER).first()) == [True, True, True]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
