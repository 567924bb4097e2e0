"""Every registered query against its SQL oracle, on whole tables."""

import pytest

import __spark_entry__ as entry_point
from compare import differences
from tidemark.plans import catalog, oracles


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_oracle(spark, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    assert differences(df, entry_point.oracle_sql()[name], sf_dir) is None


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert {"event_id", "is_deleted", "dw_load_datetime"} <= set(df.columns)
