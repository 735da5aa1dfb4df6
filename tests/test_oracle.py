"""Every registered query against its SQL counterpart."""

import pytest
from check import difference

import __spark_entry__ as contract
from tillwatch.plans import oracle, registry


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", registry.queries())
def test_query_equals_sql(spark, sf_dir, name):
    count, wrong = difference(spark, name, sf_dir)
    assert wrong is None
    # one query is there to find nothing; at this size no two parts of the orders fall in one minute with enough alerts
    assert count > 0 or name == "alerts_none"


def test_queries_set_their_time_zone(spark, sf_dir):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        _, wrong = difference(spark, "minute_totals", sf_dir)
        assert wrong is None
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", ["validate_required", "accepted_with_faults", "parse_untidy_message", "event_time_parse"])
def test_queries_without_ansi_mode(spark, sf_dir, name):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert difference(spark, name, sf_dir)[1] is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["start", "end", "type", "is_failed", "event_count", "total_amount"]
    assert result.count() == 8
