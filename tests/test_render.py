"""Orders to log rows and records, and all the way back."""

from pyspark.sql import functions as F

from tillwatch.contract import EVENT_KINDS
from tillwatch.functions.message import render_template, weighted_choice
from tillwatch.operators.enrich import accepted_events, classify_records
from tillwatch.operators.render import encode_log, order_records, payment_events, render_log
from tillwatch.sources.tables import read_orders


def test_weighted_choice_follows_the_weights(spark):
    draws = spark.range(100).select(weighted_choice(F.col("id"), [(k.action, k.weight) for k in EVENT_KINDS]).alias("a"))
    counts = {row.a: row["count"] for row in draws.groupBy("a").count().collect()}
    assert counts == {kind.action: kind.weight for kind in EVENT_KINDS}


def test_template(spark):
    row = spark.createDataFrame([("x", 2.5)], "a string, b double")
    rendered = row.select(render_template("<{a}> ${b:.2f}{a}", {"a": F.col("a"), "b": F.col("b")}))
    assert rendered.first()[0] == "<x> $2.50x"


def test_event_shares(spark, sf_dir):
    events = payment_events(read_orders(spark, sf_dir))
    total = events.count()
    counts = {row.action: row["count"] for row in events.groupBy("action").count().collect()}
    assert total == 1500
    assert counts == {kind.action: total * kind.weight // 100 for kind in EVENT_KINDS}


def test_large_keys_stay_distinct(spark):
    keys = [7, 10**12 + 1, 10**13 + 11, 10**16 + 7, 10**17 + 7]
    orders = spark.createDataFrame([(key, 10**7, 5.0) for key in keys], "o_orderkey long, o_custkey long, o_totalprice double")
    rows = payment_events(orders).select("order_key", "order_id", "user_id", "payment_id").collect()
    assert [row.order_id for row in rows] == [f"order_{key:012}" for key in keys]
    assert [row.payment_id for row in rows] == [f"pay_{key:016}" for key in keys]
    assert {row.user_id for row in rows} == {"user_10000000"}


def test_every_order_comes_back_from_its_record(spark, sf_dir):
    events = payment_events(read_orders(spark, sf_dir))
    failed = F.col("action").endswith("failed")
    successful_id = F.when(F.col("action") == "payment_successful", F.col("payment_id")).when(
        F.col("action") == "refund_processed", F.col("refund_id")
    )
    expected = events.select(
        "event_time",
        F.when(failed, "ERROR").otherwise("INFO").alias("level"),
        F.initcap(F.split("action", "_")[0]).alias("type"),
        failed.alias("is_failed"),
        "order_id",
        "amount",
        "user_id",
        F.col("ip").alias("ip_address"),
        successful_id.alias("payment_id"),
        F.when(failed, F.col("reason")).alias("fail_reason"),
    )
    found = accepted_events(classify_records(encode_log(render_log(events))))
    assert found.columns == expected.columns
    assert found.count() == expected.count() == 1500
    assert found.exceptAll(expected).isEmpty()


def test_record_columns_are_those_of_a_topic(spark, sf_dir):
    from tillwatch.contract import KAFKA_SCHEMA

    found = order_records(read_orders(spark, sf_dir)).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in KAFKA_SCHEMA]
