"""The given tables, as batch and as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice")
_ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double"


# Session setting: into how many tasks a scan of the orders is dealt before the work per row gets costly.
TASKS_SETTING = "tillwatch.orderTasks"


def chosen_tasks(spark: SparkSession) -> int | None:
    """The caller's choice for this session; unset, a table is worked on in the partitions it is read in."""
    tasks = spark.conf.get(TASKS_SETTING, None)
    return int(tasks) if tasks else None


def spread_out(df: DataFrame, key: str, tasks: int | None) -> DataFrame:
    """Deal rows to ``tasks`` tasks by a shuffle, for input in few or unsplittable files."""
    return df if tasks is None else df.repartition(tasks, key)


def read_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*ORDER_COLUMNS)
    return spread_out(orders, "o_orderkey", chosen_tasks(spark))


def stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a stream takes a single file only by a pattern; it also fits a folder
    orders = spark.readStream.schema(_ORDER_SCHEMA).parquet(f"{sf_dir}/orders[.]parquet")
    return spread_out(orders, "o_orderkey", chosen_tasks(spark))
