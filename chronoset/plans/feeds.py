"""Feeds derived from the given tables.

E: `events` as a profile history. Key `user_id`, day `to_date(ts)` (the
   column is TIMESTAMP_NTZ, so the date is zone-free), profile attributes
   `event_type` and `props`; the latest row of a day wins by
   (`ts` desc, `event_id` desc).
O: `orders` with the ordering customer embedded as a struct, i.e. a
   transaction that carries its customer's profile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoset.operators.shape import latest_per_day, txn_nest

E_KEY = "user_id"
E_DAY = "day"
E_ATTRS = ["event_type", "props"]
E_TRACKED = ["event_type"]
E_ORDER = ["ts", "event_id"]

O_KEY = "o_custkey"
O_PROFILE = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
O_PROFILE_KEY = "c_custkey"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_daily(spark: SparkSession, sf_dir: str, planted_nulls: bool = False) -> DataFrame:
    """One profile per (user_id, day) from `events` (M8 on feed E)."""
    ev = events(spark, sf_dir)
    daily = latest_per_day(ev, E_KEY, F.to_date("ts"), E_ORDER, E_ATTRS, day_name=E_DAY)
    if planted_nulls:
        daily = daily.withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return daily


def orders_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed O: every order with its customer as struct `customer_info` (P5)."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return txn_nest(orders, customer, O_KEY, O_PROFILE, O_PROFILE_KEY, "customer_info").withColumn(
        O_KEY, F.col("customer_info.c_custkey"))
