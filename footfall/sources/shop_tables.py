"""The given TPC-H-like tables, seen as the four clickstream tables.

``events`` supplies the actions (a user's day is a session, "signup" stands in
for an order), ``customer`` the users, ``part`` the products, ``nation`` and
``region`` the cities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.conditions import Conditions
from footfall.schema import CITY_INFO, PRODUCT_INFO, USER_INFO, USER_VISIT_ACTION, conform

DEFAULT_CONDITIONS = Conditions(
    start_date="2024-01-05", end_date="2024-01-20", start_age=20, end_age=50
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def visit_actions(
    spark: SparkSession, sf_dir: str, conditions: Conditions | None = None
) -> DataFrame:
    """``user_visit_action`` from ``events``.

    The date column is derived here, and a filter on it does not reach the
    files; the conditions, if given, add the same bounds on ``ts``, which do.
    """
    events = _table(spark, sf_dir, "events")
    if conditions is not None and conditions.start_date is not None:
        events = events.where(F.col("ts") >= F.lit(conditions.start_date).cast("timestamp_ntz"))
    if conditions is not None and conditions.end_date is not None:
        next_day = F.date_add(F.lit(conditions.end_date).cast("date"), 1)
        events = events.where(F.col("ts") < next_day.cast("timestamp_ntz"))
    actions = events.selectExpr(
        "*",
        "substring(string(ts), 1, 10) AS date",
        "bigint(regexp_extract(props, '([0-9]+)', 1)) AS k",
    ).selectExpr(
        "date",
        "user_id",
        "concat(user_id, '-', date) AS session_id",
        "event_id % 50 + 1 AS page_id",
        "substring(string(ts), 1, 19) AS action_time",
        "CASE WHEN event_type = 'view' THEN concat('kw_', k % 6) END AS search_keyword",
        "CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id",
        "CASE WHEN event_type = 'click' THEN k % 100 + 1 ELSE -1 END AS click_product_id",
        "CASE WHEN event_type = 'signup' THEN concat(k % 20 + 1, ',', (k + 7) % 20 + 1) END"
        " AS order_category_ids",
        "CASE WHEN event_type = 'signup' THEN concat(k % 100 + 1, ',', (k + 13) % 100 + 1) END"
        " AS order_product_ids",
        "CASE WHEN event_type = 'purchase' THEN string(k % 20 + 1) END AS pay_category_ids",
        "CASE WHEN event_type = 'purchase' THEN string(k % 100 + 1) END AS pay_product_ids",
        "event_id % 25 AS city_id",
    )
    return conform(actions, USER_VISIT_ACTION)


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "c_name AS username",
        "c_name AS name",
        "int(c_custkey % 50 + 10) AS age",
        "c_mktsegment AS professional",
        "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
    )
    return conform(users, USER_INFO)


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = _table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name", "p_type AS extend_info"
    )
    return conform(products, PRODUCT_INFO)


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")
    cities = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).selectExpr(
        "n_nationkey AS city_id", "n_name AS city_name", "r_name AS area"
    )
    return conform(cities, CITY_INFO)
