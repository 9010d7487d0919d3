
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402
from pyspark.sql.types import StructType  # noqa: E402

from footfall.conditions import Conditions  # noqa: E402
from footfall.functions import (  # noqa: E402
    category_kind,
    epoch_seconds,
    is_click,
    is_order,
    is_pay,
)
from footfall.operators import actions as act  # noqa: E402
from footfall.operators import categories as cat  # noqa: E402
from footfall.operators import sampling as smp  # noqa: E402
from footfall.operators import sessions as ses  # noqa: E402
from footfall.operators.day_states import DayStates  # noqa: E402
from footfall.operators.session_parts import session_info_parts  # noqa: E402
from footfall.plans import (  # noqa: E402
    category_session_top,
    category_top,
    page_conversion,
    run_all,
    session_extract,
    session_stats,
)
from footfall.plans.run import of_users  # noqa: E402
from footfall.plans.scratch import Scratch  # noqa: E402
from footfall.schema import USER_INFO, USER_VISIT_ACTION, conform  # noqa: E402
from footfall.sources import shop_tables as shop  # noqa: E402
from footfall.sources.days import read_days, write_days  # noqa: E402
from footfall.sources.rejects import accepted, rejected  # noqa: E402
from footfall.sources.sinks import folder_sink, stamp_run  # noqa: E402
from footfall.sources.tables import from_rows, preview, read_table, replace_table  # noqa: E402

try:  # the subpackage and its pipeline are optional
    import corpus_pipeline
    from footfall.llm.queries import ORACLE_SQL as LLM_SQL, QUERIES

    LLM_QUERIES = {**QUERIES, "pipeline": corpus_pipeline.run}
except ImportError:
    LLM_SQL, LLM_QUERIES = {}, {}

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "run-0001"
SMOKE_DIR = "/root/testdata/sf0.001"
EVERYTHING = Conditions()
DEFAULT = shop.DEFAULT_CONDITIONS
TWO_PROFESSIONS = ("AUTOMOBILE", "BUILDING")
HALVES = (
    ("AFRICA", "east"),
    ("AMERICA", "west"),
    ("ASIA", "east"),
    ("EUROPE", "east"),
    ("MIDDLE EAST", "east"),
)
PAGE_FLOW = (1, 2, 3, 4, 5, 6, 7)
RESULT_TABLES = (
    "session_stat_info",
    "random_session_info",
    "category_top10",
    "category_top10_session_count",
    "page_convert_rate",
)


def _filtered(
    spark: SparkSession, sf_dir: str, conditions: Conditions = DEFAULT
) -> DataFrame:
    return act.filtered_actions(
        shop.visit_actions(spark, sf_dir, conditions),
        shop.user_info(spark, sf_dir),
        conditions,
    )


def _parts(
    spark: SparkSession, sf_dir: str, conditions: Conditions
) -> tuple[DataFrame, DataFrame]:
    """The actions in range and the matching users' ids, not joined yet."""
    actions = shop.visit_actions(spark, sf_dir, conditions).where(conditions.on_actions())
    return actions, act.matching_users(shop.user_info(spark, sf_dir), conditions)


def _sessions(
    spark: SparkSession, sf_dir: str, conditions: Conditions = EVERYTHING
) -> DataFrame:
    return ses.session_rollup(*_parts(spark, sf_dir, conditions))


def _shuffled_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With more users than any planner would broadcast."""
    actions, user_ids = _parts(spark, sf_dir, EVERYTHING)
    return ses.session_rollup(actions, user_ids.hint("merge"))


def _extract(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    sessions = _sessions(spark, sf_dir, DEFAULT)
    return session_extract(_filtered(spark, sf_dir), RUN_ID, sessions, **options)


def _many_sessions_per_category(actions: DataFrame) -> DataFrame:
    """More per group than a window cuts in the map tasks by itself."""
    counts = cat.category_session_counts(cat.clicks_in_categories(actions, _top(actions)))
    return cat.top_sessions(counts, 2000)


def _category_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, user_ids = _parts(spark, sf_dir, DEFAULT)
    return category_top(actions, RUN_ID, user_ids=user_ids)


def _on_actions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(shop.visit_actions(spark, sf_dir))


def _on_users(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(shop.user_info(spark, sf_dir))


def _on_joined(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_filtered(spark, sf_dir, EVERYTHING))


def _on_sessions(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_sessions(spark, sf_dir))


def _conform_actions(actions: DataFrame) -> DataFrame:
    """Columns in another order, narrower, and one too many."""
    loose = actions.select(
        F.lit("x").alias("unused"),
        F.col("city_id").cast("int").alias("city_id"),
        F.col("page_id").cast("string").alias("page_id"),
        *[c for c in reversed(actions.columns) if c not in ("city_id", "page_id")],
    )
    return conform(loose, USER_VISIT_ACTION)


def _top(actions: DataFrame) -> DataFrame:
    return cat.top_categories(cat.category_counts(act.category_events(actions)))


def _category_session_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, user_ids = _parts(spark, sf_dir, DEFAULT)
    top = cat.top_categories(cat.category_counts_of_users(actions, user_ids))
    return category_session_top(actions, top, RUN_ID, user_ids=user_ids)


def _filtered_rollup(spark: SparkSession, sf_dir: str, apart: int = 1) -> DataFrame:
    """Other users' actions dropped at the scan, by a filter over the ids.

    Ids that lie far apart get a filter of their hashes, and are joined after it.
    """
    actions, user_ids = _parts(spark, sf_dir, DEFAULT)
    user_id = (F.col("user_id") * apart).alias("user_id")
    tables = Scratch(spark, "filtered-rollup")
    ids = tables.keep(user_ids.select(user_id), "users")
    return ses.session_rollup(*of_users(actions.withColumn("user_id", user_id), ids, tables))


def _nearly_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered_rollup(spark, sf_dir, 1_000_000_007)


def _run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All result tables of one run, one below the other, each with its own columns."""
    folder = Scratch(spark, "run-all").folder
    conditions = replace(DEFAULT, page_flow=PAGE_FLOW, raw_json=DEFAULT.to_json())
    run_all(
        shop.visit_actions(spark, sf_dir, conditions),
        shop.user_info(spark, sf_dir),
        conditions,
        folder_sink(folder),
        RUN_ID,
    )
    tables = [
        spark.read.parquet(f"{folder}/{name}").withColumn("result_table", F.lit(name))
        for name in RESULT_TABLES
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _page_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_conversion(_filtered(spark, sf_dir), PAGE_FLOW, RUN_ID)


def _loose_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions as a careless writer leaves them: pages as text, errors without a number or a time."""
    error = F.col("search_keyword").isNull() & (F.col("click_category_id") == -1)
    odd = error & F.col("order_category_ids").isNull() & F.col("pay_category_ids").isNull()
    actions = shop.visit_actions(spark, sf_dir)
    bad_page = odd & (F.col("city_id") % 5 == 0)
    bad_time = odd & (F.col("city_id") % 3 == 0)
    page = F.when(bad_page, F.concat(F.lit("p"), "page_id")).otherwise(F.col("page_id").cast("string"))
    time = F.when(bad_time, F.col("date")).otherwise(F.col("action_time"))
    return actions.withColumns({"page_id": page, "action_time": time})


def _rejected_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rejected(_loose_actions(spark, sf_dir), USER_VISIT_ACTION)
    as_came = F.from_json("row_json", "user_id long, session_id string, page_id string, action_time string")
    return found.select("reason", as_came.alias("r")).select("reason", "r.*")


def _accepted_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = accepted(_loose_actions(spark, sf_dir), USER_VISIT_ACTION)
    user_ids = act.matching_users(shop.user_info(spark, sf_dir), EVERYTHING)
    return ses.session_buckets(ses.session_rollup(actions, user_ids))


def _own_table(name: str) -> str:
    """A table name that no other call has, whatever catalog goes with the warehouse."""
    return f"footfall_{name}_{uuid.uuid4().hex}"


def _city_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities with the part of the world that a literal table gives their area."""
    schema = "area string, half string"
    halves = from_rows(spark, HALVES, StructType.fromDDL(schema))
    table = replace_table(halves, _own_table("half"), spark.catalog.currentDatabase())
    return shop.city_info(spark, sf_dir).join(table, "area")


def _replaced_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users from a table that was replaced by those of one gender, and read by the contract."""
    users, name = shop.user_info(spark, sf_dir), _own_table("user_info")
    replace_table(users, name)
    replace_table(users.where("gender = 'F'"), name)
    return read_table(spark, name, USER_INFO)


def _day_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actions by day, read back for the default dates."""
    path = f"{Scratch(spark, 'days').folder}/actions"
    write_days(shop.visit_actions(spark, sf_dir), path)
    return read_days(spark, path).where(DEFAULT.on_actions())


def _day_states(spark: SparkSession, sf_dir: str) -> tuple[DayStates, DataFrame]:
    states = DayStates(spark, Scratch(spark, "day-states").folder)
    states.add(shop.visit_actions(spark, sf_dir))
    return states, act.matching_users(shop.user_info(spark, sf_dir), DEFAULT)


def _rollup_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    states, user_ids = _day_states(spark, sf_dir)
    return states.sessions(DEFAULT, user_ids)


def _counts_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    states, user_ids = _day_states(spark, sf_dir)
    return states.category_counts(DEFAULT, user_ids)


def entry(spark: SparkSession) -> DataFrame:
    """The most active sessions within the hottest categories."""
    return queries()["category_session_top10"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {
        **LLM_QUERIES,
        # Sources, contracts, stamps
        "scan_actions": _on_actions(lambda a: a),
        "scan_users": _on_users(lambda u: u),
        "scan_products": shop.product_info,
        "dim_city": shop.city_info,
        "city_halves": _city_halves,
        "replaced_users": _replaced_users,
        "conform_actions": _on_actions(_conform_actions),
        "preview_limit": _on_actions(lambda a: preview(a, 100, *a.columns)),
        "stamp_run": _on_users(lambda u: stamp_run(u, RUN_ID)),
        "rejected_actions": _rejected_actions,
        "accepted_session_buckets": _accepted_stats,
        "day_layout": _day_layout,
        # Filters and the join
        "filter_date_range": lambda spark, sf_dir: shop.visit_actions(
            spark, sf_dir, DEFAULT
        ).where(DEFAULT.on_actions()),
        "filter_age_range": _on_users(lambda u: u.where(DEFAULT.on_users())),
        "filter_profession_in": _on_users(
            lambda u: u.where(Conditions(professionals=TWO_PROFESSIONS).on_users())
        ),
        "join_actions_users": lambda spark, sf_dir: _filtered(spark, sf_dir, EVERYTHING),
        "filter_composed": _filtered,
        "filter_composed_profession": lambda spark, sf_dir: _filtered(
            spark,
            sf_dir,
            Conditions("2024-01-05", None, None, 50, TWO_PROFESSIONS),
        ),
        "filter_click": _on_actions(lambda a: a.where(is_click())),
        "filter_order": _on_actions(lambda a: a.where(is_order())),
        "filter_pay": _on_actions(lambda a: a.where(is_pay())),
        # What an action is
        "classify_category_action": _on_actions(
            lambda a: a.select(
                "session_id", "action_time", "page_id", category_kind().alias("kind")
            )
        ),
        "classify_product_action": _on_actions(act.product_events),
        "explode_categories": _on_actions(act.category_events),
        # Sessions
        "session_rollup": _on_sessions(lambda s: s),
        "session_rollup_shuffled": _shuffled_rollup,
        "session_rollup_filtered": _filtered_rollup,
        "session_rollup_nearly_filtered": _nearly_filtered,
        "session_rollup_from_days": _rollup_from_days,
        "session_count": _on_sessions(
            lambda s: s.agg(F.count(F.lit(1)).alias("session_count"))
        ),
        "session_time_bounds": _on_joined(
            lambda a: ses.session_bounds(a).select(
                "session_id",
                (epoch_seconds(F.col("first_at")) * 1000).alias("first_ms"),
                (epoch_seconds(F.col("last_at")) * 1000).alias("last_ms"),
            )
        ),
        "session_visit_length": _on_sessions(lambda s: s.select("session_id", "visit_length")),
        "session_step_length": _on_sessions(lambda s: s.select("session_id", "step_length")),
        "session_visit_bucket": _on_sessions(
            lambda s: s.select("session_id", ses.visit_bucket().alias("bucket"))
        ),
        "session_step_bucket": _on_sessions(
            lambda s: s.select("session_id", ses.step_bucket().alias("bucket"))
        ),
        "session_day_hour": _on_sessions(lambda s: s.select("session_id", "day_hour")),
        "session_bucket_counts": _on_sessions(ses.session_buckets),
        "session_stats": lambda spark, sf_dir: session_stats(
            _sessions(spark, sf_dir, DEFAULT), DEFAULT, RUN_ID
        ),
        "session_action_lists": _on_joined(
            lambda a: ses.session_info(a).select(
                "session_id",
                "search_keywords",
                "click_product_ids",
                "order_product_ids",
                "pay_product_ids",
            )
        ),
        "session_info": _on_joined(ses.session_info),
        "session_info_parts": _on_joined(lambda a: session_info_parts(a, 4)),
        "page_conversion": _page_conversion,
        "sessions_per_hour": _on_sessions(ses.sessions_per_hour),
        # Sampling
        "hour_quota": _on_sessions(
            lambda s: smp.hour_quota(smp.hour_hash_histogram(s)).drop("cutoff_bits")
        ),
        "uniform_sample": _on_sessions(lambda s: smp.uniform_sample(s, "session_id", 100)),
        "session_extract": lambda spark, sf_dir: session_extract(
            _filtered(spark, sf_dir), RUN_ID
        ),
        "session_extract_small": lambda spark, sf_dir: _extract(
            spark, sf_dir, sample_size=200, seed=7
        ),
        "session_extract_given": _extract,
        "session_extract_exact": lambda spark, sf_dir: _extract(
            spark, sf_dir, allocation=smp.EXACT
        ),
        # Categories
        "category_action_counts": _on_joined(
            lambda a: cat.category_action_counts(act.category_events(a))
        ),
        "category_pivot": _on_joined(lambda a: cat.category_counts(act.category_events(a))),
        "category_counts_from_days": _counts_from_days,
        "category_top10": _category_top10,
        "filter_top_category_clicks": _on_joined(
            lambda a: cat.clicks_in_categories(a, _top(a))
        ),
        "category_session_counts": _on_joined(
            lambda a: cat.category_session_counts(cat.clicks_in_categories(a, _top(a)))
        ),
        "category_session_top10": _category_session_top10,
        "category_top_sessions_large": _on_joined(_many_sessions_per_category),
        # Everything
        "run_all": _run_all,
    }


# The given tables as the clickstream tables, in DuckDB's dialect.
_TABLES = """
WITH raw AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         strftime(ts, '%Y-%m-%d') AS day
  FROM events
), user_visit_action AS (
  SELECT day AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || day AS session_id,
         event_id % 50 + 1 AS page_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE event_type WHEN 'view' THEN 'kw_' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
         CASE event_type WHEN 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE event_type WHEN 'click' THEN k % 100 + 1 ELSE -1 END AS click_product_id,
         CASE event_type WHEN 'signup' THEN
           CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 7) % 20 + 1 AS VARCHAR)
         END AS order_category_ids,
         CASE event_type WHEN 'signup' THEN
           CAST(k % 100 + 1 AS VARCHAR) || ',' || CAST((k + 13) % 100 + 1 AS VARCHAR)
         END AS order_product_ids,
         CASE event_type WHEN 'purchase' THEN CAST(k % 20 + 1 AS VARCHAR) END AS pay_category_ids,
         CASE event_type WHEN 'purchase' THEN CAST(k % 100 + 1 AS VARCHAR) END AS pay_product_ids,
         event_id % 25 AS city_id
  FROM raw
), user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(10 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer
), kept AS (
  SELECT v.* FROM user_visit_action v JOIN user_info u ON v.user_id = u.user_id
  {where}
), timed AS (
  SELECT *, CAST(epoch(strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS BIGINT) * 1000 AS ms
  FROM kept
), sessions AS (
  SELECT session_id, min(action_time) AS start_time,
         split_part(min(action_time), ':', 1) AS day_hour,
         max(ms) - min(ms) AS visit_length, count(*) AS step_length
  FROM timed GROUP BY session_id
), hours AS (
  SELECT day_hour, count(*) AS session_count, (SELECT count(*) FROM sessions) AS total
  FROM sessions GROUP BY day_hour
), listed AS (
  SELECT session_id, action_time,
         CASE WHEN search_keyword IS NOT NULL THEN 'keyword'
              WHEN click_product_id <> -1 THEN 'click'
              WHEN order_product_ids IS NOT NULL THEN 'order'
              WHEN pay_product_ids IS NOT NULL THEN 'pay' END AS kind,
         coalesce(search_keyword,
                  CAST(nullif(click_product_id, -1) AS VARCHAR),
                  order_product_ids, pay_product_ids) AS value
  FROM {listed_from}
), lists AS (
  SELECT session_id,
    coalesce(string_agg(value, ',' ORDER BY action_time, value)
             FILTER (WHERE kind = 'keyword'), '') AS search_keywords,
    coalesce(string_agg(value, ',' ORDER BY action_time, value)
             FILTER (WHERE kind = 'click'), '') AS click_product_ids,
    coalesce(string_agg(value, ',' ORDER BY action_time, value)
             FILTER (WHERE kind = 'order'), '') AS order_product_ids,
    coalesce(string_agg(value, ',' ORDER BY action_time, value)
             FILTER (WHERE kind = 'pay'), '') AS pay_product_ids
  FROM listed GROUP BY session_id
), touched AS (
  SELECT session_id, 'click' AS kind, CAST(click_category_id AS VARCHAR) AS category_id
  FROM {touched_from} WHERE click_category_id <> -1
  UNION ALL
  SELECT session_id, 'order', unnest(string_split(order_category_ids, ','))
  FROM {touched_from} WHERE click_category_id = -1 AND order_category_ids <> ''
  UNION ALL
  SELECT session_id, 'pay', unnest(string_split(pay_category_ids, ','))
  FROM {touched_from}
  WHERE click_category_id = -1 AND coalesce(order_category_ids, '') = '' AND pay_category_ids <> ''
), events_by_category AS (
  SELECT * FROM touched WHERE trim(category_id) <> ''
), pivoted AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM events_by_category GROUP BY category_id
), top10 AS (
  SELECT * FROM pivoted
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
), top_clicks AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, session_id FROM kept
  WHERE CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM top10)
), top_counts AS (
  SELECT category_id, session_id, count(*) AS click_count
  FROM top_clicks GROUP BY category_id, session_id
)
"""

_ROUNDED_QUOTAS = """
, quotas AS (
  SELECT day_hour, least(
    CAST(floor(CAST(session_count AS DOUBLE) / total * {size}.0::DOUBLE + 0.5) AS BIGINT),
    session_count) AS quota
  FROM hours
)"""

_EXACT_QUOTAS = """
, floors AS (
  SELECT day_hour, least({size}, total) AS size,
         session_count * least({size}, total) // total AS low,
         session_count * least({size}, total) % total AS remainder
  FROM hours
), quotas AS (
  SELECT day_hour, low + CASE WHEN row_number() OVER (ORDER BY remainder DESC, day_hour)
           <= size - sum(low) OVER () THEN 1 ELSE 0 END AS quota
  FROM floors
)"""

_EXTRACT = """
, ranked AS (
  SELECT s.*, row_number() OVER (
    PARTITION BY day_hour ORDER BY md5(session_id || ':{seed}'), session_id) AS place
  FROM sessions s
)
SELECT '{run}' AS "taskId", session_id AS "sessionId", start_time AS "startTime",
       step_length AS "stepLength", visit_length AS "visitLength",
       search_keywords AS "searchKeyWords", click_product_ids AS "clickProductIds",
       order_product_ids AS "orderProductIds", pay_product_ids AS "payProductIds"
FROM ranked JOIN quotas USING (day_hour) JOIN lists USING (session_id)
WHERE place <= quota
"""

_STATS = """
, counted AS (
  SELECT count(*) AS n,
         sum(CASE WHEN visit_length > 10000 THEN 1 ELSE 0 END) AS visit_gt,
         sum(CASE WHEN visit_length > 10000 THEN 0 ELSE 1 END) AS visit_le,
         sum(CASE WHEN step_length > 5 THEN 1 ELSE 0 END) AS step_gt,
         sum(CASE WHEN step_length > 5 THEN 0 ELSE 1 END) AS step_le
  FROM sessions
)
SELECT '{run}' AS task_id, '{conditions}' AS condition_json, n AS session_count,
       floor(1000.0::DOUBLE * visit_gt / n + 0.5) / 10.0::DOUBLE AS visit_length_gt_10_ratio,
       floor(1000.0::DOUBLE * visit_le / n + 0.5) / 10.0::DOUBLE AS visit_length_le_10_ratio,
       floor(1000.0::DOUBLE * step_gt / n + 0.5) / 10.0::DOUBLE AS step_length_gt_5_ratio,
       floor(1000.0::DOUBLE * step_le / n + 0.5) / 10.0::DOUBLE AS step_length_le_5_ratio
FROM counted
"""

_TOP_SESSIONS = f"""SELECT '{RUN_ID}' AS "taskId", category_id AS "categoryId",
            session_id AS "sessionId", click_count AS "clickCount"
            FROM top_counts
            QUALIFY row_number() OVER (
              PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 10"""

_CONVERSION = f"""
, steps AS (
  SELECT page_id, lead(page_id) OVER (
    PARTITION BY session_id ORDER BY action_time, page_id) AS next_page FROM kept
), flow AS (
  SELECT unnest(range(1, {len(PAGE_FLOW)}))::INTEGER AS step
), flow_pages AS (
  SELECT step, ({list(PAGE_FLOW)})[step]::BIGINT AS from_page,
         ({list(PAGE_FLOW)})[step + 1]::BIGINT AS to_page FROM flow
), converted AS (
  SELECT step, from_page, to_page, count(page_id) AS views,
         count(*) FILTER (WHERE next_page = to_page) AS conversions
  FROM flow_pages LEFT JOIN steps ON page_id = from_page GROUP BY step, from_page, to_page
), conversion AS (
  SELECT '{RUN_ID}' AS "taskId", step, from_page, to_page, views, conversions,
         CASE WHEN views > 0 THEN floor(1000.0::DOUBLE * conversions / views + 0.5) / 10.0::DOUBLE END
           AS conversion_rate
  FROM converted
)"""

# The loose actions: which rows were spoilt, and how.
_LOOSE = """
, loose AS (
  SELECT *, city_id % 5 = 0 AS bad_page, city_id % 3 = 0 AS bad_time,
         search_keyword IS NULL AND click_category_id = -1 AND order_category_ids IS NULL
           AND pay_category_ids IS NULL AS odd
  FROM user_visit_action
)"""

# Each value's place in its list and the characters before it; parts begin at every fourth.
_PARTS = """
, valued AS (
  SELECT session_id, kind, value,
         row_number() OVER own - 1 AS entry, sum(length(value) + 1) OVER own - length(value) - 1 AS before
  FROM listed WHERE kind IS NOT NULL
  WINDOW own AS (PARTITION BY session_id, kind ORDER BY action_time, value
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), parts AS (
  SELECT session_id, kind, before // 4 AS bin, min(entry) AS first_entry, count(*) AS entries,
         string_agg(value, ',' ORDER BY entry) AS list_part
  FROM valued GROUP BY session_id, kind, bin
)"""

_PRODUCTS = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS extend_info FROM part
"""

_CITIES = """
SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
FROM nation JOIN region ON n_regionkey = r_regionkey
"""


_DEFAULT_WHERE = """
  WHERE v.date BETWEEN '2024-01-05' AND '2024-01-20' AND u.age BETWEEN 20 AND 50
"""


def _sql(select: str, base: str = "kept", where: str = _DEFAULT_WHERE) -> str:
    tables = _TABLES.replace("{listed_from}", base).replace("{touched_from}", base)
    return tables.replace("{where}", where) + select


def _extract_sql(size: int, seed: int, quotas: str = _ROUNDED_QUOTAS) -> str:
    return _sql((quotas + _EXTRACT).format(run=RUN_ID, size=size, seed=seed))


def _all_sql(select: str) -> str:
    """Over the actions of all users that there are."""
    return _sql(select, where="")


def _run_all_sql() -> str:
    """The result tables by name, each as a query over what comes before it."""
    ctes = _ROUNDED_QUOTAS.format(size=1000) + _CONVERSION
    extract = _EXTRACT.format(run=RUN_ID, size=1000, seed=42)
    stats = _STATS.replace("{run}", RUN_ID).replace("{conditions}", DEFAULT.to_json())
    selects = {
        "session_stat_info": stats,
        "random_session_info": extract,
        "category_top10": f"""SELECT '{RUN_ID}' AS "taskId", * FROM top10""",
        "category_top10_session_count": _TOP_SESSIONS,
        "page_convert_rate": "SELECT * FROM conversion",
    }
    # The two that bring CTEs of their own put them before.
    for name in ("session_stat_info", "random_session_info"):
        head, _, tail = selects[name].partition("\n)\nSELECT")
        ctes, selects[name] = ctes + head + "\n)", "SELECT" + tail
    union = "\nUNION ALL BY NAME\n".join(
        f"SELECT '{name}' AS result_table, * FROM ({select})" for name, select in selects.items()
    )
    return _sql(ctes + union)


def oracle_sql() -> dict[str, str]:
    every = "user_visit_action"
    order = ", ".join(f"{f.name} NULLS FIRST" for f in USER_VISIT_ACTION)
    return {
        **LLM_SQL,
        "scan_actions": _sql(f"SELECT * FROM {every}"),
        "scan_users": _sql("SELECT * FROM user_info"),
        "scan_products": _PRODUCTS,
        "dim_city": _CITIES,
        "city_halves": f"""SELECT area, city_id, city_name, half FROM ({_CITIES})
            JOIN (VALUES {", ".join(map(str, HALVES))}) AS halves(area, half) USING (area)""",
        "replaced_users": _sql("SELECT * FROM user_info WHERE gender = 'F'"),
        "conform_actions": _sql(f"SELECT * FROM {every}"),
        "preview_limit": _sql(f"SELECT * FROM {every} ORDER BY {order} LIMIT 100"),
        "stamp_run": _sql(f"""SELECT '{RUN_ID}' AS "taskId", * FROM user_info"""),
        "filter_date_range": _sql(
            f"SELECT * FROM {every} WHERE date >= '2024-01-05' AND date <= '2024-01-20'"
        ),
        "filter_age_range": _sql("SELECT * FROM user_info WHERE age >= 20 AND age <= 50"),
        "filter_profession_in": _sql(
            "SELECT * FROM user_info WHERE professional IN ('AUTOMOBILE', 'BUILDING')"
        ),
        "join_actions_users": _sql(
            f"SELECT v.* FROM {every} v, user_info u WHERE v.user_id = u.user_id"
        ),
        "filter_composed": _sql("SELECT * FROM kept"),
        "filter_composed_profession": _sql(
            f"""SELECT v.* FROM {every} v JOIN user_info u ON v.user_id = u.user_id
            WHERE date >= '2024-01-05' AND age <= 50
              AND professional IN ('AUTOMOBILE', 'BUILDING')"""
        ),
        "filter_click": _sql(f"SELECT * FROM {every} WHERE click_category_id <> -1"),
        "filter_order": _sql(f"SELECT * FROM {every} WHERE order_category_ids <> ''"),
        "filter_pay": _sql(f"SELECT * FROM {every} WHERE pay_category_ids <> ''"),
        "classify_category_action": _sql(
            f"""SELECT session_id, action_time, page_id,
            CASE WHEN click_category_id <> -1 THEN 'click'
                 WHEN coalesce(order_category_ids, '') <> '' THEN 'order'
                 WHEN coalesce(pay_category_ids, '') <> '' THEN 'pay' END AS kind
            FROM {every}"""
        ),
        "classify_product_action": _sql("SELECT * FROM listed", every),
        "explode_categories": _sql("SELECT * FROM events_by_category", every),
        "session_rollup": _all_sql("SELECT * FROM sessions"),
        "session_rollup_shuffled": _all_sql("SELECT * FROM sessions"),
        "session_count": _all_sql("SELECT count(DISTINCT session_id) AS session_count FROM kept"),
        "session_time_bounds": _all_sql(
            """SELECT session_id, min(ms) AS first_ms, max(ms) AS last_ms
            FROM timed GROUP BY session_id"""
        ),
        "session_visit_length": _all_sql("SELECT session_id, visit_length FROM sessions"),
        "session_step_length": _all_sql(
            "SELECT session_id, count(*) AS step_length FROM kept GROUP BY session_id"
        ),
        "session_visit_bucket": _all_sql(
            """SELECT session_id, CASE WHEN visit_length <= 10000 THEN 'le' ELSE 'gt' END AS bucket
            FROM sessions"""
        ),
        "session_step_bucket": _all_sql(
            """SELECT session_id, CASE WHEN step_length <= 5 THEN 'le' ELSE 'gt' END AS bucket
            FROM sessions"""
        ),
        "session_day_hour": _all_sql(
            """SELECT session_id, strftime(min(strptime(action_time, '%Y-%m-%d %H:%M:%S')),
            '%Y-%m-%d %H') AS day_hour FROM kept GROUP BY session_id"""
        ),
        "session_bucket_counts": _all_sql(
            """SELECT count(*) AS session_count,
            count(*) FILTER (WHERE visit_length > 10000) AS visit_length_gt_10_count,
            count(*) FILTER (WHERE visit_length <= 10000) AS visit_length_le_10_count,
            count(*) FILTER (WHERE step_length > 5) AS step_length_gt_5_count,
            count(*) FILTER (WHERE step_length <= 5) AS step_length_le_5_count
            FROM sessions"""
        ),
        "session_stats": _sql(
            _STATS.replace("{run}", RUN_ID).replace("{conditions}", DEFAULT.to_json())
        ),
        "session_action_lists": _all_sql("SELECT * FROM lists"),
        "session_info": _all_sql("SELECT * FROM sessions JOIN lists USING (session_id)"),
        "session_info_parts": _all_sql(
            _PARTS
            + """SELECT session_id, kind,
            row_number() OVER (PARTITION BY session_id, kind ORDER BY bin) - 1 AS part,
            first_entry, entries, list_part FROM parts"""
        ),
        "session_rollup_filtered": _sql("SELECT * FROM sessions"),
        "session_rollup_nearly_filtered": _sql("SELECT * FROM sessions"),
        "session_rollup_from_days": _sql("SELECT * FROM sessions"),
        "page_conversion": _sql(_CONVERSION + "SELECT * FROM conversion"),
        "rejected_actions": _sql(
            _LOOSE
            + """SELECT concat_ws('; ', CASE WHEN bad_page THEN 'page_id is no bigint' END,
              CASE WHEN bad_time THEN 'action_time is not yyyy-MM-dd HH:mm:ss' END) AS reason,
            user_id, session_id,
            CASE WHEN bad_page THEN 'p' ELSE '' END || page_id AS page_id,
            CASE WHEN bad_time THEN date ELSE action_time END AS action_time
            FROM loose WHERE odd AND (bad_page OR bad_time)"""
        ),
        "accepted_session_buckets": _sql(
            _LOOSE
            + """, good AS (
              SELECT session_id, epoch(strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS s
              FROM loose JOIN user_info USING (user_id) WHERE NOT (odd AND (bad_page OR bad_time))
            ), ends AS (
              SELECT 1000 * (max(s) - min(s)) AS ms, count(*) AS n FROM good GROUP BY session_id)
            SELECT count(*) AS session_count,
              count(*) FILTER (WHERE ms > 10000) AS visit_length_gt_10_count,
              count(*) FILTER (WHERE ms <= 10000) AS visit_length_le_10_count,
              count(*) FILTER (WHERE n > 5) AS step_length_gt_5_count,
              count(*) FILTER (WHERE n <= 5) AS step_length_le_5_count FROM ends"""
        ),
        "day_layout": _sql(
            f"SELECT * FROM {every} WHERE date BETWEEN '2024-01-05' AND '2024-01-20'"
        ),
        "category_counts_from_days": _sql("SELECT * FROM pivoted"),
        "run_all": _run_all_sql(),
        "sessions_per_hour": _all_sql("SELECT day_hour, session_count FROM hours"),
        "hour_quota": _all_sql(
            """SELECT day_hour, session_count, least(session_count, CAST(floor(
            CAST(session_count AS DOUBLE) / total * 1000.0::DOUBLE + 0.5) AS BIGINT)) AS quota
            FROM hours"""
        ),
        "uniform_sample": _all_sql(
            """SELECT * FROM sessions
            ORDER BY md5(session_id || ':42'), session_id LIMIT 100"""
        ),
        "session_extract": _extract_sql(1000, 42),
        "session_extract_small": _extract_sql(200, 7),
        "session_extract_given": _extract_sql(1000, 42),
        "session_extract_exact": _extract_sql(1000, 42, _EXACT_QUOTAS),
        "category_action_counts": _all_sql(
            """SELECT category_id, kind, count(*) AS action_count
            FROM events_by_category GROUP BY category_id, kind"""
        ),
        "category_pivot": _all_sql("SELECT * FROM pivoted"),
        "category_top10": _sql(f"""SELECT '{RUN_ID}' AS "taskId", * FROM top10"""),
        "filter_top_category_clicks": _all_sql("SELECT * FROM top_clicks"),
        "category_session_counts": _all_sql("SELECT * FROM top_counts"),
        "category_top_sessions_large": _all_sql(
            """SELECT * FROM top_counts
            QUALIFY row_number() OVER (
              PARTITION BY category_id ORDER BY click_count DESC, session_id) <= 2000"""
        ),
        "category_session_top10": _sql(_TOP_SESSIONS),
    }
