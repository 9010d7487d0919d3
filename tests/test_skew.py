"""A whole run on skewed actions, against DuckDB over the same files.

A third of the rows belong to one user, a third of the sessions start in one
hour, a twentieth of the rows form one session and a third of the clicks hit one
category.
"""

import duckdb
import pytest

from footfall.conditions import Conditions
from footfall.plans import run_all
from footfall.schema import USER_INFO, USER_VISIT_ACTION, conform
from footfall.sources.tables import read_parquet

CONDITIONS = Conditions("2018-11-01", "2018-12-28", 20, 50)
ROWS = 180_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    steps = spark.range(0, ROWS, 1, 8).selectExpr(
        "id",
        "id div 9 AS s",
        "pmod(xxhash64(id, 1), 90) AS kind",
        "pmod(xxhash64(id, 2), 50) AS pick",
    )
    timed = steps.selectExpr(
        "*",
        "timestamp_ntz'2018-11-02 09:00:00' + make_dt_interval(0, 0, 0, id % 9 * 3 +"
        " IF(s % 3 = 0, s % 3000, pmod(xxhash64(s), 40 * 86400))) AS at",
    )
    actions = timed.selectExpr(
        "substring(string(at), 1, 10) AS date",
        "IF(s % 3 = 1, 7, pmod(xxhash64(s, 3), 2000)) AS user_id",
        "IF(pmod(xxhash64(id, 4), 20) = 0, 'bot', concat('s', s)) AS session_id",
        "id % 50 + 1 AS page_id",
        "substring(string(at), 1, 19) AS action_time",
        "IF(kind < 20, concat('k', pick % 6), NULL) AS search_keyword",
        "IF(kind BETWEEN 20 AND 79, IF(pick < 17, 3, pick), -1) AS click_category_id",
        "IF(kind BETWEEN 20 AND 79, pick * 2, -1) AS click_product_id",
        "IF(kind BETWEEN 80 AND 85, concat(pick, ',', pick + 1), NULL) AS order_category_ids",
        "IF(kind BETWEEN 80 AND 85, concat(pick, ',', pick + 1), NULL) AS order_product_ids",
        "IF(kind > 85, string(pick), NULL) AS pay_category_ids",
        "IF(kind > 85, string(pick), NULL) AS pay_product_ids",
        "id % 26 + 1 AS city_id",
    )
    conform(actions, USER_VISIT_ACTION).write.parquet(f"{folder}/actions")
    users = spark.range(0, 2000).selectExpr(
        "id AS user_id",
        "concat('u', id) AS username",
        "concat('n', id) AS name",
        "IF(id = 7, 30, int(id % 50 + 10)) AS age",
        "'a' AS professional",
        "'M' AS gender",
    )
    conform(users, USER_INFO).write.parquet(f"{folder}/users")
    return folder


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    connection.sql(f"""
        CREATE TABLE kept AS
        SELECT v.*, epoch(strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS s
        FROM read_parquet('{folder}/actions/*.parquet') v
        JOIN read_parquet('{folder}/users/*.parquet') u USING (user_id)
        WHERE date BETWEEN '2018-11-01' AND '2018-12-28' AND age BETWEEN 20 AND 50""")
    connection.sql("""
        CREATE TABLE sessions AS
        SELECT session_id, min(action_time) AS start, split_part(start, ':', 1) AS hour,
               count(*) AS steps, CAST(max(s) - min(s) AS BIGINT) * 1000 AS ms,
               coalesce(string_agg(search_keyword, ',' ORDER BY action_time, search_keyword),
                        '') AS keywords,
               coalesce(string_agg(CAST(click_product_id AS VARCHAR), ','
                        ORDER BY action_time, CAST(click_product_id AS VARCHAR))
                        FILTER (WHERE click_product_id <> -1), '') AS clicks,
               coalesce(string_agg(order_product_ids, ',' ORDER BY action_time, order_product_ids),
                        '') AS orders,
               coalesce(string_agg(pay_product_ids, ',' ORDER BY action_time, pay_product_ids),
                        '') AS pays
        FROM kept GROUP BY session_id""")
    connection.sql("""
        CREATE TABLE touched AS
        SELECT 'click' AS kind, CAST(click_category_id AS VARCHAR) AS category
        FROM kept WHERE click_category_id <> -1
        UNION ALL SELECT 'order', unnest(string_split(order_category_ids, ',')) FROM kept
        UNION ALL SELECT 'pay', pay_category_ids FROM kept WHERE pay_category_ids IS NOT NULL""")
    connection.sql("""
        CREATE TABLE top AS
        SELECT category, count(*) FILTER (WHERE kind = 'click') AS clicks,
               count(*) FILTER (WHERE kind = 'order') AS orders,
               count(*) FILTER (WHERE kind = 'pay') AS pays
        FROM touched GROUP BY category
        ORDER BY clicks DESC, orders DESC, pays DESC, category LIMIT 10""")
    return connection


ANSWERS = {
    "session_stat_info": """
        WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE ms > 10000) AS long,
                          count(*) FILTER (WHERE steps > 5) AS many FROM sessions)
        SELECT n, floor(1000.0::DOUBLE * long / n + 0.5) / 10.0::DOUBLE,
               floor(1000.0::DOUBLE * (n - long) / n + 0.5) / 10.0::DOUBLE,
               floor(1000.0::DOUBLE * many / n + 0.5) / 10.0::DOUBLE,
               floor(1000.0::DOUBLE * (n - many) / n + 0.5) / 10.0::DOUBLE FROM c""",
    "random_session_info": """
        WITH h AS (SELECT hour, count(*) AS n FROM sessions GROUP BY hour),
        q AS (SELECT hour, least(n, CAST(floor(CAST(n AS DOUBLE)
              / (SELECT count(*) FROM sessions) * 1000.0::DOUBLE + 0.5) AS BIGINT)) AS quota FROM h)
        SELECT session_id, start, steps, ms, keywords, clicks, orders, pays
        FROM sessions JOIN q USING (hour)
        QUALIFY row_number() OVER (
          PARTITION BY hour ORDER BY md5(session_id || ':42'), session_id) <= quota""",
    "category_top10": "SELECT * FROM top",
    "category_top10_session_count": """
        SELECT category, session_id, count(*) AS n
        FROM kept JOIN top ON category = CAST(click_category_id AS VARCHAR)
        GROUP BY category, session_id
        QUALIFY row_number() OVER (PARTITION BY category ORDER BY n DESC, session_id) <= 10""",
}


@pytest.mark.parametrize("threshold", ["1KB", "10MB"])
def test_run_on_skewed_actions(spark, folder, duck, threshold):
    delivered = {}

    def sink(frame, table):
        stamps = ("taskId", "task_id", "condition_json")
        delivered[table] = sorted(tuple(row) for row in frame.drop(*stamps).collect())

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": threshold,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": threshold,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        run_all(
            read_parquet(spark, f"{folder}/actions", USER_VISIT_ACTION),
            read_parquet(spark, f"{folder}/users", USER_INFO),
            CONDITIONS,
            sink,
        )
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert list(delivered) == list(ANSWERS)
    for table, sql in ANSWERS.items():
        assert delivered[table] == sorted(duck.sql(sql).fetchall()), table
    assert len(delivered["category_top10_session_count"]) == 100
