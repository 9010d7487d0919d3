"""What the executed plans look like."""

import re

import pytest

import __spark_entry__ as contract
from footfall.conditions import Conditions
from footfall.operators.actions import category_events, filtered_actions
from footfall.operators.categories import (
    category_counts,
    category_counts_of_users,
    category_session_counts_of_users,
    clicks_in_categories,
    top_categories,
    top_sessions,
)
from footfall.operators.sessions import session_info, session_rollup
from footfall.schema import USER_INFO, USER_VISIT_ACTION
from footfall.sources.tables import read_parquet

from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The clickstream tables as files of their own."""
    from footfall.sources import shop_tables

    folder = tmp_path_factory.mktemp("stored")
    shop_tables.visit_actions(spark, SF_DIR).write.parquet(f"{folder}/actions")
    shop_tables.user_info(spark, SF_DIR).write.parquet(f"{folder}/users")
    return (
        read_parquet(spark, f"{folder}/actions", USER_VISIT_ACTION),
        read_parquet(spark, f"{folder}/users", USER_INFO),
    )


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.LLM_QUERIES)))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert node not in text


def test_filters_and_columns_reach_the_files(stored):
    actions, users = stored
    conditions = Conditions("2018-11-01", "2018-12-28", 20, 50, ("a", "b"))
    text = plan(session_rollup(filtered_actions(actions, users, conditions)))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(date,2018-11-01\)", text)
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(date,2018-12-28\)", text)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(age,20\)", text)
    assert re.search(r"PushedFilters: \[[^\]]*In\(professional, \[a,b\]\)", text)
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert "date:string,user_id:bigint,session_id:string,action_time:string" in schemas


def test_given_tables_are_pruned_by_time(spark):
    text = plan(contract.queries()["filter_composed"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-05" in text
    assert "LessThan(ts,2024-01-21" in text


def test_top_lists_are_cut_in_the_map_tasks(spark):
    text = plan(contract.queries()["category_session_top10"](spark, SF_DIR))
    assert "TakeOrderedAndProject(limit=10" in text
    assert text.count("WindowGroupLimit") >= 2
    assert re.search(r"BroadcastHashJoin .*LeftSemi", text)


def test_category_filters_move_below_the_user_join(spark, stored):
    """With no broadcast of users, only rows that count are shuffled for them."""
    kept = filtered_actions(*stored, Conditions())
    top = top_categories(category_counts(category_events(kept)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "500")
    try:
        clicks = plan(clicks_in_categories(kept, top))
        events = plan(category_events(kept))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert clicks.index("SortMergeJoin [user_id") < clicks.index("LeftSemi, BuildRight")
    below = events[events.index("SortMergeJoin [user_id") :]
    assert re.search(r"Filter .*CASE WHEN NOT \(click_category_id", below)


def test_counts_combine_before_the_shuffle(stored):
    actions, users = stored
    text = plan(session_rollup(filtered_actions(actions, users, Conditions())))
    assert "partial_min" in text and "partial_count" in text
    assert "SortAggregate" not in text


def executed_nodes(node):
    """Nodes that really ran: through stages and subqueries, not into reused ones."""
    kind = node.getClass().getSimpleName()
    yield kind, node
    if kind == "AdaptiveSparkPlanExec":
        below = [node.executedPlan()]
    elif kind.endswith("QueryStageExec"):
        below = [node.plan()]
    elif kind in ("ReusedExchangeExec", "ReusedSubqueryExec"):
        below = []
    else:
        both = (node.children(), node.subqueries())
        below = [seq.apply(i) for seq in both for i in range(seq.size())]
    for child in below:
        yield from executed_nodes(child)


def test_lists_are_collected_per_session_and_minute(stored):
    """A very long session is spread over tasks until its text is joined."""
    actions, users = stored
    text = plan(session_info(filtered_actions(actions, users, Conditions())))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    keys = [re.sub(r"#\d+L?", "", keys) for keys in exchanges]
    assert [key for key in keys if key.startswith("session_id")] == [
        "session_id, 8",
        "session_id, minute, 8",
    ]


def test_sample_scans_the_actions_twice_only(spark):
    """Once to count hours, once to build the lists of the candidates."""
    frame = contract.queries()["session_extract"](spark, SF_DIR)
    frame.collect()
    nodes = list(executed_nodes(frame._jdf.queryExecution().executedPlan()))
    scans = [
        node.simpleString(50) for kind, node in nodes if kind == "FileSourceScanExec"
    ]
    assert sum("ts#" in scan for scan in scans) == 2
    assert sum("props#" in scan for scan in scans) == 1


def test_hot_user_is_split(spark):
    """A third of all rows belong to one user and the users are not broadcast."""
    spread = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("user_id"),
        F.lit("2018-11-26").alias("date"),
        F.concat(F.lit("s"), (F.col("id") / 9).cast("bigint").cast("string")).alias("session_id"),
        F.lit("2018-11-26 09:00:00").alias("action_time"),
    )
    users = spark.range(0, 5000).select(
        F.col("id").alias("user_id"), F.lit(30).alias("age"), F.lit("a").alias("professional")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rollup = session_rollup(filtered_actions(spread, users, Conditions()))
        totals = rollup.agg(F.count(F.lit(1)).alias("n"), F.sum("step_length").alias("steps"))
        assert tuple(totals.first()) == (33_334, 300_000)
        totals.collect()
        assert "SortMergeJoin(skew=true)" in plan(totals)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_hot_category_sends_few_rows(spark):
    counts = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 50).cast("string")).alias(
            "category_id"
        ),
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("session_id"),
        (F.col("id") % 1000).alias("click_count"),
    )
    best = top_sessions(counts)
    assert best.groupBy("category_id").count().agg(F.max("count")).first()[0] == 10
    brute = sorted(
        (-row.click_count, row.session_id) for row in counts.where("category_id = '1'").collect()
    )[:10]
    found = best.where("category_id = '1'").collect()
    assert sorted((-row.click_count, row.session_id) for row in found) == brute


def test_counting_stands_below_the_user_join(spark, stored):
    """With users not broadcast, counts cross the user exchange and no id list does."""
    actions, users = stored
    user_ids = users.select("user_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = plan(category_counts_of_users(actions, user_ids))
        top = top_categories(category_counts_of_users(actions, user_ids))
        sessions = plan(category_session_counts_of_users(actions, top, user_ids))
        clicks = plan(clicks_in_categories(actions, top))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (counts, sessions):
        below = text[text.index("Join [user_id") :]
        assert "partial_count(1)" in below
        for line in below.splitlines():
            if "Exchange hashpartitioning(user_id" in line:
                assert "category_ids" not in line
    assert "Not(EqualTo(click_category_id,-1))" in clicks
    assert re.search(r"Join \[click_category_id#\d+L\], \[id#\d+L\], LeftSemi", clicks)
