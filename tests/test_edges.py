"""One test per edge of the semantics."""

import json

import pytest
from builders import action, actions_frame, click, order, pay, rows, search, users_frame

from footfall.conditions import Conditions
from footfall.functions import (
    action_moment,
    category_kind,
    epoch_seconds,
    half_up,
    moment_text,
    product_kind,
    split_ids,
)
from footfall.operators.actions import category_events, filtered_actions, product_events
from footfall.operators.categories import (
    category_counts,
    category_counts_of_users,
    category_session_counts,
    category_session_counts_of_users,
    clicks_in_categories,
    top_categories,
    top_sessions,
)
from footfall.operators.sampling import stratified_sessions, uniform_sample
from footfall.operators.sessions import (
    session_buckets,
    session_info,
    session_ratios,
    session_rollup,
)
from footfall.schema import USER_VISIT_ACTION, conform

from pyspark.sql import functions as F

NOON = "2018-11-26 12:00:00"


def at(second):
    return f"2018-11-26 12:{second // 60:02d}:{second % 60:02d}"


def steps(session_id, count, seconds_apart=1, user_id=1):
    return [click(session_id, user_id, at(i * seconds_apart), 1) for i in range(count)]


# Conditions


@pytest.mark.parametrize("blank", [None, "", "  "])
def test_blank_condition_does_not_filter(spark, blank):
    keys = ("startDate", "endDate", "startAge", "endAge", "professionals")
    conditions = Conditions.from_dict(dict.fromkeys(keys, blank))
    assert conditions == Conditions()
    kept = filtered_actions(
        actions_frame(spark, [click("s", 1, NOON, 1)]),
        users_frame(spark, [(1, 5, "any")]),
        conditions,
    )
    assert kept.count() == 1


def test_absent_keys_and_empty_list_do_not_filter():
    assert Conditions.from_dict({}) == Conditions()
    assert Conditions.from_dict({"professionals": []}) == Conditions()


def test_condition_text_forms():
    text = json.dumps(
        {"startDate": "2018-11-01", "endAge": "50", "professionals": "'a', 'b c'", "city": ""}
    )
    conditions = Conditions.from_json(text)
    assert conditions.start_date == "2018-11-01"
    assert conditions.end_age == 50
    assert conditions.professionals == ("a", "b c")
    assert conditions.to_json() == text


@pytest.mark.parametrize(
    "text, names",
    [
        ("a,b", ("a", "b")),
        ("'a', 'b'", ("a", "b")),
        ("'a, b','it''s'", ("a, b", "it's")),
        ('"a, b",c', ("a, b", "c")),
        (",", ()),
    ],
)
def test_profession_text(text, names):
    assert Conditions.from_dict({"professionals": text}).professionals == names


def test_condition_values_are_not_sql(spark):
    tricky = "x' or '1'='1"
    users = users_frame(spark, [(1, 30, tricky), (2, 30, "other")])
    kept = users.where(Conditions(professionals=(tricky,)).on_users())
    assert [row.user_id for row in kept.collect()] == [1]


def test_bounds_are_inclusive(spark):
    actions = actions_frame(
        spark,
        [click("s", u, f"2018-11-{d:02d} 00:00:00", 1) for u in (1, 2, 3, 4) for d in (1, 2, 3, 4)],
    )
    users = users_frame(spark, [(1, 19, "a"), (2, 20, "a"), (3, 50, "a"), (4, 51, "a")])
    kept = filtered_actions(actions, users, Conditions("2018-11-02", "2018-11-03", 20, 50))
    assert rows(kept.select("user_id", "date")) == [
        (2, "2018-11-02"),
        (2, "2018-11-03"),
        (3, "2018-11-02"),
        (3, "2018-11-03"),
    ]


def test_date_bound_cuts_a_session(spark):
    actions = actions_frame(
        spark,
        [click("s", 1, "2018-11-26 23:59:50", 1), click("s", 1, "2018-11-27 00:00:05", 1)],
    )
    users = users_frame(spark, [(1, 30, "a")])
    kept = filtered_actions(actions, users, Conditions(end_date="2018-11-26"))
    session = session_rollup(kept).first()
    assert (session.step_length, session.visit_length) == (1, 0)


# The join


def test_unknown_user_disappears_and_duplicate_user_multiplies(spark):
    actions = actions_frame(spark, [click("a", 1, NOON, 1), click("b", 9, NOON, 1)])
    users = users_frame(spark, [(1, 30, "a"), (1, 31, "a")])
    kept = filtered_actions(actions, users, Conditions())
    assert [row.session_id for row in kept.collect()] == ["a", "a"]
    assert kept.columns == USER_VISIT_ACTION.names


def test_both_rollups_agree(spark):
    actions = actions_frame(
        spark,
        steps("a", 4, user_id=1) + steps("a", 2, user_id=2) + steps("b", 3, user_id=3)
        + steps("c", 1, user_id=9),
    )
    user_ids = users_frame(
        spark, [(1, 30, "a"), (2, 30, "a"), (2, 30, "b"), (3, 30, "a")]
    ).select("user_id")
    plain = session_rollup(actions.join(user_ids, "user_id"))
    combined = session_rollup(actions, user_ids)
    assert combined.columns == plain.columns
    assert rows(combined) == rows(plain)


# What an action is


def test_click_wins_over_order_wins_over_pay(spark):
    both = {"order_category_ids": "2", "pay_category_ids": "3"}
    actions = actions_frame(
        spark,
        [
            action("a", 1, NOON, click_category_id=1, **both),
            action("b", 1, NOON, **both),
            action("c", 1, NOON, order_category_ids="", pay_category_ids="3"),
            action("d", 1, NOON, order_category_ids="", pay_category_ids=""),
        ],
    )
    assert rows(actions.select("session_id", category_kind())) == [
        ("a", "click"),
        ("b", "order"),
        ("c", "pay"),
        ("d", None),
    ]
    assert rows(category_events(actions)) == [
        ("a", "click", "1"),
        ("b", "order", "2"),
        ("c", "pay", "3"),
    ]


def test_keyword_wins_over_click_and_empty_text_counts(spark):
    actions = actions_frame(
        spark,
        [
            action("a", 1, NOON, search_keyword="k", click_product_id=5),
            action("b", 1, NOON, search_keyword="", click_product_id=5),
            action("c", 1, NOON, order_product_ids="", pay_product_ids="3"),
            action("d", 1, NOON, pay_product_ids="3"),
            action("e", 1, NOON),
        ],
    )
    assert rows(product_events(actions).select("session_id", "kind", "value")) == [
        ("a", "keyword", "k"),
        ("b", "keyword", ""),
        ("c", "order", ""),
        ("d", "pay", "3"),
        ("e", None, None),
    ]
    assert product_kind() is not None


@pytest.mark.parametrize(
    "ids, tokens",
    [("3,3", ["3", "3"]), ("1,", ["1"]), (",1", ["1"]), ("1,,2", ["1", "2"]), (",", [])],
)
def test_list_tokens(spark, ids, tokens):
    frame = spark.createDataFrame([(ids,)], "ids string")
    assert frame.select(split_ids(F.col("ids")).alias("t")).first().t == tokens


def test_list_of_blanks_is_an_order_of_nothing(spark):
    actions = actions_frame(
        spark, [action("a", 1, NOON, order_category_ids=",", pay_category_ids="3")]
    )
    assert rows(category_events(actions)) == []


# Categories


def test_category_with_payments_only(spark):
    actions = actions_frame(spark, [pay("a", 1, NOON, "8"), order("a", 1, NOON, "3,3")])
    counts = category_counts(category_events(actions))
    assert rows(counts) == [("3", 0, 2, 0), ("8", 0, 0, 1)]


def test_top_has_fewer_rows_than_asked_and_breaks_ties(spark):
    counts = spark.createDataFrame(
        [("9", 5, 1, 0), ("10", 5, 1, 0), ("2", 5, 1, 1), ("1", 5, 0, 9), ("7", 6, 0, 0)],
        "category_id string, click_count long, order_count long, pay_count long",
    )
    assert [row[0] for row in top_categories(counts).collect()] == ["7", "2", "10", "9", "1"]
    assert [row[0] for row in top_categories(counts, 3).collect()] == ["7", "2", "10"]


def test_session_id_with_underscore_stays_whole(spark):
    actions = actions_frame(spark, [click("a_b_c", 1, NOON, 3), click("a_b_d", 1, NOON, 3)])
    top = top_categories(category_counts(category_events(actions)))
    best = top_sessions(category_session_counts(clicks_in_categories(actions, top)))
    assert rows(best) == [("3", "a_b_c", 1), ("3", "a_b_d", 1)]


def test_top_category_without_clicks_has_no_sessions(spark):
    actions = actions_frame(spark, [order("a", 1, NOON, "3"), click("a", 1, NOON, 4)])
    top = top_categories(category_counts(category_events(actions)))
    clicks = clicks_in_categories(actions, top)
    assert top.count() == 2
    assert rows(clicks) == [("4", "a")]


def test_top_sessions_per_category_are_bounded_and_ordered(spark):
    counts = spark.createDataFrame(
        [("1", f"s{i:02d}", i // 2) for i in range(30)] + [("2", "only", 1)],
        "category_id string, session_id string, click_count long",
    )
    best = top_sessions(counts, 3)
    assert rows(best) == [("1", "s26", 13), ("1", "s28", 14), ("1", "s29", 14), ("2", "only", 1)]


def test_long_lists_per_category_are_exact(spark):
    """More than Spark cuts in the map tasks: sliced first, same rows."""
    counts = spark.range(0, 6000, 1, 4).selectExpr(
        "IF(id % 3 = 0, '1', '2') AS category_id",
        "concat('s', id) AS session_id",
        "id % 700 AS click_count",
    )
    best = top_sessions(counts, 1500)
    everything = sorted((c, -n, s) for c, s, n in counts.collect())
    expected = [row for c in "12" for row in [r for r in everything if r[0] == c][:1500]]
    assert sorted((c, -n, s) for c, s, n in best.collect()) == expected


# Sessions


def test_exactly_ten_seconds_and_exactly_five_steps(spark):
    actions = actions_frame(
        spark,
        steps("ten", 2, 10) + steps("eleven", 2, 11) + steps("five", 5) + steps("six", 6),
    )
    buckets = session_buckets(session_rollup(actions)).first()
    assert tuple(buckets) == (4, 1, 3, 1, 3)


def test_bucket_never_hit_is_zero(spark):
    ratios = session_ratios(session_buckets(session_rollup(actions_frame(spark, steps("a", 1)))))
    assert tuple(ratios.first()) == (1, 0.0, 100.0, 0.0, 100.0)


def test_no_sessions(spark):
    none = actions_frame(spark, [])
    ratios = session_ratios(session_buckets(session_rollup(none)))
    assert [tuple(row) for row in ratios.collect()] == [(0, None, None, None, None)]
    assert stratified_sessions(none).count() == 0
    assert category_counts(category_events(none)).count() == 0


def test_null_session_ids_form_one_session(spark):
    actions = actions_frame(
        spark, [click(None, 1, at(0), 1), click(None, 2, at(30), 1), click("", 2, at(40), 1)]
    )
    sessions = session_rollup(actions).select("session_id", "step_length", "visit_length")
    assert rows(sessions) == [("", 1, 0), (None, 2, 30000)]
    sample = stratified_sessions(actions).select("session_id", "step_length")
    assert rows(sample) == [("", 1), (None, 2)]


def test_lists_follow_time_then_value_across_minutes(spark):
    actions = actions_frame(
        spark,
        [
            search("a", 1, at(200), "late"),
            search("a", 1, at(10), "b"),
            search("a", 1, at(10), "a"),
            search("a", 1, at(130), ""),
            order("a", 1, at(61), "1", "1,2"),
            order("a", 1, at(59), "1", "3"),
            click("a", 1, at(5), 1, 10),
            click("a", 1, at(5), 1, 9),
            action("a", 1, at(300)),
        ],
    )
    info = session_info(actions).first()
    assert info.search_keywords == "a,b,,late"
    assert info.order_product_ids == "3,1,2"
    assert info.click_product_ids == "10,9"
    assert info.pay_product_ids == ""
    assert (info.step_length, info.visit_length) == (9, 295000)


def test_only_entry_is_an_empty_keyword(spark):
    assert session_info(actions_frame(spark, [search("a", 1, NOON, "")])).first()[
        "search_keywords"
    ] == ""


# Scalars and contracts


@pytest.mark.parametrize("value, whole", [(0.5, 1), (1.4999, 1), (2.5, 3), (-0.5, 0)])
def test_half_up(spark, value, whole):
    frame = spark.range(1).select(half_up(F.lit(value)).alias("x"))
    assert frame.first().x == whole
    assert frame.dtypes == [("x", "bigint")]


@pytest.mark.parametrize(
    "text", ["2018-11-26 09:05:07", "2018-11-26 9:5:7", "2018-11-26 09:05:07.900"]
)
def test_time_round_trip(spark, text):
    moment = action_moment(F.col("t"))
    found = (
        spark.createDataFrame([(text,)], "t string")
        .select(epoch_seconds(moment).alias("s"), moment_text(moment).alias("t"))
        .first()
    )
    assert tuple(found) == (1543223107, "2018-11-26 09:05:07")


def test_no_result_depends_on_the_session_time_zone(spark):
    """The night a New York clock jumps from two to three."""
    actions = actions_frame(
        spark,
        [click("a", 1, f"2024-03-10 {time}", 1) for time in ("01:59:58", "02:30:00", "03:00:05")],
    )
    answers = []
    for zone in ("America/New_York", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        answers.append(rows(session_info(actions)))
    assert answers[0] == answers[1]
    info = session_info(actions).first()
    assert (info.start_time, info.visit_length) == ("2024-03-10 01:59:58", 3_607_000)


def test_malformed_time_raises(spark):
    frame = actions_frame(spark, [click("a", 1, "2018-11-26 nonsense", 1)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        session_rollup(frame).collect()


def test_conform_reorders_casts_and_drops(spark):
    frame = actions_frame(spark, [click("a", 1, NOON, 3)])
    loose = frame.select(
        F.lit(1).alias("extra"),
        F.col("user_id").cast("string").alias("user_id"),
        *[c for c in reversed(frame.columns) if c != "user_id"],
    )
    again = conform(loose, USER_VISIT_ACTION)
    assert again.schema.names == USER_VISIT_ACTION.names
    assert rows(again) == rows(frame)


def test_conform_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="age, gender"):
        from footfall.schema import USER_INFO

        conform(users_frame(spark, []).drop("age", "gender"), USER_INFO)


def test_uniform_sample_larger_than_the_table(spark):
    frame = spark.createDataFrame([("a",), ("b",)], "session_id string")
    assert uniform_sample(frame, "session_id", 10).count() == 2


# Times, conditions and lists as they come


@pytest.mark.parametrize("text", ["2018", "2018-11-26", "2018-11-26 09", "2018-11-26 09:59", "09:59:01", ""])
@pytest.mark.parametrize("read", [session_rollup, session_info])
def test_time_without_all_fields_raises(spark, text, read):
    frame = actions_frame(spark, [{**click("a", 1, NOON, 1), "action_time": text}])
    with pytest.raises(Exception, match="action_time is not"):
        read(frame).collect()


def test_unpadded_times_sort_as_times(spark):
    times = ["2018-11-26 10:05:03", "2018-11-26 9:05:03", "2018-11-26 9:05:2", "2018-11-26 9:59:59 x"]
    words = ["late", "early", "first", "then"]
    frame = actions_frame(spark, [search("a", 1, t, w) for t, w in zip(times, words)])
    info = session_info(frame).first()
    assert info.search_keywords == "first,early,then,late"
    assert (info.start_time, info.visit_length) == ("2018-11-26 09:05:02", 3_601_000)


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_only_times_of_asked_users_can_raise(spark, threshold):
    bad = {**click("a", 1, NOON, 1), "action_time": "garbage"}
    frame = actions_frame(spark, [bad, click("b", 2, NOON, 1)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        ids = users_frame(spark, [(2, 30, "a")]).select("user_id")
        assert [r.session_id for r in session_rollup(frame, ids).collect()] == ["b"]
        ids = users_frame(spark, [(1, 30, "a")]).select("user_id")
        with pytest.raises(Exception, match="action_time is not"):
            session_rollup(frame, ids).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(
    "text, names",
    [
        ("\"farmer's aide\",\"teacher\"", ("farmer's aide", "teacher")),
        ("'a', \"b\", c", ("a", "b", "c")),
        ("farmer's aide,teacher", ("farmer's aide", "teacher")),
        ('"a ""b""",\'c\'', ('a "b"', "c")),
        ('"a, b"', ("a, b",)),
        ("a,,b", ("a", "b")),
    ],
)
def test_each_profession_has_its_own_quotes(text, names):
    assert Conditions.from_dict({"professionals": text}).professionals == names


def test_ages_are_whole_numbers():
    assert Conditions.from_json('{"startAge": 20.0, "endAge": "50.0"}') == Conditions(
        start_age=20, end_age=50, raw_json='{"startAge": 20.0, "endAge": "50.0"}'
    )
    for value in (20.5, "x", "nan", "inf"):
        with pytest.raises(ValueError, match="startAge"):
            Conditions.from_dict({"startAge": value})


def test_counts_of_users_are_those_of_the_join(spark):
    """Users listed twice count twice, unknown ones not at all."""
    actions = actions_frame(
        spark,
        [click("s", u, NOON, c) for u in (1, 2, 3) for c in (5, 5, 6)]
        + [order("t", 2, NOON, "5,6,5"), pay("t", 1, NOON, "6")],
    )
    users = users_frame(spark, [(1, 30, "a"), (2, 30, "a"), (2, 30, "b")]).select("user_id")
    joined = actions.join(users, "user_id")
    counts = category_counts(category_events(joined))
    assert rows(category_counts_of_users(actions, users)) == rows(counts)
    top = top_categories(counts)
    sessions = category_session_counts(clicks_in_categories(joined, top))
    assert rows(category_session_counts_of_users(actions, top, users)) == rows(sessions)


def test_listed_text_that_is_no_click(spark):
    """An id list can name what no click can: other spellings, and the mark of no click."""
    actions = actions_frame(
        spark, [order("a", 1, NOON, "-1,007,x"), click("b", 1, NOON, 7), action("c", 1, NOON)]
    )
    top = top_categories(category_counts(category_events(actions)))
    assert top.count() == 4
    assert rows(clicks_in_categories(actions, top)) == [("7", "b")]
