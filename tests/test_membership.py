"""The filter over wanted ids: it loses none, and passes few others."""

import pytest
from builders import actions_frame, click, rows, users_frame
from hypothesis import HealthCheck, given, settings, strategies as st
from test_plans import plan

from footfall.operators import membership
from footfall.operators.membership import (
    exact_filter,
    exact_length,
    filter_length,
    id_filter,
    is_in,
    may_be_in,
)
from footfall.operators.sessions import session_rollup
from footfall.plans.run import of_users
from footfall.plans.scratch import Scratch

from pyspark.sql import functions as F

LONGS = st.integers(-(2**63), 2**63 - 1)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(ids=st.lists(LONGS | st.none(), max_size=60), length=st.sampled_from([1, 2, 64, 4096]))
def test_no_wanted_id_is_lost(spark, ids, length):
    frame = spark.createDataFrame([(i,) for i in ids], "id long")
    words = id_filter(frame, "id", length)
    assert len(words.first().words) == length
    found = words.select("words").scalar()
    missed = frame.where("id IS NOT NULL").where(~may_be_in(found, F.col("id")))
    assert missed.collect() == []


@pytest.mark.parametrize("page", [1, 1000, 1 << 10])
def test_few_others_pass(spark, monkeypatch, page):
    monkeypatch.setattr(membership, "_PAGE", page)
    wanted = spark.range(0, 200_000, 1, 8).select((F.col("id") * 7).alias("id"))
    length = filter_length(200_000)
    words = Scratch(spark, "membership").keep(id_filter(wanted, "id", length), f"words{page}")
    found = words.select("words").scalar()
    passed = spark.range(0, 1_400_000, 1, 8).where(may_be_in(found, F.col("id")))
    wrong = passed.where("id % 7 <> 0").count()
    assert passed.where("id % 7 = 0").count() == 200_000
    assert wrong < 0.015 * 1_200_000


@pytest.mark.parametrize(
    "ids, words", [(0, 1), (1, 1), (4, 1), (5, 2), (1000, 256), (2_000_000, 524_288)]
)
def test_length_follows_the_number_of_ids(ids, words):
    assert filter_length(ids) == words
    assert filter_length(ids, most_bytes=words * 8 - 1) is None


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    least=st.sampled_from([-(2**63), -70, 0, 5, 2**63 - 400]),
    steps=st.lists(st.integers(0, 399), min_size=1, max_size=40),
)
def test_exact_filters_are_exact(spark, least, steps):
    ids = [least + s for s in steps]
    frame = spark.createDataFrame([(i,) for i in [*ids, None]], "id long")
    length = exact_length(min(ids), max(ids))
    words = exact_filter(frame, "id", min(ids), length)
    row = words.first()
    assert len(row.words) == length and row.bits_set == len(set(ids))
    asked = [i for i in (*range(least - 3, least + 403), 0, -(2**63), 2**63 - 1) if -(2**63) <= i < 2**63]
    rows_asked = spark.createDataFrame([(i,) for i in [*asked, None]], "id long")
    hit = is_in(words.select("words").scalar(), F.col("id"), min(ids), max(ids))
    assert sorted(r.id for r in rows_asked.where(hit).collect()) == sorted(i for i in asked if i in set(ids))


def test_exact_length():
    assert exact_length(7, 7) == 1 and exact_length(0, 64) == 2
    assert exact_length(0, 8 * 1000 - 1, 1000) == 125 and exact_length(0, 8 * 1000, 1000) is None
    assert exact_length(-(2**63), 2**63 - 1) is None


NOON = "2018-11-26 12:00:00"


def kept_ids(spark, ids, tables):
    return tables.keep(users_frame(spark, [(i, 30, "a") for i in ids]).select("user_id"), "ids")


def test_all_actions_go_on_beyond_the_bound(spark):
    actions = actions_frame(spark, [click("a", 1, NOON, 1)])
    tables = Scratch(spark, "membership")
    ids = kept_ids(spark, range(0, 9000, 1000), tables)
    assert of_users(actions, ids, tables, most_bytes=8) == (actions, ids)
    assert tables.existing("user_filter") is None


@pytest.mark.parametrize(
    "ids, joined",
    [
        ([3, 4, 77], False),
        ([3, 4, 4, 77], True),  # listed twice: counts twice
        ([3, 4, 77, 10**15], True),  # too far apart for a bit each
        ([], False),
    ],
)
def test_rollup_is_the_same(spark, ids, joined):
    times = [f"2018-11-26 12:00:{i % 60:02d}" for i in range(600)]
    actions = actions_frame(spark, [click(f"s{i % 90}", i % 50, t, 1) for i, t in enumerate(times)])
    tables = Scratch(spark, "membership")
    user_ids = kept_ids(spark, ids, tables)
    kept, left = of_users(actions, user_ids, tables)
    assert (left is not None) == joined
    assert rows(session_rollup(kept, left)) == rows(session_rollup(actions, user_ids))
    assert kept.select("user_id").distinct().count() < 10


@pytest.mark.parametrize("ids", [[3, 4, 77], [3, 4, 10**15]])
def test_asked_below_the_first_aggregate(spark, ids):
    actions = actions_frame(spark, [click("a", 3, NOON, 1)])
    tables = Scratch(spark, "membership")
    text = plan(session_rollup(*of_users(actions, kept_ids(spark, ids, tables), tables)))
    asked = text.index("Filter", text.index("partial_min"))
    assert "scalar-subquery" in text[asked : text.index("\n", asked)].lower() or "Subquery" in text[asked:]
    assert ("Join" in text) == (10**15 in ids)
