"""The lists of sessions in numbered parts, against the lists in one row."""

import random

import pytest
from builders import actions_frame, click, order, pay, rows, search
from test_plans import plan

from footfall.operators.session_parts import session_info_parts
from footfall.operators.sessions import session_info

from pyspark.sql import functions as F

COLUMNS = {
    "keyword": "search_keywords",
    "click": "click_product_ids",
    "order": "order_product_ids",
    "pay": "pay_product_ids",
}


def made(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        session = rng.choice(["a", "b", None, ""])
        time = f"2018-11-26 12:{rng.randrange(6):02d}:{rng.randrange(4):02d}"
        kind = rng.choice([search, click, order, pay])
        value = rng.randrange(1, 3000) if kind is click else "v" * rng.randrange(9)
        out.append(click(session, 1, time, 1, value) if kind is click else kind(session, 1, time, *([value] if kind is search else ["1", value])))
    return out


@pytest.mark.parametrize("characters", [1, 7, 40, 10_000])
@pytest.mark.parametrize("seed", [1, 2])
def test_parts_join_to_the_list(spark, seed, characters):
    actions = actions_frame(spark, made(seed, 300)).repartition(4)
    parts = session_info_parts(actions, characters).collect()
    lists = {}
    for p in sorted(parts, key=lambda p: p.part):
        own = lists.setdefault((p.session_id, p.kind), [])
        assert p.part == len(own) and p.first_entry == sum(q.entries for q in own)
        values = p.list_part.split(",")
        assert len(values) == p.entries
        assert sum(len(v) + 1 for v in values[:-1]) < characters + 9
        own.append(p)
    for info in session_info(actions).collect():
        for kind, column in COLUMNS.items():
            own = lists.pop((info.session_id, kind), [])
            assert ",".join(p.list_part for p in own) == info[column]
    assert lists == {}


def test_no_rows_and_values_of_no_length(spark):
    assert rows(session_info_parts(actions_frame(spark, []))) == []
    empty = actions_frame(spark, [search("a", 1, "2018-11-26 12:00:00", "")] * 3)
    assert rows(session_info_parts(empty, 1)) == [("a", "keyword", i, i, 1, "") for i in range(3)]


def test_a_million_actions_without_a_session(spark):
    """Parts stay bounded where the one row of ``session_info`` grows with the table."""
    actions = spark.range(0, 1_000_000, 1, 8).select(
        F.lit(None).cast("string").alias("session_id"),
        F.expr("string(timestamp_ntz'2018-11-26 00:00:00' + make_dt_interval(0, 0, 0, id div 40))").alias("action_time"),
        F.lit(None).cast("string").alias("search_keyword"),
        (F.col("id") % 90_000 + 10_000).alias("click_product_id"),
        F.lit(None).cast("string").alias("order_product_ids"),
        F.lit(None).cast("string").alias("pay_product_ids"),
    )
    parts = session_info_parts(actions, 60_000)
    lengths = parts.select("part", "entries", F.length("list_part").alias("n")).collect()
    assert sum(r.entries for r in lengths) == 1_000_000
    assert sorted(r.part for r in lengths) == list(range(100))
    assert max(r.n for r in lengths) <= 60_005
    text = plan(parts)
    assert text.count("collect_list") and "minute" in text
