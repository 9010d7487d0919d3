"""Runs that fail and are called again."""

from pathlib import Path

import pytest
from builders import rows, worked_actions, worked_users
from test_worked_example import CONDITIONS

from footfall.conditions import Conditions
from footfall.plans import run_all
from footfall.sources.sinks import append_table, folder_sink

TABLES = ["session_stat_info", "random_session_info", "category_top10", "category_top10_session_count"]
ROWS = {"session_stat_info": 1, "random_session_info": 3, "category_top10": 2, "category_top10_session_count": 4}


def run(spark, run_id, sink, conditions=CONDITIONS, **options):
    return run_all(
        worked_actions(spark), worked_users(spark), conditions, sink, run_id, resumable=True, **options
    )


def folder_of(spark, run_id):
    return Path(spark.conf.get("spark.checkpoint.dir")) / f"footfall-run-{run_id}"


@pytest.mark.parametrize("before_rows", [True, False], ids=["before", "after"])
@pytest.mark.parametrize("fails_at", range(4))
def test_second_call_delivers_what_is_missing(spark, fails_at, before_rows):
    """The sink fails before or just after the rows of some table are in."""
    run_id = f"resumed-{fails_at}-{before_rows}"
    prefix = f"resumed_{fails_at}_{before_rows}_"
    calls = []

    def sink(frame, table):
        calls.append(table)
        fails = len(calls) == fails_at + 1
        if fails and before_rows:
            raise RuntimeError("lost")
        append_table(frame, prefix + table)
        if fails:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        run(spark, run_id, sink)
    assert calls == TABLES[: fails_at + 1]
    assert run(spark, run_id, sink) == run_id
    assert calls == TABLES[: fails_at + 1] + TABLES[fails_at:]
    for table in TABLES:
        assert spark.table(prefix + table).count() == ROWS[table], table
    run(spark, run_id, sink)  # all is delivered: nothing happens
    assert len(calls) == 5
    assert [p.name for p in folder_of(spark, run_id).iterdir() if p.name == "tables"] == []


def test_written_tables_are_not_computed_again(spark):
    """The second call gets no actions at all, and delivers from what the first had written."""
    found = {}

    def failing(frame, table):
        found[table] = rows(frame)
        if table == "category_top10":
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run(spark, "kept-tables", failing)
    top = folder_of(spark, "kept-tables") / "tables" / "top_categories"
    assert (top / "_SUCCESS").exists()
    written = {p: p.stat().st_mtime_ns for p in top.glob("*.parquet")}
    again = {}
    run(spark, "kept-tables", lambda frame, table: again.update({table: (rows(frame), written.copy())}))
    assert again["category_top10"][0] == found["category_top10"]
    assert list(again) == TABLES[2:]


def test_half_written_tables_are_written_again(spark):
    def failing(frame, table):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run(spark, "half", failing)
    sessions = folder_of(spark, "half") / "tables" / "sessions"
    for path in sessions.glob("*SUCCESS*"):
        path.unlink()
    found = {}
    run(spark, "half", lambda frame, table: found.update({table: rows(frame)}))
    assert {t: len(r) for t, r in found.items()} == ROWS


def test_other_settings_are_an_error(spark):
    run(spark, "same", lambda frame, table: None)
    for changed in ({"conditions": Conditions()}, {"seed": 1}, {"sample_size": 5}):
        with pytest.raises(ValueError, match="other settings"):
            run(spark, "same", lambda frame, table: None, **changed)
    with pytest.raises(ValueError, match="needs a run id"):
        run(spark, None, lambda frame, table: None)


def test_folder_sink_replaces(spark, tmp_path):
    sink = folder_sink(str(tmp_path))
    run_all(worked_actions(spark), worked_users(spark), CONDITIONS, sink, "r")
    run_all(worked_actions(spark), worked_users(spark), CONDITIONS, sink, "r")
    for table in TABLES:
        assert spark.read.parquet(f"{tmp_path}/{table}").count() == ROWS[table]
