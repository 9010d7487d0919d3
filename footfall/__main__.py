"""Run all reports over catalog tables and deliver them.

    python -m footfall --database shop --conditions conditions.json \\
        --jdbc-options mysql.json

The conditions file is JSON with the keys ``startDate``, ``endDate``,
``startAge``, ``endAge``, ``professionals`` and ``targetPageFlow``, all optional. The
JDBC file holds the writer's options (url, user, password, driver); without it the
results are appended to catalog tables of the same names. A run with a run id can be
called again after a failure and then delivers what is missing.
"""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from footfall.conditions import Conditions
from footfall.operators.sampling import SAMPLE_SIZE, SEED
from footfall.plans import run_all
from footfall.plans.run import DIVERT, RAISE
from footfall.schema import USER_INFO, USER_VISIT_ACTION
from footfall.session import build_session
from footfall.sources.sinks import append_table, jdbc_sink
from footfall.sources.tables import read_table, use_database


def main(arguments: list[str] | None = None) -> str:
    parser = argparse.ArgumentParser(prog="footfall")
    parser.add_argument("--database", help="where the input tables are")
    parser.add_argument("--conditions", type=Path, help="JSON file of filter conditions")
    parser.add_argument("--jdbc-options", type=Path, help="JSON file of JDBC writer options")
    parser.add_argument("--sample-size", type=int, default=SAMPLE_SIZE)
    parser.add_argument("--seed", type=int, default=SEED)
    parser.add_argument("--run-id", help="makes the run resumable under this id")
    parser.add_argument(
        "--divert", action="store_true", help="set unreadable actions aside instead of failing"
    )
    chosen = parser.parse_args(arguments)

    conditions = Conditions()
    if chosen.conditions is not None:
        conditions = Conditions.from_json(chosen.conditions.read_text("utf-8"))
    sink = append_table
    if chosen.jdbc_options is not None:
        sink = jdbc_sink(json.loads(chosen.jdbc_options.read_text("utf-8")))

    spark = build_session()
    use_database(spark, chosen.database)
    if chosen.divert:
        actions = spark.table("user_visit_action")
    else:
        actions = read_table(spark, "user_visit_action", USER_VISIT_ACTION)
    run_id = run_all(
        actions,
        read_table(spark, "user_info", USER_INFO),
        conditions,
        sink,
        run_id=chosen.run_id,
        sample_size=chosen.sample_size,
        seed=chosen.seed,
        resumable=chosen.run_id is not None,
        on_rejected=DIVERT if chosen.divert else RAISE,
    )
    print(run_id)
    return run_id


if __name__ == "__main__":
    main()
