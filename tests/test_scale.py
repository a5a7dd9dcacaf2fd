"""What the plans must and must not contain, whatever the size of the data."""

import pathlib
import re

import pytest

from footfall import schemas
from footfall.operators import keyed
from footfall.plans import bucketed, cleaning
from footfall.registry import queries
from footfall.registry.queries import REGISTRY

PACKAGE = pathlib.Path(__file__).resolve().parent.parent / "footfall"
LAZY = sorted(set(REGISTRY) - {"stream_ingest_dedup"})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_python_cross_join_or_single_task_window(spark, sf_dir, name):
    plan = plan_of(REGISTRY[name](spark, sf_dir))
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in plan
    for window in re.findall(r"Window \[.*", plan):
        assert "[]" not in window.split("]", 1)[-1]


@pytest.mark.parametrize("name", ["raw_range_scan", "clean_range_scan", "late_rows",
                                  "rolling_active_users_windowed"])
def test_time_filter_reaches_the_scan(spark, sf_dir, name):
    plan = plan_of(REGISTRY[name](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*(Less|Greater)Than.*\(ts,", plan)


def read_columns(plan):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan)]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("user_activity_daily", {"ts", "user_id"}),
        ("session_rollup", {"ts", "user_id"}),
        ("event_category_counts", {"event_type"}),
    ],
)
def test_scan_reads_only_the_needed_columns(spark, sf_dir, name, columns):
    assert read_columns(plan_of(REGISTRY[name](spark, sf_dir))) == [columns]


@pytest.mark.parametrize(
    "name", ["session_metrics_daily", "page_ranks_daily", "device_distribution_daily"]
)
def test_events_are_scanned_once(spark, sf_dir, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_of(REGISTRY[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan") == 1


def test_rank_filter_limits_rows_before_the_shuffle(spark, sf_dir):
    plan = plan_of(REGISTRY["top_pages_daily"](spark, sf_dir))
    assert re.search(r"WindowGroupLimit .*dense_rank\(.*\), 10, Partial", plan)


def test_code_uses_no_local_checkpoint_broadcast_hint_or_udf():
    core = [path for path in PACKAGE.rglob("*.py") if "llm" not in path.parts]
    code = "\n".join(path.read_text() for path in core)
    for forbidden in ("localCheckpoint", "broadcast(", "crossJoin", "toPandas", ".rdd", "udf("):
        assert forbidden not in code
    # Only days of a table and names of files to replace come to the driver.
    assert code.count(".collect()") == 2


def test_load_report_expands_no_rows(spark, sf_dir):
    assert "Expand" not in plan_of(REGISTRY["load_report"](spark, sf_dir))


def test_bucketed_state_and_anti_join_need_no_shuffle(spark, tmp_path):
    store = bucketed.BucketedTables("plan_test", str(tmp_path), buckets=4)
    bucketed.declare(spark, store)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw, done = (bucketed.read(spark, store, part) for part in ("raw", "processed"))
        plans = [plan_of(bucketed.state(spark, store, "2024-01-25")),
                 plan_of(keyed.last_write_wins(cleaning.unprocessed(raw, done), schemas.RAW_KEY))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        bucketed.drop(spark, store)
    for plan in plans:
        assert "Exchange" not in plan and "Bucketed: true" in plan


@pytest.mark.parametrize("name, home", [
    ("stream_replay", "replayed"), ("csv_stream_stored_two_quotes", "csv-stream"), ("csv_stream_stored", "csv-stream"),
])
def test_a_stream_finds_a_file_for_every_task(spark, sf_dir, tmp_path, monkeypatch, name, home):
    """The events lie in one row group; decoding what was sent of them must not be left to one task."""
    monkeypatch.setattr(queries, "shared_path", lambda spark, name: f"{tmp_path}/{name}")
    REGISTRY[name](spark, sf_dir)
    sent = [p for folder in ("in", "archive") for p in (tmp_path / home / folder).rglob("part-*") if p.suffix != ".crc"]
    parts = 4 if name == "stream_replay" else 2
    assert len(sent) >= parts * spark.sparkContext.defaultParallelism
