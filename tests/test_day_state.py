"""Stored day state: merging, refreshes of touched days only, marts equal to those from events."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from footfall import schemas
from footfall.operators import activity
from footfall.plans import day_state
from footfall.plans.marts import read_mart, run_marts
from footfall.plans.write import append_days
from footfall.sources import tables
from footfall.streaming import counts, ingest

LOADED = datetime(2024, 3, 5)


def _clean(spark, rows, loaded):
    """(user, time, id) rows as clean rows."""
    df = spark.createDataFrame(rows, "user_id int, created_at timestamp_ntz, id string")
    values = {
        "type": F.lit("CLICK"), "session_id": F.concat(F.lit("s"), F.col("user_id").cast("string")), "url": F.lit("/p"),
        "device_type": F.lit("IOS"), "event_title": F.lit("t"), "element_id": F.lit("#e"), "x": F.lit(3), "y": F.lit(0),
        "loaded_at": F.lit(str(loaded)).cast("timestamp_ntz"), "expires_at": F.lit("2030-01-01").cast("timestamp_ntz"),
        "date": F.to_date("created_at"),
    }
    return df.withColumns(values).select(*(F.col(f.name).cast(f.dataType) for f in tables.CLEAN_TABLE.fields))


def test_bitmaps_count_like_distinct_users(spark):
    # ids in several bitmaps, a user without rows on most days, a day without any row
    rows = [(u, datetime(2024, 3, 1 + d), f"{u}-{d}") for u in (1, 2, 32_768, 70_000, 2_000_000_000) for d in range(0, 28, 1 + u % 5) if d != 9]
    rows += rows[:4]
    events = tables.analysis_frame(_clean(spark, rows, LOADED))
    for first in (date(2024, 3, 1), date(2024, 3, 20)):
        want = activity.since(activity.user_activity_daily(activity.active_days(events)), first)
        got = day_state.activity_from_bitmaps(day_state.user_bitmaps(events), first)
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert day_state.activity_from_bitmaps(day_state.user_bitmaps(events.limit(0)), date(2024, 3, 1)).count() == 0


def test_refresh_reads_days_with_news(spark, tmp_path):
    clean, state, marts = (str(tmp_path / n) for n in ("clean", "state", "marts"))
    day = timedelta(days=1)
    append_days(_clean(spark, [(1, LOADED - 3 * day, "a"), (2, LOADED - 2 * day, "b")], LOADED), clean)
    assert day_state.run_marts_from_state(spark, clean, state, marts, LOADED) == [date(2024, 3, 2), date(2024, 3, 3)]
    # a late row for the first day, and one that arrives twice
    append_days(_clean(spark, [(3, LOADED - 3 * day, "c"), (3, LOADED - 3 * day, "c")], LOADED + day), clean)
    # days of the last load are read again: another file may have come with the same load time
    assert day_state.refresh(spark, clean, state, LOADED + day) == [date(2024, 3, 2), date(2024, 3, 3)]
    assert day_state.refresh(spark, clean, state, LOADED + day) == [date(2024, 3, 2)]
    found = day_state.marts_from_state(spark, state, date(2024, 3, 1), date(2024, 3, 4))
    assert [(r.date.day, r.dau, r.wau) for r in found["user_activity_daily"].orderBy("date").collect()] == [(2, 2, 2), (3, 1, 3)]
    element = found["element_conversion"].collect()
    assert [(r.element_id, r.clicks, r.avg_x, r.avg_y, r.date) for r in element] == [("#e", 3, 3.0, 0.0, date(2024, 3, 3))]


def test_empty_clean_table(spark, tmp_path):
    clean, state = str(tmp_path / "clean"), str(tmp_path / "state")
    _clean(spark, [], LOADED).write.parquet(clean)
    assert day_state.refresh(spark, clean, state, LOADED) == []


def test_ledger_and_counts(spark, tmp_path):
    home = str(tmp_path)
    for n in (2, 0, 3):
        rows = [("not json", datetime(2024, 1, 1))] * n
        spark.createDataFrame(rows, "value string, timestamp timestamp").write.mode("append").parquet(f"{home}/in")
        for checkpoint in ("one", "two"):  # the second plays every batch again
            source = spark.readStream.schema("value string, timestamp timestamp").parquet(f"{home}/in")
            listener = counts.BatchCounts(spark, f"{home}/counts-{checkpoint}", "t")
            listener.close(ingest.start_ingest(
                ingest.decode_topic(source), f"{home}/raw", f"{home}/dead", f"{home}/{checkpoint}", "t", ingest.DRAIN,
                ledger=f"{home}/ledger",
            ))
    assert spark.read.parquet(f"{home}/dead").count() == 5
    found = spark.read.schema(counts.COUNTS).parquet(f"{home}/counts-one").orderBy("batch_id").collect()
    assert [(r.accepted, r.refused, r.success_rate) for r in found] == [(0, 2, 0.0), (0, 3, 0.0)]
    written = spark.read.schema(counts.LEDGER).parquet(f"{home}/ledger").count()
    assert counts.is_written(spark, f"{home}/ledger", "t", 0) and written == len({(r.source, r.batch_id) for r in spark.read.parquet(f"{home}/ledger").collect()})
    assert not counts.is_written(spark, f"{home}/none", "t", 0)


def test_a_mart_run_of_one_mart_computes_no_other(spark, tmp_path):
    """``only`` stores that mart with the rows a run of all marts gives it, whatever it is made of."""
    clean = f"{tmp_path}/clean"
    rows = [(u, LOADED - timedelta(hours=7 * i), f"{u}-{i}") for u in (1, 2, 3) for i in range(1, 9)]
    append_days(_clean(spark, rows, LOADED).withColumn("type", F.lit("VIEW")), clean)
    run_marts(spark, clean, f"{tmp_path}/all", LOADED)
    for name in schemas.MARTS:
        run_marts(spark, clean, f"{tmp_path}/{name}", LOADED, only=(name,))
        assert [p.name for p in (tmp_path / name).iterdir()] == [name]
        one, every = (read_mart(spark, f"{tmp_path}/{home}", name) for home in (name, "all"))
        assert one.count() and sorted(map(str, one.collect())) == sorted(map(str, every.collect())), name


def test_a_mart_brings_only_its_state_up(spark, tmp_path):
    """A run of one mart stores its state alone; a later run of all marts makes up for the others."""
    clean, state, marts = (str(tmp_path / n) for n in ("clean", "state", "marts"))
    append_days(_clean(spark, [(1, LOADED - timedelta(days=3), "a"), (2, LOADED - timedelta(days=2), "b")], LOADED), clean)
    day_state.run_marts_from_state(spark, clean, state, marts, LOADED, only=("session_metrics_daily",))
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["refreshes", "visits"]
    assert [p.name for p in (tmp_path / "marts").iterdir()] == ["session_metrics_daily"]
    later = LOADED + timedelta(days=1)
    append_days(_clean(spark, [(3, LOADED - timedelta(days=2), "c")], later), clean)
    assert day_state.run_marts_from_state(spark, clean, state, marts, later) == [date(2024, 3, 2), date(2024, 3, 3)]
    run_marts(spark, clean, f"{tmp_path}/whole", later)
    for name in schemas.MARTS:
        one, other = (read_mart(spark, home, name) for home in (marts, f"{tmp_path}/whole"))
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())), name
