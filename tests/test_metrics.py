"""Worked numbers, brute-force checks and properties of the metrics."""

import random
import statistics
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.functions.events import event_category
from footfall.operators import (
    activity, conversion, dashboard, devices, pages, quantile, sessions, summary, visits,
)
from footfall.sources import tables

FRAME = (
    "user_id int, created_at timestamp_ntz, event_id string, event_type string, session_id string,"
    " url string, device_type string, event_title string, element_id string, x int, y int"
)
NAMES = [part.split()[0] for part in FRAME.split(",")]
DAY = datetime(2024, 1, 1)


def frame(spark, rows):
    base = {"user_id": 1, "created_at": DAY, "event_type": "view", "session_id": "s", "url": "/p",
            "device_type": "desktop"}
    data = []
    for i, row in enumerate(rows):
        full = {**base, "event_id": str(i), **row}
        data.append(tuple(full.get(name) for name in NAMES))
    return spark.createDataFrame(data, FRAME)


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_dau(spark):
    df = frame(spark, [{"user_id": u, "created_at": DAY + timedelta(days=d)}
                       for u, d in ((1, 0), (2, 0), (1, 1), (3, 1))])
    result = activity.rolling_active_users(activity.active_days(df))
    assert rows_of(result.select("dau", "wau", "mau"), "wau") == [(2, 2, 2), (2, 3, 3)]


def test_wau_worked_number(spark):
    df = frame(spark, [{"user_id": u, "created_at": DAY + timedelta(days=d)}
                       for d in range(10) for u in range(d)])
    result = activity.rolling_active_users(activity.active_days(df))
    assert result.where(F.col("date") == date(2024, 1, 6)).first().wau == 5


def test_mau_worked_number(spark):
    df = frame(spark, [{"user_id": u, "created_at": DAY + timedelta(days=d)}
                       for d in range(31) for u in range(d % 10)])
    result = activity.rolling_active_users(activity.active_days(df))
    assert result.where(F.col("date") == date(2024, 1, 30)).first().mau == 9


def test_rolling_equals_brute_force(spark):
    rng = random.Random(1)
    active = {(rng.randrange(40), DAY + timedelta(days=rng.choice((rng.randrange(20), rng.randrange(120)))))
              for _ in range(400)}
    df = frame(spark, [{"user_id": u or None, "created_at": d} for u, d in active])
    got = {r.date: (r.dau, r.wau, r.mau) for r in
           activity.rolling_active_users(activity.active_days(df)).collect()}
    expected = {}
    for day in {d for _, d in active}:
        expected[day.date()] = tuple(
            len({u for u, d in active if u and day - timedelta(days=n - 1) <= d <= day})
            for n in (1, 7, 30)
        )
    assert got == expected


def test_activity_order(spark, sf_dir):
    from footfall.registry.queries import REGISTRY

    mart = REGISTRY["user_activity_daily"](spark, sf_dir)
    assert mart.where("dau > wau OR wau > mau OR dau <= 0").isEmpty()


CATEGORIES = [
    ("view", None, "view"), ("VIEW", None, "view"), ("click", "x view", "click"), ("CLICK", None, "click"),
    ("View", None, "other"), ("scroll", "Page VIEW", "view"), ("scroll", "Button Click", "click"),
    ("scroll", "click the view", "view"), (None, None, "other"), ("scroll", "none", "other"),
]


def test_category(spark):
    df = spark.createDataFrame([c[:2] for c in CATEGORIES], "k string, t string").coalesce(1)
    got = df.select(event_category(F.col("k"), F.col("t")).alias("c")).collect()
    assert [r.c for r in got] == [c[2] for c in CATEGORIES]


def test_element_conversion(spark):
    rows = [
        {"element_id": "btn_1", "event_type": "view"},
        {"element_id": "btn_1", "event_type": "click", "x": 10, "y": None},
        {"element_id": "btn_1", "event_type": "view", "created_at": DAY + timedelta(days=1), "x": 99},
        {"element_id": "btn_2", "event_type": "click", "x": 3, "y": 4},
        {"element_id": "btn_2", "event_type": "click", "x": None, "y": 5},
        {"element_id": ""}, {"element_id": None},
    ]
    result = conversion.element_conversion(frame(spark, rows)).select(
        "element_id", "date", "views", "clicks", "conversion_rate", "avg_x", "avg_y",
        "total_interactions")
    assert rows_of(result, "element_id") == [
        ("btn_1", date(2024, 1, 2), 2, 1, 50.0, 10.0, 0.0, 3),
        ("btn_2", date(2024, 1, 1), 0, 2, 0.0, 3.0, 4.5, 2),
    ]


def test_page_conversion(spark):
    rows = ([{"url": "/1", "event_type": "view", "user_id": i} for i in range(10)]
            + [{"url": "/1", "event_type": "click"}, {"url": "/1", "event_type": "other", "session_id": "t"}])
    row = conversion.page_conversion(frame(spark, rows)).first()
    assert (row.views, row.clicks, row.conversion_rate, row.unique_users, row.unique_sessions) == (
        10, 1, 10.0, 10, 2)


def test_session_duration(spark):
    times = ("10:00:00", "10:05:30", "10:10:15")
    df = frame(spark, [{"created_at": datetime.fromisoformat(f"2024-01-01 {t}")} for t in times])
    row = sessions.session_rollup(sessions.session_parts(df)).first()
    assert (row.duration_us / 1e6, row.event_count, row.date) == (615.0, 3, date(2024, 1, 1))


def test_sessions_clamp_first_user_and_single_event(spark):
    rows = [
        {"session_id": "long", "user_id": 2, "created_at": DAY + timedelta(days=3)},
        {"session_id": "long", "user_id": 7, "created_at": DAY},
        {"session_id": "one", "user_id": 2, "created_at": DAY + timedelta(hours=1)},
        {"session_id": None, "user_id": 9},
    ]
    df = frame(spark, rows)
    for parts in (sessions.session_parts(df), visits.visit_rollup(df)):
        result = sessions.session_rollup(parts)
        assert rows_of(result.select("session_id", "user_id", "duration_us", "event_count"), "session_id") == [
            ("long", 7, 86_400_000_000, 2), ("one", 2, 0, 1)]
    row = sessions.session_metrics_daily(result).first()
    assert (row.session_count, row.unique_users, row.total_events) == (2, 2, 3)
    assert (row.avg_duration_minutes, row.median_duration_minutes) == (720.0, 720.0)
    assert row.std_duration_seconds == pytest.approx(statistics.stdev([86400, 0]))


def test_deviation_of_one_session_is_zero(spark):
    row = sessions.session_metrics_daily(
        sessions.session_rollup(sessions.session_parts(frame(spark, [{}])))).first()
    assert (row.std_duration_seconds, row.median_duration_seconds) == (0.0, 0.0)


@pytest.mark.parametrize("width", [1, 7, 1000, 10**9])
def test_exact_median(spark, width):
    rng = random.Random(width)
    values = [(g, rng.choice((0, rng.randrange(50), rng.randrange(5_000_000))))
              for g in range(9) for _ in range(1 + g * 13)]
    df = spark.createDataFrame(values + [(3, None)], "g int, v bigint")
    got = dict(quantile.exact_median(df, "g", "v", width).collect())
    assert got == {g: statistics.median(v for h, v in values if h == g) for g in range(9)}


def test_device_distribution(spark):
    rows = [{"user_id": 1, "session_id": "a"}, {"user_id": 3, "session_id": "b"},
            {"user_id": 2, "session_id": "c", "device_type": "mobile"},
            {"user_id": 4, "session_id": "d", "device_type": None}]
    result = devices.device_distribution_daily(visits.visit_rollup(frame(spark, rows)))
    assert rows_of(result.select("device_type", "unique_users", "unique_sessions", "device_events",
                                 "user_percentage"), "device_type") == [
        ("desktop", 2, 2, 2, 50.0), ("mobile", 1, 1, 1, 25.0)]


def test_dense_rank_of_pages(spark):
    views = {"/1": 5, "/2": 4, "/3": 4, "/4": 1}
    rows = [{"url": url, "user_id": i % 3} for url, n in views.items() for i in range(n)]
    rows += [{"url": "/2", "event_type": "click"}, {"url": "/only-clicks", "event_type": "click"}]
    days = pages.page_days(pages.page_visitors(frame(spark, rows)))
    shown = ("url", "view_count", "click_count", "conversion_rate", "rank")
    expected = [("/1", 5, 0, 0.0, 1), ("/2", 4, 1, 25.0, 2), ("/3", 4, 0, 0.0, 2), ("/4", 1, 0, 0.0, 3)]
    assert rows_of(pages.page_ranks_daily(days).select(*shown), "url") == expected
    assert rows_of(pages.top_pages_daily(days, top=2).select(*shown), "url") == expected[:3]


def test_empty_frame(spark):
    df = frame(spark, [])
    assert activity.user_activity_daily(activity.active_days(df)).isEmpty()
    assert sessions.session_metrics_daily(sessions.session_rollup(sessions.session_parts(df))).isEmpty()
    assert devices.device_distribution_daily(visits.visit_rollup(df)).isEmpty()
    assert pages.top_pages_daily(pages.page_days(pages.page_visitors(df))).isEmpty()
    assert conversion.element_conversion(df).isEmpty()
    assert summary.extract_profile(df).first().events == 0


def test_zero_coordinates_are_unknown(spark):
    clean = frame(spark, [{"x": 0, "y": 3}]).withColumnsRenamed({"event_id": "id", "event_type": "type"})
    row = tables.analysis_frame(clean).first()
    assert (row.x, row.y, row.event_id) == (None, 3, "0")


def test_clean_window_is_closed_and_raw_window_is_not(spark):
    clean = frame(spark, [{}]).withColumnsRenamed({"event_id": "id", "event_type": "type"})
    assert tables.clean_window(clean, DAY - timedelta(days=1), DAY).count() == 1
    assert tables.raw_window(clean, DAY - timedelta(days=1), DAY).count() == 0


def test_dashboard_windows_and_last_value(spark):
    mart = spark.createDataFrame(
        [(date(2024, 1, 30) - timedelta(days=d), None if d == 0 else d) for d in range(40)],
        "date date, dau int")
    trend = dashboard.active_users(mart, "dau", date(2024, 1, 30))
    assert trend.count() == 31
    assert tuple(dashboard.last_value(trend, "dau").first()) == (date(2024, 1, 29), 1)
