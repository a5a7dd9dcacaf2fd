"""Duplicates, upsert, expiry, snapshots; also with one key that holds most rows."""

from datetime import datetime

from pyspark.sql import functions as F

from footfall import schemas
from footfall.operators import keyed

T0 = datetime(2024, 1, 1)
COLUMNS = "user_id int, created_at timestamp_ntz, id string, type string, session_id string, url string, x int, y int, n int"


def events(spark, rows):
    return spark.createDataFrame(
        [(1, T0, i, "view", "s", url, x, y, n) for i, url, x, y, n in rows], COLUMNS
    )


def test_first_seen_treats_missing_coordinates_as_zero(spark):
    df = events(spark, [("a", "/2", None, 0, 2), ("a", "/1", 0, None, 1), ("a", "/3", 5, 0, 3)])
    rows = keyed.first_seen(df, ("n",)).orderBy("url").collect()
    assert [(r.url, r.x, r.y) for r in rows] == [("/1", 0, None), ("/3", 5, 0)]


def test_first_seen_is_idempotent_and_ignores_order(spark):
    rows = [(str(i % 7), f"/{i}", i % 2, 0, i) for i in range(100)]
    once = keyed.first_seen(events(spark, rows), ("n",))
    again = keyed.first_seen(once, ("n",))
    shuffled = keyed.first_seen(events(spark, rows[::-1]).repartition(5), ("n",))
    expected = sorted(map(tuple, once.collect()))
    assert expected == sorted(map(tuple, again.collect())) == sorted(map(tuple, shuffled.collect()))


def test_ties_are_broken_by_the_other_columns(spark):
    rows = [("a", f"/{i}", 0, 0, 1) for i in range(50)]
    for frame in (events(spark, rows), events(spark, rows[::-1]).repartition(7)):
        assert keyed.first_seen(frame, ("n",)).first().url == "/0"
        assert keyed.last_write_wins(frame, schemas.RAW_KEY, ("n",)).first().url == "/9"


def test_hot_key_is_reduced_before_the_shuffle(spark):
    """A key with most of the rows reaches the shuffle as one row per map task."""
    df = (
        spark.range(0, 50_000, 1, 8)
        .select(
            F.lit(1).alias("user_id"),
            F.lit(T0).cast("timestamp_ntz").alias("created_at"),
            F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("id"),
            F.col("id").alias("n"),
        )
    )
    result = keyed.last_write_wins(df, schemas.RAW_KEY, ("n",))
    assert result.count() == 5_001
    assert result.where("id = 'hot'").first().n == 49_998
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_maps_survive_the_upsert(spark):
    df = spark.createDataFrame(
        [(1, {"b": "2", "a": "1"}, 1), (1, {"c": "3"}, 2), (2, {}, 1), (3, None, 1)],
        "user_id int, m map<string,string>, n int",
    )
    rows = keyed.last_write_wins(df, ("user_id",), ("n",)).orderBy("user_id").collect()
    assert [r.m for r in rows] == [{"c": "3"}, {}, None]


def test_expiry(spark):
    df = spark.createDataFrame([(1, T0), (2, datetime(2024, 1, 2))], "id int, expires_at timestamp_ntz")
    assert [r.id for r in keyed.unexpired(df, T0).collect()] == [2]
    assert [r.id for r in keyed.expired(df, T0).collect()] == [1]


def test_latest_snapshot(spark):
    df = spark.createDataFrame(
        [("d1", 1, 1), ("d1", 2, 2), ("d2", 3, 1), ("d2", 4, 1)],
        "date string, v int, calculation_timestamp int",
    )
    assert sorted(r.v for r in keyed.latest_snapshot(df).collect()) == [2, 3, 4]
    assert sorted(r.v for r in keyed.latest_snapshot(df, keys=()).collect()) == [2]


def test_late_rows(spark):
    df = events(spark, [("a", "/", 0, 0, 0)])
    assert keyed.late_rows(df, datetime(2024, 1, 2)).count() == 1
    assert keyed.late_rows(df, T0).count() == 0
