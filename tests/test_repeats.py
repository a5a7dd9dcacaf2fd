"""Repeats kept out of a stream: what passes, what is held, what is reported."""

from datetime import datetime, timedelta

from footfall.streaming import ingest, repeats

START = datetime(2024, 1, 1)
SCHEMA = "user_id int, created_at timestamp, id string, arrived_at timestamp, extra string"


def row(key, day, user=1, extra=None):
    return user, START, key, START + timedelta(days=day), extra


def run_each(spark, tmp_path, batches, **options):
    """One run per batch; ids let through in order of arrival, repeats dropped by each run."""
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    dropped = []
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(folder)
        source = spark.readStream.schema(SCHEMA).parquet(folder)
        query = repeats.start_first_arrivals(source, out, checkpoint, "arrived_at", ingest.DRAIN, **options)
        query.awaitTermination()
        dropped.append(repeats.dropped_repeats(query))
    passed = spark.read.schema(SCHEMA).parquet(out).orderBy("arrived_at", "id").collect()
    return passed, dropped, repeats.held_keys(spark, checkpoint)


def test_repeats_weeks_apart_and_in_one_batch_are_dropped(spark, tmp_path):
    batches = [[row("a", 0), row("b", 0), row("b", 0, extra="x")], [row("c", 40)], [row("a", 90), row("d", 90), row("a", 90, user=2)]]
    passed, dropped, held = run_each(spark, tmp_path, batches)
    assert [(r.user_id, r.id) for r in passed] == [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (1, "d")]
    assert dropped == [1, 0, 1]
    assert held.columns == ["user_id", "created_at", "id", "held_until"]
    until = {(r.user_id, r.id): r.held_until for r in held.collect()}
    assert len(until) == 5 and until[1, "a"] == START + timedelta(days=365)


def test_keys_are_forgotten_after_the_retention(spark, tmp_path):
    batches = [[row("a", 0)], [row("b", 5)], [row("c", 30)], [row("a", 31)]]
    passed, dropped, held = run_each(spark, tmp_path, batches, retention="10 days")
    assert [r.id for r in passed] == ["a", "b", "c", "a"] and sum(dropped) == 0
    assert {r.id for r in held.collect()} == {"c", "a"}


def test_null_keys_equal_each_other_and_an_empty_batch_is_none(spark, tmp_path):
    passed, dropped, held = run_each(spark, tmp_path, [[row(None, 0, user=None), row(None, 0, user=None)], [], [row(None, 1, user=None)]])
    assert len(passed) == 1 and sum(dropped) == 2 and held.count() == 1


def test_the_settings_of_the_session_are_left_as_they_were(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with repeats.rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before
