"""Jobs end to end on small folders: ingest, clean, marts, maintenance, streams."""

import json
import os
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions.timestamps import as_time
from footfall.operators import dashboard, keyed, normalise
from footfall.plans import bucketed, cleaning, ingest, marts, write
from footfall.session import shared_dir
from footfall.sources import files, tables, testdata
from footfall.streaming import cleaning as clean_stream, ingest as streams

DAY = datetime(2024, 1, 25)
NOW = DAY.replace(hour=12)


def message(i, hours=1, **more):
    body = {
        "id": f"e{i}", "type": "CLICK" if i % 2 else "VIEW",
        "createdAt": (NOW - timedelta(hours=hours, minutes=i)).isoformat(),
        "receivedAt": NOW.isoformat(), "sessionId": f"s{i % 3}", "ip": "10.0.0.1", "userId": 1 + i % 3,
        "url": f"/p{i % 2}", "deviceType": "IOS", "userAgent": "agent",
        "payload": {"elementId": f"#b{i % 2}", "x": i, "y": 2 * i, "eventTitle": "T"},
    }
    return body | more


def drop(folder, name, bodies):
    """A file of request bodies; ids are left out, as clients leave them out."""
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({k: v for k, v in b.items() if k != "id"}) for b in bodies]
    (folder / name).write_text("\n".join(lines))


@pytest.fixture
def paths(tmp_path):
    names = ("raw", "processed", "clean", "invalid")
    return cleaning.CleaningPaths(*(str(tmp_path / n) for n in names))


def land_messages(spark, paths, bodies, at=NOW):
    df = spark.createDataFrame([(json.dumps(b),) for b in bodies], "value string")
    rows = normalise.raw_from_messages(df, at)
    ingest.land(rows, paths.raw, paths.raw + "-dead", "topic", at)


def table(spark, path, schema):
    return tables.read_table(spark, path, schema, may_be_absent=True)


def clean_ids(spark, paths, as_of=NOW):
    state = tables.clean_state(table(spark, paths.clean, tables.CLEAN_TABLE), as_of)
    return sorted(r.id for r in state.collect())


def test_bodies_land_in_raw_and_dead_letter(spark, tmp_path, paths):
    drop(tmp_path / "in", "a.jsonl", [message(i) for i in range(5)] + [{"url": "/x"}])
    ingest.ingest_bodies(spark, str(tmp_path / "in"), paths.raw, str(tmp_path / "dead"))
    raw = table(spark, paths.raw, tables.RAW_TABLE)
    assert raw.count() == 5 and {r.source for r in raw.collect()} == {"http"}
    dead = spark.read.parquet(str(tmp_path / "dead"))
    assert [(r.reject_reason, r.source) for r in dead.collect()] == [("user id is null", "http")]


def test_second_csv_sweep_changes_no_state(spark, tmp_path, paths):
    lines = testdata.csv_lines(testdata.load_events(spark, "/root/testdata/sf0.001").limit(60))
    (tmp_path / "in").mkdir()
    text = "\n".join([",".join(schemas.CSV_COLUMNS)] + [r.line for r in lines.collect()])
    (tmp_path / "in" / "a.csv").write_text(text)
    counts, cleaned = [], []
    for _ in range(3):
        ingest.ingest_csv(spark, str(tmp_path / "in"), paths.raw, str(tmp_path / "dead"))
        raw = table(spark, paths.raw, tables.RAW_TABLE)
        counts.append(keyed.last_write_wins(raw, schemas.RAW_KEY).count())
        last = raw.agg(F.max("created_at")).first()[0] + timedelta(seconds=1)
        cleaning.clean(spark, paths, last, lookback=timedelta(days=400_000))
        invalid = tables.invalid_state(table(spark, paths.invalid, tables.INVALID_TABLE), DAY)
        cleaned.append((len(clean_ids(spark, paths, DAY)), invalid.count(),
                        table(spark, paths.clean, tables.CLEAN_TABLE).count()))
    assert counts[0] == counts[1] == counts[2] > 0 and raw.count() == 3 * counts[0]
    assert cleaned[0] == cleaned[1] == cleaned[2] and cleaned[0][0] > 0


def test_rows_without_a_quarantine_key_count_as_failed(spark, paths):
    land_messages(spark, paths, [message(1), message(2, payload=None)])
    raw = table(spark, paths.raw, tables.RAW_TABLE).where("id = 'e2'")
    write.append_days(raw.withColumn("user_id", F.lit(None).cast("int")), paths.raw)
    for _ in range(2):
        report = {r.sink: r for r in cleaning.clean(spark, paths, NOW).collect()}
        assert report["invalid"].failed == 1
        stored = table(spark, paths.invalid, tables.INVALID_TABLE)
        assert [r.id for r in stored.collect()] == ["e2"]
    assert report["invalid"].loaded == 0


def test_repeated_metadata_keys_do_not_stop_a_run(spark, paths):
    body = json.dumps(message(1)).replace('"eventTitle"', '"metadata": {"a": 1, "b": 2, "a": 3}, "eventTitle"')
    rows = normalise.raw_from_messages(spark.createDataFrame([(body,)], "value string"), NOW)
    ingest.land(rows, paths.raw, paths.raw + "-dead", "topic", NOW)
    cleaning.clean(spark, paths, NOW)
    assert clean_ids(spark, paths) == ["e1"]
    assert table(spark, paths.raw, tables.RAW_TABLE).first().metadata == {"a": "3", "b": "2"}


def test_a_missing_raw_table_is_an_error(spark, paths):
    with pytest.raises(AnalysisException):
        cleaning.clean(spark, paths, NOW)


def test_jobs_leave_no_stages(spark, paths):
    def stages():
        folder = os.path.join(shared_dir(spark), "footfall")
        names = os.listdir(folder) if os.path.isdir(folder) else []
        return {n for n in names if n.startswith(("landing", "validated", "survivors", "clean-state", "visits"))}

    before = stages()
    land_messages(spark, paths, [message(1)])
    cleaning.clean(spark, paths, NOW)
    cleaning.compact_raw(spark, paths, before="2024-01-26")
    assert stages() <= before


def test_cleaning_run(spark, paths):
    bodies = [message(i) for i in range(6)]
    bodies += [message(0)]  # sent twice
    bodies += [message(10, payload=None), message(11, deviceType="TV"), message(12, hours=30)]
    land_messages(spark, paths, bodies)
    report = {r.sink: r for r in cleaning.clean(spark, paths, NOW).collect()}
    assert clean_ids(spark, paths) == ["e0", "e1", "e11", "e2", "e3", "e4", "e5"]
    invalid = table(spark, paths.invalid, tables.INVALID_TABLE)
    assert sorted((r.id, r.validation_error) for r in invalid.collect()) == [
        ("e10", "Element ID is required for events"), ("e11", "Invalid device type: TV")]
    assert (report["clean"].total, report["invalid"].total, report["deletion"].loaded) == (7, 2, 8)

    raw = table(spark, paths.raw, tables.RAW_TABLE)
    done = table(spark, paths.processed, tables.PROCESSED_TABLE)
    assert [r.id for r in cleaning.unprocessed(raw, done).collect()] == ["e12"]  # a late row
    assert [r.id for r in keyed.late_rows(raw, NOW - timedelta(days=1)).collect()] == ["e12"]

    again = {r.sink: r.total for r in cleaning.clean(spark, paths, NOW).collect()}
    assert set(again.values()) == {0} and len(clean_ids(spark, paths)) == 7


def test_new_version_of_a_processed_event_replaces_it(spark, paths):
    land_messages(spark, paths, [message(1)])
    cleaning.clean(spark, paths, NOW)
    later = NOW + timedelta(minutes=10)
    land_messages(spark, paths, [message(1, url="/new")], later)
    cleaning.clean(spark, paths, later + timedelta(minutes=10))
    state = tables.clean_state(table(spark, paths.clean, tables.CLEAN_TABLE), later)
    assert [r.url for r in state.collect()] == ["/new"]


def test_compaction_keeps_the_visible_rows(spark, paths):
    land_messages(spark, paths, [message(i) for i in range(4)] + [message(9, hours=30)])
    cleaning.clean(spark, paths, NOW)
    land_messages(spark, paths, [message(2, url="/v2")], NOW + timedelta(hours=1))
    cleaning.compact_raw(spark, paths, before="2024-01-26")
    raw = table(spark, paths.raw, tables.RAW_TABLE)
    assert sorted(r.id for r in raw.collect()) == ["e2", "e9"]
    assert table(spark, paths.processed, tables.PROCESSED_TABLE).count() == 0
    cleaning.compact_raw(spark, paths, before="2024-01-26")
    assert table(spark, paths.raw, tables.RAW_TABLE).count() == 2


def test_compaction_keeps_what_arrives_meanwhile(spark, paths, monkeypatch):
    land_messages(spark, paths, [message(i) for i in range(3)])
    cleaning.clean(spark, paths, NOW)
    replace = cleaning.replace_files

    def late(path, *rest):
        if path == paths.raw:  # after the files were listed, before they are replaced
            land_messages(spark, paths, [message(7, hours=2)], NOW + timedelta(hours=1))
        replace(path, *rest)

    monkeypatch.setattr(cleaning, "replace_files", late)
    cleaning.compact_raw(spark, paths, before="2024-01-26")
    assert [r.id for r in table(spark, paths.raw, tables.RAW_TABLE).collect()] == ["e7"]


def test_compaction_of_a_day_that_empties(spark, paths):
    land_messages(spark, paths, [message(1), message(2)])
    cleaning.clean(spark, paths, NOW)
    cleaning.compact_raw(spark, paths, before="2024-01-26")
    assert table(spark, paths.raw, tables.RAW_TABLE).count() == 0


def test_purge_removes_only_expired_rows(spark, paths):
    for hours in (0, 24 * 8):
        at = NOW + timedelta(hours=hours)
        land_messages(spark, paths, [message(1, hours=-hours, payload=None)], at)
        cleaning.clean(spark, paths, at + timedelta(minutes=1))
    before = table(spark, paths.invalid, tables.INVALID_TABLE)
    assert before.count() == 2
    cleaning.purge_expired(spark, paths.invalid, tables.INVALID_TABLE, NOW + timedelta(days=8))
    left = table(spark, paths.invalid, tables.INVALID_TABLE)
    assert [r.processed_at.date() for r in left.collect()] == [date(2024, 2, 2)]


@pytest.fixture(scope="module")
def clean_table(spark, sf_dir, tmp_path_factory):
    """The clean table of the test events, every row stored twice."""
    path = str(tmp_path_factory.mktemp("clean"))
    rows = testdata.clean_events(testdata.load_events(spark, sf_dir))
    for hour in (0, 1):
        at = as_time(datetime(2024, 1, 31, hour))
        stored = rows.withColumn("user_id", F.col("user_id").cast("int")).withColumns(
            {"loaded_at": at, "expires_at": at + F.make_dt_interval(days=F.lit(365)),
             "date": F.to_date("created_at")})
        write.append_days(stored, path, "user_id", F.desc("created_at"), "id")
    return path


def all_marts(spark, path):
    return {
        name: sorted(
            (tuple(r) for r in marts.read_mart(spark, path, name).drop("calculation_timestamp").collect()),
            key=str,
        )
        for name in schemas.MARTS
    }


def test_mart_run_is_repeatable(spark, sf_dir, clean_table, tmp_path):
    from footfall.registry.queries import REGISTRY

    out = str(tmp_path / "marts")
    as_of = datetime(2024, 1, 31, 2)
    marts.run_marts(spark, clean_table, out, as_of)
    first = all_marts(spark, out)
    marts.run_marts(spark, clean_table, out, as_of)
    assert all_marts(spark, out) == first

    # Duplicates in the table do not count; warm-up days are read but not reported.
    expected = {r.date: (r.dau, r.wau) for r in REGISTRY["user_activity_daily"](spark, sf_dir).collect()}
    got = {r.date: (r.dau, r.wau) for r in marts.read_mart(spark, out, "user_activity_daily").collect()}
    assert min(got) == date(2024, 1, 21) and max(got) == date(2024, 1, 30)
    assert got == {d: expected[d] for d in got}
    assert max(row[5] for row in first["device_distribution_daily"]) <= 100


def test_later_run_replaces_its_days_and_keeps_others(spark, clean_table, tmp_path):
    out = str(tmp_path / "marts")
    marts.run_marts(spark, clean_table, out, datetime(2024, 1, 21, 2))
    early = all_marts(spark, out)
    marts.run_marts(spark, clean_table, out, datetime(2024, 1, 24, 2))
    late = all_marts(spark, out)
    for name in schemas.MARTS:
        if name == "element_conversion":
            continue
        kept = [row for row in early[name] if row[0] < date(2024, 1, 14)]
        assert [row for row in late[name] if row[0] < date(2024, 1, 14)] == kept
        days = [row[0] for row in late["user_activity_daily"]]
        assert len(days) == len(set(days)) == 14
    elements = marts.read_mart(spark, out, "element_conversion")
    assert elements.count() == elements.select("element_id").distinct().count()
    assert dashboard.overall_click_ratio(elements, date(2024, 1, 24)).first()[0] > 0


def test_reference_window_without_warmup(spark, clean_table, tmp_path):
    out = str(tmp_path / "marts")
    marts.run_marts(spark, clean_table, out, datetime(2024, 1, 31, 2), warmup_days=0)
    first = marts.read_mart(spark, out, "user_activity_daily").orderBy("date").first()
    assert first.dau == first.wau == first.mau


def test_marts_of_days_that_lost_their_rows(spark, clean_table, tmp_path):
    out, emptied = str(tmp_path / "marts"), str(tmp_path / "clean")
    as_of = datetime(2024, 1, 31, 2)
    marts.run_marts(spark, clean_table, out, as_of)
    stored = table(spark, clean_table, tables.CLEAN_TABLE)
    write.append_days(stored.where("date < date'2024-01-25'"), emptied)
    marts.run_marts(spark, emptied, out, as_of)
    days = {r.date for r in marts.read_mart(spark, out, "user_activity_daily").collect()}
    assert days == {date(2024, 1, 21) + timedelta(days=i) for i in range(4)}
    write.append_days(stored.where("date < date'2023-01-01'").withColumn("date", F.lit("2023-01-01").cast("date")), emptied)
    marts.run_marts(spark, emptied, out, datetime(2023, 6, 1))
    assert {r.date for r in marts.read_mart(spark, out, "user_activity_daily").collect()} == days


# --- streams --------------------------------------------------------------------------------


def test_topic_stream_equals_batch(spark, tmp_path, paths):
    bodies = [message(i) for i in range(20)] + [{"id": "bad"}, message(21, createdAt="soon")]
    topic = spark.createDataFrame(
        [(bytearray(json.dumps(b), "utf-8"), NOW) for b in bodies],
        "value binary, timestamp timestamp")
    topic.repartition(4).write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema(topic.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "topic"))
    for _ in range(2):  # the second run finds nothing new
        run = streams.start_ingest(
            streams.decode_topic(stream), paths.raw, str(tmp_path / "dead"),
            str(tmp_path / "checkpoint"), "topic", streams.DRAIN)
        run.awaitTermination()
    stored = table(spark, paths.raw, tables.RAW_TABLE).select(*schemas.RAW_COLUMNS)
    batch = normalise.accepted(streams.decode_topic(spark.read.parquet(str(tmp_path / "topic"))))
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.collect()))
    assert stored.where("id = 'e21'").first().created_at == NOW
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1


def test_csv_stream_takes_each_file_once(spark, tmp_path, paths):
    header = ",".join(schemas.CSV_COLUMNS)
    lines = [r.line for r in testdata.csv_lines(
        testdata.load_events(spark, "/root/testdata/sf0.001").limit(40)).collect()]
    folder = tmp_path / "in"
    folder.mkdir()
    for name, part in (("a.csv", lines[:20]), ("b.csv", lines[20:])):
        (folder / name).write_text("\n".join([header, *part]))
        run = streams.start_ingest(
            streams.stream_csv_drop(spark, str(folder)), paths.raw, str(tmp_path / "dead"),
            str(tmp_path / "checkpoint"), "csv", streams.DRAIN)
        run.awaitTermination()
    stored = table(spark, paths.raw, tables.RAW_TABLE).count()
    dead = spark.read.parquet(str(tmp_path / "dead")).count()
    assert stored > 0 and stored + dead == 40


@pytest.mark.parametrize("dialect", files.DIALECTS)
def test_csv_stream_reads_what_the_batch_reads(spark, tmp_path, dialect):
    values = ["e1", "click", "bad time"] + [""] * 3 + ["7", "/u"] + [""] * 15
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "plain").write_text("header\n" + ",".join(values) + "\nx\x01y,z\n")
    (tmp_path / "in" / "x.json").write_text("h\n{}")
    stream = streams.stream_csv_drop(spark, str(tmp_path / "in"), dialect, any_name=True)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream.writeStream.option("checkpointLocation", checkpoint).trigger(**streams.DRAIN).start(out).awaitTermination()
    batch = files.read_csv_drop(spark, str(tmp_path / "in"), dialect)
    got = sorted(map(str, spark.read.parquet(out).collect()))
    assert got == sorted(map(str, batch.collect()))
    rows = {r.id: r for r in batch.collect()}
    assert rows["e1"].created_at == rows["e1"].arrived_at.replace(
        microsecond=rows["e1"].arrived_at.microsecond // 1000 * 1000)
    assert "x\x01y,z" in {r.original for r in normalise.rejected(batch).collect()}


def test_bodies_stream_takes_each_file_once(spark, tmp_path, paths):
    for name in ("a.jsonl", "b.jsonl"):
        drop(tmp_path / "in", name, [message(i, url=f"/{name}") for i in range(3)])
        streams.start_ingest(
            streams.stream_bodies(spark, str(tmp_path / "in")), paths.raw, str(tmp_path / "dead"),
            str(tmp_path / "checkpoint"), "http", streams.DRAIN).awaitTermination()
    assert table(spark, paths.raw, tables.RAW_TABLE).count() == 6


def test_a_time_in_the_future_drops_no_later_row(spark, tmp_path):
    bodies = [message(1, createdAt="2030-01-01T00:00:00"), message(2), message(2), message(3)]
    for i, body in enumerate(bodies):
        rows = normalise.raw_from_messages(spark.createDataFrame([(json.dumps(body),)], "value string"), NOW)
        rows.drop("body", "reject_reason").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05 * (i < 3))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    run = streams.drop_repeats(source).writeStream.option("checkpointLocation", checkpoint)
    run.trigger(**streams.DRAIN).start(out).awaitTermination()
    assert sorted(r.id for r in spark.read.schema(schema).parquet(out).collect()) == ["e1", "e2", "e3"]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_a_run_without_rows_reports_zeros(spark, paths):
    land_messages(spark, paths, [message(1)])
    report = cleaning.clean(spark, paths, NOW - timedelta(days=9)).collect()
    assert [r.sink for r in report] == ["clean", "invalid", "deletion", "overall"]
    assert all(r.total == r.loaded == r.failed == r.success_rate == 0 for r in report)


def test_compaction_leaves_the_files_of_open_days(spark, paths):
    land_messages(spark, paths, [message(1), message(2, hours=48)])
    cleaning.clean(spark, paths, NOW, lookback=timedelta(days=9))
    today = write.files_of(table(spark, paths.raw, tables.RAW_TABLE).where(f"date = '{DAY.date()}'"))
    cleaning.compact_raw(spark, paths, before=DAY.date())
    left = table(spark, paths.raw, tables.RAW_TABLE)
    assert [r.id for r in left.collect()] == ["e1"] and write.files_of(left) == today
    listed = table(spark, paths.processed, tables.PROCESSED_TABLE)
    assert [r.id for r in listed.collect()] == ["e1"]


def test_cleaning_stream_prefers_the_newer_version_whenever_it_comes(spark, tmp_path, paths):
    """Late rows are cleaned when they come, and an older version that comes last changes nothing."""
    deliveries = [
        [(message(1, url="/new"), NOW), (message(2, payload=None), NOW)],
        [(message(1, url="/old", receivedAt=(NOW - timedelta(hours=1)).isoformat()), NOW - timedelta(minutes=30)), (message(3, hours=24 * 300), NOW)],
        [],
    ]
    for delivery in deliveries:
        for body, at in delivery:
            land_messages(spark, paths, [body], at)
        run = clean_stream.start_cleaning(
            clean_stream.stream_raw(spark, paths.raw, files_per_batch=1), paths, str(tmp_path / "cp"), streams.DRAIN
        )
        run.awaitTermination()
    state = tables.clean_state(table(spark, paths.clean, tables.CLEAN_TABLE), NOW)
    assert sorted((r.id, r.url) for r in state.collect()) == [("e1", "/new"), ("e3", "/p1")]
    assert table(spark, paths.clean, tables.CLEAN_TABLE).count() == 3
    invalid = table(spark, paths.invalid, tables.INVALID_TABLE)
    assert [r.id for r in invalid.collect()] == ["e2"]


def test_bucketed_tables_survive_their_catalog(spark, tmp_path):
    """Another session declares the tables over the folder and finds the rows; a run there adds none."""
    stamped = normalise.accepted(
        normalise.raw_from_messages(spark.createDataFrame([(json.dumps(message(i)),) for i in range(20)], "value string"), NOW)
    ).withColumns({"ingested_at": as_time(NOW), "source": F.lit("topic"), "date": F.to_date("created_at")})
    states = []
    for name in ("first", "second"):
        store = bucketed.BucketedTables(name, str(tmp_path / "b"), buckets=4)
        bucketed.declare(spark, store)
        if name == "first":
            bucketed.append(stamped, store, "raw")
        bucketed.clean(spark, store, NOW)
        states.append((bucketed.state(spark, store, NOW).count(), bucketed.read(spark, store, "clean").count()))
        bucketed.drop(spark, store)
    assert states == [(20, 20), (20, 20)]


def test_drop_folder_empties_into_the_archive(spark, tmp_path):
    lines = testdata.csv_lines(testdata.load_events(spark, "/root/testdata/sf0.001").limit(40)).collect()
    home, header = tmp_path / "drop", ",".join(schemas.CSV_COLUMNS)
    home.mkdir()
    for part in range(3):
        if part < 2:
            (home / f"{part}.csv").write_text("\n".join([header] + [r.line for r in lines[part::2]]))
        rows = streams.stream_csv_drop(spark, str(home), archive=str(tmp_path / "old" / "archive"))
        streams.start_ingest(rows, str(tmp_path / "raw"), str(tmp_path / "dead"), str(tmp_path / "cp"), "csv",
                             streams.DRAIN).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "raw")).count() + spark.read.parquet(str(tmp_path / "dead")).count()
    assert landed == 40
    assert [f.name for f in home.glob("*.csv")] == ["1.csv"]
    assert [f.name for f in (tmp_path / "old" / "archive").rglob("*.csv")] == ["0.csv"]
