"""Rules, status, routes and the load report."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall import schemas
from footfall.operators import keyed, summary, validate

NOW = datetime(2024, 1, 25, 12, 0, 0)
VALID = {
    "id": "e1", "type": "VIEW", "user_id": 17, "session_id": "sess-b",
    "url": "/shop", "user_agent": "agent",
    "created_at": NOW - timedelta(minutes=20), "device_type": "TABLET", "element_id": "#top",
}
LATER = datetime(2024, 1, 25, 13, 0, 0, 250000)


def frame(spark, rows):
    data = [tuple({**VALID, **row}.get(name) for name in schemas.RAW_COLUMNS) for row in rows]
    return spark.createDataFrame(data, schemas.RAW)


CASES = [
    ({}, "VALID", []),
    ({"device_type": None}, "VALID", []),
    ({"type": "click", "device_type": "ios"}, "VALID", []),
    ({"received_at": NOW}, "VALID", []),
    (
        dict.fromkeys(VALID),
        "INVALID",
        ["Event ID is required", "Event type is required", "User ID is required",
         "Session ID is required", "URL is required", "User agent is required",
         "Created at timestamp is required"],
    ),
    ({"type": "HOVER"}, "INVALID", ["Invalid event type: HOVER"]),
    ({"user_id": -9}, "INVALID", ["User ID must be positive: -9"]),
    ({"user_id": 0}, "INVALID", ["User ID must be positive: 0"]),
    ({"device_type": "FRIDGE", "element_id": ""}, "INVALID",
     ["Invalid device type: FRIDGE", "Element ID is required for events"]),
    ({"element_id": None}, "INVALID", ["Element ID is required for events"]),
    ({"type": None, "element_id": None}, "INVALID", ["Event type is required"]),
    ({"device_type": "FRIDGE"}, "SUSPICIOUS", ["Invalid device type: FRIDGE"]),
    ({"device_type": "required"}, "INVALID", ["Invalid device type: required"]),
    ({"created_at": LATER}, "SUSPICIOUS",
     ["Created at timestamp is in the future: 2024-01-25 13:00:00.250000"]),
    ({"received_at": LATER.replace(microsecond=0)}, "SUSPICIOUS",
     ["Received at timestamp is in the future: 2024-01-25 13:00:00"]),
]


@pytest.fixture(scope="module")
def validated(spark):
    return validate.with_validation(frame(spark, [row for row, _, _ in CASES]).coalesce(1), NOW)


def test_rules_and_status(validated):
    rows = validated.collect()
    assert [(r.status, r.errors) for r in rows] == [(status, errors) for _, status, errors in CASES]


def test_routes_cover_all_rows(validated):
    count = dict(validate.status_counts(validated).collect())
    clean = validate.clean_rows(validated, NOW)
    bad = validate.quarantine_rows(validated, NOW)
    assert clean.count() == count["VALID"] + count["SUSPICIOUS"]
    assert bad.count() == count["INVALID"] + count["SUSPICIOUS"]
    assert clean.first().expires_at == NOW + timedelta(days=365)
    row = bad.where(F.col("type") == "HOVER").first()
    assert row.expires_at == NOW + timedelta(days=7)
    assert row.validation_error == "Invalid event type: HOVER"


def test_message_counts(validated):
    counts = {(r.rule, r.status): r.events for r in validate.message_counts(validated).collect()}
    assert counts["Invalid device type", "SUSPICIOUS"] == 1
    assert counts["Invalid device type", "INVALID"] == 2
    assert counts["User ID must be positive", "INVALID"] == 2


def test_load_report(spark):
    rows = [{}, {}, {"id": "e2", "device_type": "TV"}, {"id": "", "url": ""},
            {"user_id": None, "id": "e3"}]
    validated = validate.with_validation(frame(spark, rows), NOW)
    report = {r.sink: tuple(r)[1:] for r in summary.load_report(validated).collect()}
    assert report == {
        "clean": (2, 2, 0, 100.0),
        "invalid": (3, 2, 1, 66.67),
        "deletion": (4, 2, 2, 50.0),
        "overall": (5, 4, 1, 80.0),
    }


def test_load_report_of_nothing(spark):
    validated = validate.with_validation(frame(spark, []), NOW)
    assert {tuple(r)[1:] for r in summary.load_report(validated).collect()} == {(0, 0, 0, 0.0)}


def test_processed_keys_skip_incomplete_ones(spark):
    validated = validate.with_validation(
        frame(spark, [{}, {}, {"id": ""}, {"user_id": None}]), NOW
    )
    keys = validate.processed_keys(validated)
    assert [r.id for r in keys.collect()] == ["e1"]
    raw = frame(spark, [{}, {"id": ""}, {"user_id": None}, {"id": "e9"}])
    left = keyed.delete_processed(raw, keys)
    assert sorted((r.user_id or 0, r.id) for r in left.collect()) == [(0, "e1"), (17, ""), (17, "e9")]
