"""CSV lines, topic messages and request bodies -> raw rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from footfall import schemas
from footfall.operators import normalise
from footfall.sources import files

NOW = datetime(2024, 1, 25, 12, 0, 0)
VALUES = [
    "ev-7", "VIEW", "2024-01-03T08:09:10", "2024-01-03T08:09:12", "sess-a", "203.0.113.9", "41",
    "/shop/tea", "/start", "tablet", "agent (x, y)", "Tea list", "#tea-3", "12", "640", "Green tea",
    "row odd", "Tea", "800", "600", "0.25", "-30", '{"shelf": 4, "fresh": true}',
]


def csv_line(values):
    return ",".join('"' + v.replace('"', '""') + '"' if '"' in v or "," in v else v for v in values)


def from_lines(spark, lines, dialect="rfc4180"):
    frame = spark.createDataFrame([(line,) for line in lines], "line string").coalesce(1)
    fields = normalise.csv_fields(frame, "line", dialect)
    return normalise.raw_from_csv(fields, NOW, dialect == "two_quotes").collect()


def from_line(spark, line, dialect="rfc4180"):
    return from_lines(spark, [line], dialect)[0]


def changed(**at):
    values = list(VALUES)
    for position, value in at.items():
        values[int(position[1:])] = value
    return values


@pytest.mark.parametrize("dialect", files.DIALECTS)
def test_full_row(spark, dialect):
    row = from_line(spark, csv_line(VALUES), dialect)
    assert row.reject_reason is None
    got = [getattr(row, schemas.RAW_COLUMNS[i]) for i in range(len(schemas.RAW_COLUMNS))]
    assert dict(zip(schemas.RAW_COLUMNS, got, strict=True)) == {
        "user_id": 41, "created_at": datetime(2024, 1, 3, 8, 9, 10), "id": "ev-7", "type": "view",
        "received_at": datetime(2024, 1, 3, 8, 9, 12), "session_id": "sess-a", "ip": "203.0.113.9",
        "url": "/shop/tea", "referrer": "/start", "device_type": "tablet", "user_agent": "agent (x, y)",
        "event_title": "Tea list", "element_id": "#tea-3", "x": 12, "y": 640, "element_text": "Green tea",
        "element_class": "row odd", "page_title": "Tea", "viewport_width": 800, "viewport_height": 600,
        "scroll_position": 0.25, "timestamp_offset": -30, "metadata": {"shelf": "4", "fresh": "true"},
    }


@pytest.mark.parametrize("dialect", files.DIALECTS)
def test_wrong_field_count(spark, dialect):
    rows = from_lines(spark, [",".join(["v"] * n) for n in (2, 3, 21, 25, 40)], dialect)
    assert [row.reject_reason for row in rows] == ["field count is not 23"] * 5


def test_type(spark):
    cases = {"cLiCk": "click", "\tclick": "click", "vIEW": "view", " VIEW\t": "view", "click": "click",
             "view": "view", "HOVER": "hover", "clicks": "clicks"}
    rows = from_lines(spark, [csv_line(changed(_1=sent)) for sent in cases])
    assert [row.type for row in rows] == list(cases.values())
    assert [row.reject_reason for row in rows] == [None] * 6 + ["type is not view or click"] * 2


def test_defaults(spark):
    row = from_line(spark, csv_line(changed(_0="", _2="bad", _3="", _6="null", _9="", _10="null",
                                            _11="null", _22="null")))
    assert len(row.id) == 32 and row.created_at == NOW and row.received_at == NOW
    assert (row.user_id, row.device_type, row.user_agent, row.event_title) == (0, "", "", None)
    assert row.metadata == {} and row.reject_reason == "user id is not positive"


def test_generated_id_is_stable_and_depends_on_content(spark):
    rows = from_lines(spark, [csv_line(changed(_0="", _7=url)) for url in ("/a", "/a", "/b")])
    assert rows[0].id == rows[1].id != rows[2].id


def test_negative_and_zero_coordinates(spark):
    row = from_line(spark, csv_line(changed(_13="-7", _14="0")))
    assert (row.x, row.y) == (-7, 0)


def test_empty_payload_has_no_zeros(spark):
    values = VALUES[:11] + ["", "", "0", "0"] + [""] * 8
    row = from_line(spark, csv_line(values))
    assert (row.x, row.y, row.metadata, row.reject_reason) == (None, None, {}, None)


def test_malformed_metadata(spark):
    assert from_line(spark, csv_line(changed(_22='{"shelf": 4,'))).metadata == {}


def test_csv_folder(spark, tmp_path):
    header = ",".join(schemas.CSV_COLUMNS)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.CSV").write_text(
        "\n".join([header, csv_line(VALUES), "", csv_line(changed(_0="e2", _10="it's, \"quoted\""))])
    )
    (tmp_path / "in" / "b.txt").write_text("not,a,csv\n1,2,3")
    for dialect in files.DIALECTS:
        rows = files.read_csv_drop(spark, str(tmp_path), dialect)
        assert {r.id for r in normalise.accepted(rows).collect()} == {"ev-7", "e2"}
        assert normalise.rejected(rows).count() == 0


def test_csv_folder_skips_first_line_of_every_file(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("\n".join([csv_line(VALUES)] * 3))
    for dialect in files.DIALECTS:
        assert files.read_csv_drop(spark, str(tmp_path), dialect).count() == 4


def test_folder_without_csv_names(spark, tmp_path):
    header = ",".join(schemas.CSV_COLUMNS)
    (tmp_path / "drop_1").write_text("\n".join([header, csv_line(VALUES)]))
    (tmp_path / "x.JSON").write_text("{}\n{}")
    rows = files.read_csv_drop(spark, str(tmp_path))
    assert [r.id for r in rows.collect()] == ["ev-7"]


def test_fields_missing_in_file_are_reported(spark, tmp_path):
    (tmp_path / "a.csv").write_text("h\nonly,three,fields\n" + csv_line(VALUES + ["more"]))
    rows = files.read_csv_drop(spark, str(tmp_path))
    bad = normalise.rejected(rows)
    assert [r.reject_reason for r in bad.collect()] == ["field count is not 23"] * 2
    assert "only,three,fields" in {r.original for r in bad.collect()}


# --- JSON -----------------------------------------------------------------------------------

MESSAGE = {
    "id": "m1", "type": "CLICK", "createdAt": "2024-01-01T10:00:00.123456789",
    "receivedAt": "2024-01-01 10:00:05", "sessionId": "s1", "ip": "10.0.0.1", "userId": 5,
    "url": "/home", "referrer": None, "deviceType": "IOS", "userAgent": "agent",
    "payload": {"eventTitle": "T", "elementId": "#e", "x": 1, "y": 0, "scrollPosition": 0.5,
                "timestampOffset": 9_000_000_000, "metadata": {"a": True, "b": None, "c": {"d": 1}}},
}


def decode_all(spark, messages, decoder=normalise.raw_from_messages):
    bodies = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    df = spark.createDataFrame([(bytearray(b, "utf-8"),) for b in bodies], "value binary")
    return decoder(df.coalesce(1), NOW).collect()


def decode(spark, message, decoder=normalise.raw_from_messages):
    return decode_all(spark, [message], decoder)[0]


def without(name):
    return {k: v for k, v in MESSAGE.items() if k != name}


def test_message(spark):
    row = decode(spark, MESSAGE)
    assert row.reject_reason is None
    assert (row.id, row.user_id, row.type, row.url, row.referrer) == ("m1", 5, "CLICK", "/home", None)
    assert row.created_at == datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert row.received_at == datetime(2024, 1, 1, 10, 0, 5)
    assert (row.element_id, row.x, row.y, row.timestamp_offset) == ("#e", 1, 0, 9_000_000_000)
    assert row.metadata == {"a": "true", "b": "null", "c": '{"d":1}'}


def test_message_in_snake_case(spark):
    snake = {normalise.text.snake_name(k): v for k, v in MESSAGE.items()}
    assert decode(spark, snake).asDict() | {"body": ""} == decode(spark, MESSAGE).asDict() | {"body": ""}


def test_message_needs_its_keys(spark):
    rows = decode_all(spark, [without(name) for name in schemas.REQUIRED_KEYS])
    assert {row.reject_reason for row in rows} == {"missing key"}


def test_message_may_lack_other_keys(spark):
    names = ("referrer", "deviceType", "userAgent", "payload")
    rows = decode_all(spark, [without(name) for name in names])
    assert {row.reject_reason for row in rows} == {None}
    assert None not in {tuple(row.metadata) for row in rows}


def test_message_rejects(spark):
    cases = [
        ("not json", "not a JSON object"),
        ("[1]", "not a JSON object"),
        (MESSAGE | {"other": 1}, "unknown key"),
        (MESSAGE | {"payload": {"other": 1}}, "unknown payload key"),
        (MESSAGE | {"payload": "text"}, "value of the wrong type"),
        (MESSAGE | {"userId": "abc"}, "value of the wrong type"),
        (MESSAGE | {"userId": None}, "user id is null"),
    ]
    rows = decode_all(spark, [message for message, _ in cases])
    assert [row.reject_reason for row in rows] == [reason for _, reason in cases]


def test_message_defaults(spark):
    row = decode(spark, MESSAGE | {"id": None, "createdAt": None, "receivedAt": "soon",
                                   "payload": None})
    assert (row.created_at, row.received_at, row.reject_reason) == (NOW, NOW, None)
    assert len(row.id) == 32 and row.x is None and row.metadata == {}
    assert decode(spark, MESSAGE | {"createdAt": 1704103200}).created_at == datetime(2024, 1, 1, 10)


def test_request_body(spark):
    body = without("id") | {"receivedAt": "2024-01-01T10:00", "more": 1}
    row = decode(spark, body, normalise.raw_from_bodies)
    assert row.reject_reason is None and len(row.id) == 32
    assert row.created_at == datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert row.metadata == {"a": "true", "b": "null", "c": '{"d":1}'}
    bare = decode(spark, {"userId": 1}, normalise.raw_from_bodies)
    assert (bare.reject_reason, bare.created_at, bare.type, bare.metadata) == (None, NOW, None, {})


def test_request_body_rejects(spark):
    cases = [
        ("oops", "not a valid body"),
        ({"userId": 1, "createdAt": "2024-01-01 10:00:00"}, "created_at is not an ISO time"),
        ({"userId": 1, "receivedAt": "2024-01-01T10:00:00Z"}, "received_at is not an ISO time"),
        ({"type": "VIEW"}, "user id is null"),
    ]
    rows = decode_all(spark, [body for body, _ in cases], normalise.raw_from_bodies)
    assert [row.reject_reason for row in rows] == [reason for _, reason in cases]


def test_bodies_from_files(spark, tmp_path):
    lines = [json.dumps(without("id") | {"receivedAt": None}), "", "bad"]
    (tmp_path / "b.jsonl").write_text("\n".join(lines))
    rows = files.read_bodies(spark, str(tmp_path))
    assert normalise.accepted(rows).count() == 1
    assert normalise.rejected(rows).select("original").first()[0] == "bad"


def test_union_marks_sources(spark):
    rows = normalise.accepted(
        normalise.raw_from_messages(
            spark.createDataFrame([(json.dumps(MESSAGE),)], "value string"), NOW
        )
    )
    merged = normalise.union_feeds({"topic": rows, "http": rows}, NOW)
    assert {r.source for r in merged.collect()} == {"topic", "http"}
    assert merged.where(F.col("ingested_at") == F.lit(NOW).cast("timestamp_ntz")).count() == 2
