"""Field cases: line dialect, numbers, text, metadata, times."""

import json
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.functions import text, timestamps


def apply_all(spark, values, function):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = df.select("i", function(F.col("v")).alias("r")).collect()
    return {values[row.i]: row.r for row in rows}


def check(spark, cases, function):
    assert apply_all(spark, [value for value, _ in cases], function) == dict(cases)


def slow_split(line):
    """The two-quote dialect read character by character."""
    fields, field, quote, i = [], "", None, 0
    while i < len(line):
        c = line[i]
        if c == "\\" and i + 1 < len(line):
            field += line[i + 1]
            i += 1
        elif quote:
            if c != quote:
                field += c
            elif line[i + 1 : i + 2] == quote:
                field += c
                i += 1
            else:
                quote = None
        elif c in "\"'":
            quote = c
        elif c == ",":
            fields.append(field)
            field = ""
        else:
            field += c
        i += 1
    return [f.strip() for f in [*fields, field]]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="xy ,\"'\\é\t", max_size=14), min_size=40, max_size=60, unique=True))
def test_split_quoted_line(spark, lines):
    # a backslash at the end of a quoted field has nothing to escape; both readings keep it
    check(spark, [(line, slow_split(line)) for line in lines if not line.endswith("\\")], text.split_quoted_line)


def test_split_quoted_line_by_example(spark):
    cases = [
        ("north,south", ["north", "south"]), ("", [""]), (",,", ["", "", ""]), (" pad ,\t", ["pad", ""]),
        ("'9,5',\"7;2\"", ["9,5", "7;2"]), ("\"say \"\"go\"\"\"", ['say "go"']), ("o'clock,late", ["oclock,late"]),
        (r"tab\,le,x", ["tab,le", "x"]), ("end\\", ["end\\"]),
    ]
    check(spark, cases, text.split_quoted_line)


def test_split_quoted_line_takes_long_fields(spark):
    long = '""' * 200_000
    check(spark, [(f'a,"{long}",b', ["a", '"' * 200_000, "b"])], text.split_quoted_line)


def numbers(good):
    """Spellings of numbers with the value each should have."""
    for n, value in good:
        yield from ((n, value), (f" {n}\t", value), (f'"{n}"', value), (f"'{n}'", value))


NOT_NUMBERS = [None, "", " ", "null", "seven", "4x4", "1-", "- 5", "0x1f", "1,000", "+-2", "1e", "٣x"]


def test_safe_int(spark):
    good = numbers([("0", 0), ("31", 31), ("-64", -64), ("+8", 8), ("2147483647", 2147483647)])
    bad = [*NOT_NUMBERS, "3.0", "6.5", "1e2", "2147483648", "7d"]
    check(spark, [*good, *((b, None) for b in bad)], text.safe_int)


def test_safe_double(spark):
    good = numbers([("0", 0.0), ("31.25", 31.25), ("-0.5", -0.5), ("5e-1", 0.5), (".75", 0.75), ("8.", 8.0)])
    bad = [*NOT_NUMBERS, "3.1.4", "9f", "2.5D"]
    check(spark, [*good, *((b, None) for b in bad)], text.safe_double)


def test_safe_string(spark):
    cases = [(f"{pad}{q}{body}{q}{pad}", body) for pad in ("", "  ", "\t") for q in ("", '"', "'") for body in ("oak", "two  words", "Ünï")]
    cases += [(empty, None) for empty in (None, "", " \t", "null", "Null", "''", '"')]
    cases += [("'in \"mid\" out'", 'in "mid" out'), ("a''b", "a'b"), ('a""b', 'a"b'), ("\"left", "\"left"), ('""x""', '"x"')]
    check(spark, cases, text.safe_string)


def test_metadata_map(spark):
    objects = [
        {}, {"w": "v"}, {"n": 7}, {"f": 2.5}, {"yes": True, "no": False}, {"gone": None}, {"deep": {"er": [1, "2"]}},
        {"Ü": "ß", "": "empty"}, {"quote": 'a"b'},
    ]

    def shown(v):
        return "null" if v is None else v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))

    cases = []
    for o in objects:
        want = {k: shown(v) for k, v in o.items()}
        sent = json.dumps(o, separators=(",", ":"), ensure_ascii=False)
        cases += [(sent, want), (f"  {sent}\n", want), (f"'{sent}'", want), (f'"{sent}"', want)]
    cases += [(bad, {}) for bad in (None, "", " ", "null", "words", "7", "[{}]", '{"half":', "{x:1}", "'", '"')]
    cases += [('{"k":1,"l":2,"k":3}', {"k": "3", "l": "2"}), ('{"k":1,"k":null}', {"k": "null"})]
    check(spark, cases, text.metadata_map)


AT = datetime(2021, 11, 9, 17, 4, 0)


TIMES = [
    ("2021-11-09T17:04:00", AT, AT, AT),
    ("2021-11-09 17:04:00", AT, AT, None),
    ("2021-11-09T17:04:00.25", AT.replace(microsecond=250000),) + (AT.replace(microsecond=250000),) * 2,
    ("2021-11-09 17:04:00.25", AT.replace(microsecond=250000), None, None),
    ("2021-11-09T17:04:00Z", AT, None, None),
    ("2021-11-09 17:04:00Z", None, None, None),
    ("2021-11-09T17:04:00.1Z", AT.replace(microsecond=100000), None, None),
    ("2021-11-09T17:04:00.123456789", AT.replace(microsecond=123456), None,
     AT.replace(microsecond=123456)),
    ("2021-11-9T17:4:0", AT, AT, None),
    ("2021-11-09T17:04", None, None, AT),
    (' "2021-11-09T17:04:00" ', AT, None, None),
    ("1636477440", AT, None, None),
    ("1636477440.5", AT.replace(microsecond=500000), None, None),
    ("2021-11-09T17:04:00+03:00", None, None, None),
    ("2021-00-10T01:02:03", None, None, None),
    ("2021-11-31T17:04:00", None, None, None),
    ("next week", None, None, None),
    ("253402300800", None, None, None),
    ("-62135596801", None, None, None),
    ("1e15", None, None, None),
    ("null", None, None, None),
    ("", None, None, None),
    (None, None, None, None),
]


def test_times(spark):
    parsers = (timestamps.parse_message_time, timestamps.parse_csv_time, timestamps.parse_iso_time)
    for position, parser in enumerate(parsers, start=1):
        check(spark, [(case[0], case[position]) for case in TIMES], parser)


def test_to_millis_and_text(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678901' AS t")
    cut = timestamps.to_millis(F.col("t"))
    row = df.select(cut.alias("m"), timestamps.time_text(cut).alias("s"),
                    timestamps.time_text(F.date_trunc("second", "t")).alias("w")).first()
    assert row.m == datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert (row.s, row.w) == ("2024-01-02 03:04:05.678000", "2024-01-02 03:04:05")


def test_snake_name():
    names = {"eventTitle": "event_title", "id": "id", "timestampOffset": "timestamp_offset"}
    assert {n: text.snake_name(n) for n in names} == names


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-03-10T02:30:00.1239",)], "v string")
        cut = timestamps.to_millis(timestamps.parse_message_time(F.col("v")))
        assert [r.s for r in df.select(timestamps.time_text(cut).alias("s")).collect()] == [
            "2024-03-10 02:30:00", "2024-03-10 02:30:00.123000"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_bound_value_is_in_the_plan_once(spark):
    """What a lambda mentions must not be computed again for every entry."""
    df = spark.range(3).select(text.metadata_map(F.col("id").cast("string")).alias("m"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1, plan


def test_times_cut_in_the_text(spark):
    rows = [("2024-05-06T07:08:09.123456",), ("2024-05-06T07:08:09.1",), ("2024-05-06 07:08:09",), ("2024-05-06T07:08:09.123456789",),
            ("2024-05-06T07:08:09.1234567891",), ("1714979289.123456",), ("2024-05-06T07:08:09.12Z",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    for parse in (timestamps.parse_message_time, timestamps.parse_csv_time, timestamps.parse_iso_time):
        both = df.select(parse(F.col("s"), timestamps.MILLIS).alias("cut"), timestamps.to_millis(parse(F.col("s"))).alias("whole"))
        assert all(r.cut == r.whole for r in both.collect()), parse
