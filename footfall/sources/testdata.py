"""The ``events`` test table in the shape of the clean, raw and wire formats.

The table has only id, time, user, type, a value and ``{"k": 0..99}``. The other columns are
derived from these, with nulls and defects at fixed places, so that all rules have rows to act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _choose(index: Column, *values: str | None) -> Column:
    """The value at ``index``, null beyond the list."""
    return F.get(F.array(*(F.lit(v) for v in values)), index)


def analysis_events(events: DataFrame) -> DataFrame:
    """The analysis frame: clean columns under their analysis names."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    user, event = F.col("user_id").cast("string"), F.col("event_id")
    kind = F.col("event_type")
    half_day = F.floor(F.dayofmonth("ts") / 2).cast("string")
    title = (
        F.when(kind == "signup", "SIGNUP_CLICK")
        .when(kind == "purchase", "CHECKOUT_VIEW")
        .when(kind != "error", F.upper(kind))
    )
    return events.select(
        "user_id",
        F.col("ts").alias("created_at"),
        event.cast("string").alias("event_id"),
        "event_type",
        F.concat(F.lit("session_"), user, F.lit("_"), half_day).alias("session_id"),
        F.concat(F.lit("/page/"), (k % 18).cast("string")).alias("url"),
        _choose(k % 5, "DESKTOP", "ANDROID", "IOS", "MOBILE").alias("device_type"),
        title.alias("event_title"),
        F.when(k % 7 != 0, F.concat(F.lit("#el-"), (k % 16).cast("string"))).alias("element_id"),
        F.nullif((event % 1920).cast("int"), F.lit(0)).alias("x"),
        F.nullif(((event * 7) % 1080).cast("int"), F.lit(0)).alias("y"),
    )


def raw_events(events: DataFrame) -> DataFrame:
    """The raw columns with defects; columns the test table cannot fill are null."""
    i = F.col("event_id").cast("bigint")

    def every(n: int) -> Column:
        return i % n == 0

    clean = analysis_events(events)
    columns = {
        "user_id": F.when(every(41), None).when(every(43), -1).otherwise(F.col("user_id")),
        "created_at": F.col("created_at"),
        "id": F.when(every(47), "").otherwise(F.col("event_id")),
        "type": F.when(every(53), None).when(every(59), "SCROLL").when(every(2), "CLICK")
        .otherwise("view"),
        "received_at": F.when(every(61), F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
        .otherwise(F.col("created_at")),
        "session_id": F.when(every(67), "").otherwise(F.col("session_id")),
        "url": F.when(~every(71), F.col("url")),
        "device_type": F.when(every(73), "WATCH").otherwise(F.lower("device_type")),
        "user_agent": F.when(every(79), "").otherwise("agent"),
        "event_title": F.col("event_title"),
        "element_id": F.when(every(5), F.col("element_id"))
        .otherwise(F.concat(F.lit("#el-"), "event_id")),
        "x": F.col("x"),
        "y": F.col("y"),
    }
    keep_type = {"user_id"}
    return clean.select(
        *(
            columns.get(f.name, F.lit(None))
            .cast("bigint" if f.name in keep_type else f.dataType)
            .alias(f.name)
            for f in schemas.RAW.fields
        )
    )


def clean_events(events: DataFrame) -> DataFrame:
    """The clean table's columns."""
    return analysis_events(events).withColumnsRenamed({"event_id": "id", "event_type": "type"})


# --- wire formats ---------------------------------------------------------------------------


def _shaped_time(pattern: str) -> Column:
    return F.date_format("ts", pattern)


def csv_lines(events: DataFrame) -> DataFrame:
    """A CSV line per event: quoted agent with commas, doubled quotes in the JSON, some defects."""
    i, k = F.col("event_id"), F.regexp_extract("props", "([0-9]+)", 1)
    quoted_json = F.concat(
        F.lit('"{""k"": '), k, F.lit(', ""tag"": ""a,b"", ""flag"": true, ""none"": null}"')
    )
    fields = [
        F.when(i % 13 == 0, "null").otherwise(i.cast("string")),
        F.upper("event_type"),
        _shaped_time("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        _shaped_time("yyyy-MM-dd HH:mm:ss"),
        F.concat(F.lit("session_"), F.col("user_id").cast("string")),
        F.lit("10.0.0.1"),
        F.when(i % 17 == 0, "abc").otherwise(F.col("user_id").cast("string")),
        F.concat(F.lit("/page/"), k),
        F.lit("null"),
        F.lit(" DESKTOP "),
        F.lit('"Agent/5.0 (X, like ""Y"")"'),
        F.lit("Title"),
        F.when(i % 7 == 0, "null").otherwise(F.concat(F.lit("#el-"), k)),
        (i % 1920).cast("string"),
        F.when(i % 19 == 0, "12.5").otherwise((i % 1080).cast("string")),
        F.lit("Text"),
        F.lit("btn"),
        F.lit("Page"),
        F.lit("1920"),
        F.lit("1080"),
        F.col("value").cast("string"),
        i.cast("string"),
        F.when(i % 11 == 0, "{broken").otherwise(quoted_json),
    ]
    line = F.concat_ws(",", *fields)
    # Every 23rd line has a field too many.
    return events.select("event_id", F.when(i % 23 == 0, F.concat(line, F.lit(",x"))).otherwise(line)
                         .alias("line"))


def json_messages(events: DataFrame, with_id: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """A JSON message per event as the ``value`` column of a topic."""
    i, k = F.col("event_id"), F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    payload = F.struct(
        F.upper("event_type").alias("eventTitle"),
        F.concat(F.lit("#el-"), k.cast("string")).alias("elementId"),
        (i % 1920).cast("int").alias("x"),
        (i % 1080).cast("int").alias("y"),
        F.col("value").alias("scrollPosition"),
        i.alias("timestampOffset"),
        F.struct(k.alias("k"), (k % 2 == 0).alias("even"), F.array(k, k).alias("pair"))
        .alias("metadata"),
    )
    created = (
        F.when(i % 3 == 0, _shaped_time("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(i % 3 == 1, F.concat(_shaped_time("yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789")))
        .otherwise(_shaped_time("yyyy-MM-dd HH:mm:ss"))
    )
    body = {
        "id": i.cast("string"),
        "type": F.upper("event_type"),
        "createdAt": created,
        "receivedAt": F.when(i % 29 == 0, "yesterday").otherwise(
            _shaped_time("yyyy-MM-dd'T'HH:mm:ss")
        ),
        "sessionId": F.concat(F.lit("session_"), F.col("user_id").cast("string")),
        "ip": F.lit("10.0.0.1"),
        "userId": F.col("user_id").cast("int"),
        "url": F.concat(F.lit("/page/"), k.cast("string")),
        "deviceType": F.lit("IOS"),
        "userAgent": F.lit("Agent"),
    }
    names = [name for name in body if with_id or name != "id"]

    def message(skip: str = "", **extra: Column) -> Column:
        columns = [body[name].alias(name) for name in names if name != skip]
        columns += [c.alias(name) for name, c in extra.items()]
        return F.to_json(F.struct(*columns))

    value = (
        F.when(i % 31 == 0, message(skip="url", payload=payload))
        .when(i % 37 == 0, message(payload=payload, extra=F.lit(1)))
        .when(i % 41 == 0, F.lit("not json"))
        .when(i % 43 == 0, message())
        .otherwise(message(payload=payload))
    )
    return events.select("event_id", value.alias("value"), *keep)
