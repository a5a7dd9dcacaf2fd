"""Wire formats -> one row shape: the raw columns plus ``reject_reason``.

Rows with a reject reason never enter the raw table; the jobs write them to a dead letter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import schemas
from ..functions import text, timestamps
from ..functions.events import content_id
from .barrier import computed_once

CORRUPT = "_corrupt"
REJECT = "reject_reason"
CSV_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (*schemas.CSV_COLUMNS, CORRUPT)]
)
CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
}


def _first_reason(*checks: tuple[Column, str]) -> Column:
    return F.coalesce(*(F.when(condition, F.lit(reason)) for condition, reason in checks))


def _raw_rows(
    decoded: DataFrame, columns: dict[str, Column], reason: Column, *extra: str
) -> DataFrame:
    typed = [columns[f.name].cast(f.dataType).alias(f.name) for f in schemas.RAW.fields]
    return decoded.select(*typed, reason.alias(REJECT), *extra)


# --- CSV ------------------------------------------------------------------------------------


def csv_fields(
    lines: DataFrame, column: str = "line", dialect: str = "rfc4180", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One text line per row -> the 23 named text fields and the corrupt-record mark.

    ``rfc4180`` is the plain dialect; ``two_quotes`` also quotes with ``'`` and escapes with ``\\``.
    """
    line = F.col(column)
    if dialect == "rfc4180":
        ddl = ", ".join(f"`{name}` string" for name in CSV_SCHEMA.names)
        parsed = F.from_csv(line, F.lit(ddl), CSV_OPTIONS)
        return computed_once(lines.select(column, *keep), fields=parsed).select("fields.*", *keep)
    fields = computed_once(
        lines.select(line.alias(CORRUPT), *keep), fields=text.split_quoted_line(F.col(CORRUPT))
    )
    complete = F.size("fields") == len(schemas.CSV_COLUMNS)
    return fields.select(
        *(F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(schemas.CSV_COLUMNS)),
        F.when(~complete, F.col(CORRUPT)).alias(CORRUPT),
        *keep,
    )


def raw_from_csv(
    fields: DataFrame, as_of, undouble_metadata: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Text fields -> typed raw columns, with the defaults of the CSV path."""
    now = timestamps.as_time(as_of)
    value = {
        text.snake_name(name.removeprefix("payload.")): F.col(f"`{name}`")
        for name in schemas.CSV_COLUMNS
    }
    row: dict[str, Column] = {}
    for field in schemas.RAW.fields:
        cell = value[field.name]
        if isinstance(field.dataType, T.TimestampNTZType):
            row[field.name] = F.coalesce(
                timestamps.parse_csv_time(cell, timestamps.MILLIS), timestamps.to_millis(now)
            )
        elif isinstance(field.dataType, (T.IntegerType, T.LongType)):
            row[field.name] = text.safe_int(cell, field.dataType.simpleString())
        elif isinstance(field.dataType, T.DoubleType):
            row[field.name] = text.safe_double(cell)
        elif isinstance(field.dataType, T.StringType):
            row[field.name] = text.safe_string(cell)
    metadata = value["metadata"]
    if undouble_metadata:
        metadata = F.replace(metadata, F.lit('""'), F.lit('"'))
    row["metadata"] = text.metadata_map(metadata)

    payload = [text.snake_name(name) for name in schemas.PAYLOAD_TYPES if name != "metadata"]
    texts = [name for name in payload if isinstance(schemas.RAW[name].dataType, T.StringType)]
    is_set = F.size("metadata") > 0
    for name in payload:
        if name not in texts:
            is_set = is_set | (F.col(name) != 0)
    is_set = F.coalesce(is_set, F.lit(False)) | F.coalesce(*texts).isNotNull()

    typed = fields.select(
        CORRUPT,
        *(row[name].alias(name) for name in schemas.RAW_COLUMNS),
        F.when(row["id"].isNull(), content_id(*value.values())).alias("fallback_id"),
        *keep,
    )
    final = {name: F.col(name) for name in schemas.RAW_COLUMNS}
    # A payload in which nothing is set is no payload: its zeros are nulls too.
    typed = typed.withColumn("payload_set", is_set)
    final |= {n: F.when(F.col("payload_set"), F.col(n)) for n in payload if n not in texts}
    final["id"] = F.coalesce("id", "fallback_id")
    final["type"] = F.lower(F.coalesce("type", F.lit("")))
    final["user_id"] = F.coalesce("user_id", F.lit(0))
    for name in ("device_type", "user_agent"):
        final[name] = F.coalesce(name, F.lit(""))
    reason = _first_reason(
        (F.col(CORRUPT).isNotNull(), "field count is not 23"),
        (final["user_id"] <= 0, "user id is not positive"),
        (~final["type"].isin("view", "click"), "type is not view or click"),
    )
    return _raw_rows(typed, final, reason, CORRUPT, *keep)


# --- JSON -----------------------------------------------------------------------------------


def _both_spellings(kinds: dict[str, T.DataType]) -> T.StructType:
    """Every key as sent (camelCase) and as stored (snake_case), and the corrupt-record mark."""
    names = {
        spelling: kind for name, kind in kinds.items() for spelling in (name, text.snake_name(name))
    }
    fields = [T.StructField(name, kind) for name, kind in names.items()]
    return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])


# The payload is kept as text at first, so that its own keys can be looked at.
MESSAGE_SCHEMA = _both_spellings(
    {name: schemas.I if name == "userId" else schemas.S for name in schemas.MESSAGE_KEYS}
)
PAYLOAD_SCHEMA = _both_spellings(schemas.PAYLOAD_TYPES)
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _names(schema: T.StructType) -> Column:
    return F.array(*(F.lit(name) for name in schema.names if name != CORRUPT))


def _lacks(keys: Column, name: str) -> Column:
    found = F.array_contains(keys, name)
    snake = text.snake_name(name)
    return ~(found if snake == name else found | F.array_contains(keys, snake))


def _decode(values: DataFrame, column: str, keep: tuple[str, ...], with_keys: bool) -> DataFrame:
    """Adds m (message), p (payload) and on request the keys of both, each parsed once per row."""
    bodies = values.select(F.col(column).cast("string").alias("body"), *keep)
    parsed = bodies.withColumn("message", F.from_json("body", MESSAGE_SCHEMA, JSON_OPTIONS))
    payload = F.from_json("message.payload", PAYLOAD_SCHEMA, JSON_OPTIONS)
    columns = {"m": F.col("message"), "p": payload}
    if with_keys:
        columns["keys"] = F.json_object_keys("body")
        columns["payload_keys"] = F.json_object_keys("message.payload")
    return computed_once(parsed, **columns)


def _message_fields() -> dict[str, Column]:
    def either(prefix: str, name: str) -> Column:
        spellings = dict.fromkeys((name, text.snake_name(name)))
        return F.coalesce(*(F.col(f"{prefix}.{n}") for n in spellings))

    fields = {text.snake_name(n): either("m", n) for n in schemas.MESSAGE_KEYS if n != "payload"}
    fields |= {text.snake_name(n): either("p", n) for n in schemas.PAYLOAD_TYPES}
    empty = F.create_map().cast("map<string,string>")
    fields["metadata"] = F.coalesce(text.text_values(fields["metadata"]), empty)
    return fields


def _wrong_type() -> Column:
    return F.col(f"m.{CORRUPT}").isNotNull() | F.col(f"p.{CORRUPT}").isNotNull()


def raw_from_messages(
    messages: DataFrame, as_of, column: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Topic messages -> raw columns. Keys are strict: a missing or unknown one rejects the row."""
    now = timestamps.as_time(as_of)
    fields = _message_fields()
    for name in ("created_at", "received_at"):
        fields[name] = F.coalesce(
            timestamps.parse_message_time(fields[name], timestamps.MILLIS), timestamps.to_millis(now)
        )
    fields["id"] = F.coalesce(F.nullif(fields["id"], F.lit("")), content_id(F.col("body")))
    decoded = _decode(messages, column, keep, with_keys=True)
    keys = F.col("keys")
    lacks_any = F.lit(False)
    for name in schemas.REQUIRED_KEYS:
        lacks_any = lacks_any | _lacks(keys, name)
    reason = _first_reason(
        (keys.isNull(), "not a JSON object"),
        (lacks_any, "missing key"),
        (F.size(F.array_except(keys, _names(MESSAGE_SCHEMA))) > 0, "unknown key"),
        (F.size(F.array_except("payload_keys", _names(PAYLOAD_SCHEMA))) > 0, "unknown payload key"),
        (_wrong_type(), "value of the wrong type"),
        (fields["user_id"].isNull(), "user id is null"),
    )
    return _raw_rows(decoded, fields, reason, "body", *keep)


def raw_from_bodies(
    bodies: DataFrame, as_of, column: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Request bodies -> raw columns. Unknown keys are ignored, times must be ISO, ids are ours."""
    now = timestamps.as_time(as_of)
    fields = _message_fields()
    sent = {name: fields[name] for name in ("created_at", "received_at")}
    parsed = {name: timestamps.parse_iso_time(c, timestamps.MILLIS) for name, c in sent.items()}
    for name in sent:
        fields[name] = F.coalesce(parsed[name], timestamps.to_millis(now))
    fields["id"] = content_id(F.col("body"))
    reason = _first_reason(
        (F.col("m").isNull() | _wrong_type(), "not a valid body"),
        *((sent[name].isNotNull() & parsed[name].isNull(), f"{name} is not an ISO time")
          for name in sent),
        (fields["user_id"].isNull(), "user id is null"),
    )
    return _raw_rows(_decode(bodies, column, keep, with_keys=False), fields, reason, "body", *keep)


# --- all feeds ------------------------------------------------------------------------------


def accepted(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.where(F.col(REJECT).isNull()).select(*schemas.RAW_COLUMNS, *extra)


def rejected(rows: DataFrame, *extra: str) -> DataFrame:
    """The dead letter: the text as it came in, and why it was refused."""
    original = next(name for name in ("body", CORRUPT) if name in rows.columns)
    return rows.where(F.col(REJECT).isNotNull()).select(
        *schemas.RAW_COLUMNS, F.col(original).alias("original"), REJECT, *extra
    )


def union_feeds(feeds: dict[str, DataFrame], ingested_at) -> DataFrame:
    """The feeds as one frame, each row marked with its source and load time."""
    when = timestamps.as_time(ingested_at)
    marked = [
        df.select("*", when.alias("ingested_at"), F.lit(source).alias("source"))
        for source, df in feeds.items()
    ]
    result = marked[0]
    for df in marked[1:]:
        result = result.unionByName(df)
    return result
