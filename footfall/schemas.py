"""Fixed schemas of the wire formats and of every table."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
TS, DAY = T.TimestampNTZType(), T.DateType()
TEXT_MAP = T.MapType(S, S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# The 23 columns of a CSV drop, in file order.
CSV_COLUMNS = (
    "id", "type", "createdAt", "receivedAt", "sessionId", "ip", "userId", "url", "referrer",
    "deviceType", "userAgent", "payload.eventTitle", "payload.elementId", "payload.x", "payload.y",
    "payload.elementText", "payload.elementClass", "payload.pageTitle", "payload.viewportWidth",
    "payload.viewportHeight", "payload.scrollPosition", "payload.timestampOffset", "payload.metadata",
)

# Keys of a topic message and of its payload, and the keys a message must have.
MESSAGE_KEYS = (
    "id", "type", "createdAt", "receivedAt", "sessionId", "ip", "userId", "url", "referrer",
    "deviceType", "userAgent", "payload",
)
REQUIRED_KEYS = ("id", "type", "createdAt", "receivedAt", "sessionId", "ip", "userId", "url")
PAYLOAD_TYPES = {
    "eventTitle": S, "elementId": S, "x": I, "y": I, "elementText": S, "elementClass": S,
    "pageTitle": S, "viewportWidth": I, "viewportHeight": I, "scrollPosition": D,
    "timestampOffset": L, "metadata": TEXT_MAP,
}

RAW = _struct(
    user_id=I, created_at=TS, id=S, type=S, received_at=TS, session_id=S, ip=S, url=S, referrer=S,
    device_type=S, user_agent=S, event_title=S, element_id=S, x=I, y=I, element_text=S,
    element_class=S, page_title=S, viewport_width=I, viewport_height=I, scroll_position=D,
    timestamp_offset=L, metadata=TEXT_MAP,
)
RAW_COLUMNS = tuple(RAW.names)
RAW_KEY = ("user_id", "created_at", "id")

CLEAN_COLUMNS = (
    "user_id", "created_at", "id", "type", "session_id", "url", "device_type", "event_title",
    "element_id", "x", "y",
)
CLEAN_KEY = RAW_KEY
CLEAN = T.StructType([RAW[name] for name in CLEAN_COLUMNS])

INVALID = _struct(
    user_id=I, id=S, type=S, session_id=S, event_time=TS, processed_at=TS, validation_error=S,
)
INVALID_KEY = ("user_id", "id")

USER_ACTIVITY_DAILY = _struct(
    date=DAY, dau=L, wau=L, mau=L, wau_to_dau_ratio=D, mau_to_dau_ratio=D,
)
ELEMENT_CONVERSION = _struct(
    date=DAY, element_id=S, views=L, clicks=L, conversion_rate=D, avg_x=D, avg_y=D,
    total_interactions=L,
)
SESSION_METRICS_DAILY = _struct(
    date=DAY, avg_duration_seconds=D, median_duration_seconds=D, std_duration_seconds=D,
    total_events=L, session_count=L, unique_users=L, avg_duration_minutes=D,
    median_duration_minutes=D,
)
DEVICE_DISTRIBUTION_DAILY = _struct(
    date=DAY, device_type=S, unique_users=L, unique_sessions=L, device_events=L,
    user_percentage=D, session_percentage=D, event_percentage=D,
)
TOP_PAGES_DAILY = _struct(
    date=DAY, url=S, unique_users=L, unique_sessions=L, view_count=L, click_count=L,
    conversion_rate=D, rank=I,
)
MARTS = {
    "user_activity_daily": USER_ACTIVITY_DAILY,
    "element_conversion": ELEMENT_CONVERSION,
    "session_metrics_daily": SESSION_METRICS_DAILY,
    "device_distribution_daily": DEVICE_DISTRIBUTION_DAILY,
    "top_pages_daily": TOP_PAGES_DAILY,
}
