"""Incremental marts: a stored state per day, from which all five marts follow without the events.

A run reads the clean rows of the days that got rows since the last run, and replaces the state of
those days. What a mart looks back on (30 days of users, sessions over midnight, a range of element
counts) it takes from the stored state of the other days:

    users      exact distinct users of a day as bitmaps, one per 32,768 ids; windows of days are
               their union
    visits     the visit roll-up (sessions, devices)
    pages      views and clicks per page, user and session
    elements   sums per element

All are sums, minima, maxima or unions, so states of days merge into states of ranges.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from .. import schemas
from ..functions.events import event_category, event_day, percent
from ..functions.text import is_empty
from ..functions.timestamps import as_time
from ..operators import activity, devices, pages, sessions, visits
from ..session import staging
from ..sources import tables
from .marts import LOOKBACK_DAYS
from .write import distinct_days, replace_days

def _stored(**columns: T.DataType) -> T.StructType:
    fields = [T.StructField(name, kind) for name, kind in columns.items()]
    return T.StructType([*fields, T.StructField("date", T.DateType())])


S, I, L, TS = schemas.S, schemas.I, schemas.L, schemas.TS
STATES = {
    "users": _stored(bucket=L, users=T.BinaryType()),
    "visits": _stored(
        session_id=S, user_id=I, device_type=S, first_at=TS, last_at=TS, events=L, identified_events=L
    ),
    "pages": _stored(url=S, user_id=I, session_id=S, views=L, clicks=L),
    "elements": _stored(element_id=S, views=L, clicks=L, sum_x=L, n_x=L, sum_y=L, n_y=L),
}
#: Load time a state is brought up to; a row without ``state`` stands for all of them.
REFRESHES = T.StructType([T.StructField("loaded_to", TS), T.StructField("state", S)])


def user_bitmaps(events: DataFrame) -> DataFrame:
    """Per day and bucket of user ids, the users seen."""
    seen = events.where(F.col("user_id").isNotNull())
    return seen.groupBy(
        event_day(F.col("created_at")).alias("date"), F.bitmap_bucket_number("user_id").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))


def element_sums(events: DataFrame) -> DataFrame:
    """Per day and element what its conversion and mean click position are made of."""
    category = event_category(F.col("event_type"), F.col("event_title"))
    click = F.col("category") == "click"

    def of_clicks(axis: str) -> list:
        value = F.when(click, F.col(axis))
        return [F.coalesce(F.sum(value), F.lit(0)).alias(f"sum_{axis}"), F.count(value).alias(f"n_{axis}")]

    return (
        events.where(~is_empty(F.col("element_id")))
        .withColumn("category", category)
        .groupBy(event_day(F.col("created_at")).alias("date"), "element_id")
        .agg(
            F.count_if(F.col("category") == "view").alias("views"), F.count_if(click).alias("clicks"),
            *of_clicks("x"), *of_clicks("y"),
        )
    )


_BUILD = {
    "users": user_bitmaps,
    "visits": visits.visit_rollup,
    "pages": pages.page_visitors,
    "elements": element_sums,
}
#: The state a mart follows from.
_MADE_OF = {
    "user_activity_daily": "users", "element_conversion": "elements", "session_metrics_daily": "visits",
    "device_distribution_daily": "visits", "top_pages_daily": "pages",
}


def refresh(
    spark: SparkSession, clean_path: str, state_path: str, as_of: datetime, states: tuple[str, ...] = tuple(_BUILD)
) -> list[date]:
    """Bring ``states`` up to the clean table; returns the days whose state was replaced.

    Days with rows loaded since the last refresh of the one that lags most are read, whole, and no
    others. The refresh is recorded last: one that dies is repeated over the same days.
    """
    clean = tables.read_table(spark, clean_path, tables.CLEAN_TABLE)
    known = tables.read_table(spark, f"{state_path}/refreshes", REFRESHES, may_be_absent=True)
    newest = [F.max(F.when(F.coalesce("state", F.lit(name)) == name, F.col("loaded_to"))) for name in states]
    reached = tuple(known.agg(*newest).first())
    last = None if None in reached else min(reached)
    news = clean if last is None else clean.where(F.col("loaded_at") >= as_time(last))
    days = distinct_days(news)
    if not days:
        return []
    touched = clean.where(F.col("date").isin(*days))
    with staging(spark) as stage:
        events = tables.analysis_frame(tables.clean_state(touched, as_of))
        if len(states) > 1:
            events = stage(events, "touched-days")
        for name in states:
            schema = STATES[name]
            rows = _BUILD[name](events).select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))
            # few rows a day; read twice only to empty days that have none left
            replace_days(stage(rows, f"state-{name}"), f"{state_path}/{name}", days=days)
        newest = touched.agg(F.max("loaded_at").alias("loaded_to"))
        newest = newest.withColumn("state", F.explode(F.array(*map(F.lit, states))))
        newest.write.mode("append").parquet(f"{state_path}/refreshes")
    return days


def activity_from_bitmaps(bitmaps: DataFrame, first_day: date) -> DataFrame:
    """The user activity mart of the days from ``first_day`` on; earlier days only fill the windows.

    A window of days is the union of their bitmaps, bucket by bucket. A bucket has one row for each
    observed day (also where it saw no user), so its windows are as many rows as there are days.
    """
    observed = distinct_days(bitmaps)
    if not observed:
        return bitmaps.limit(0).select("date", *(F.lit(0).cast("long").alias(n) for n in activity.SPANS)).withColumns(
            {f"{n}_to_dau_ratio": F.lit(None).cast("double") for n in ("wau", "mau")}
        )
    every_day = F.explode(F.array(*(F.lit(str(d)).cast("date") for d in observed)))
    grid = bitmaps.select("bucket").distinct().select("bucket", every_day.alias("date"))
    filled = grid.join(bitmaps, ["bucket", "date"], "left").withColumn("day", F.unix_date("date"))
    by_bucket = W.partitionBy("bucket").orderBy("day")
    counted = filled.select(
        "date",
        *(
            F.bitmap_count(F.bitmap_or_agg("users").over(by_bucket.rangeBetween(1 - span, 0))).alias(name)
            for name, span in activity.SPANS.items()
        ),
    )
    totals = counted.groupBy("date").agg(*(F.sum(name).alias(name) for name in activity.SPANS))
    ratio = {
        f"{name}_to_dau_ratio": F.try_divide(F.col(name).cast("double"), F.col("dau").cast("double"))
        for name in ("wau", "mau")
    }
    return activity.since(totals.withColumns(ratio), first_day)


def elements_from_sums(sums: DataFrame) -> DataFrame:
    """The element mart over all days of ``sums``."""

    def mean(axis: str):
        total, n = F.sum(f"sum_{axis}").cast("double"), F.sum(f"n_{axis}").cast("double")
        return F.coalesce(F.try_divide(total, n), F.lit(0.0)).alias(f"avg_{axis}")

    return (
        sums.groupBy("element_id")
        .agg(
            F.max("date").alias("date"), F.sum("views").alias("views"), F.sum("clicks").alias("clicks"),
            mean("x"), mean("y"),
        )
        .withColumn("conversion_rate", percent(F.col("clicks"), F.col("views")))
        .withColumn("total_interactions", F.col("views") + F.col("clicks"))
    )


def marts_from_state(
    spark: SparkSession, state_path: str, first_day: date, last_day: date, only: tuple[str, ...] = tuple(schemas.MARTS)
) -> dict[str, DataFrame]:
    """The marts of the days from ``first_day`` to ``last_day``, from stored state alone."""
    warm = first_day - timedelta(days=activity.WARMUP_DAYS)

    def state(name: str, low: date) -> DataFrame:
        table = tables.read_table(spark, f"{state_path}/{name}", STATES[name])
        return table.where(F.col("date").between(F.lit(str(low)).cast("date"), F.lit(str(last_day)).cast("date")))

    marts = {
        "user_activity_daily": lambda: activity_from_bitmaps(state("users", warm), first_day),
        "element_conversion": lambda: elements_from_sums(state("elements", first_day)),
        "session_metrics_daily": lambda: sessions.session_metrics_daily(
            activity.since(sessions.session_rollup(state("visits", warm)), first_day)
        ),
        "device_distribution_daily": lambda: devices.device_distribution_daily(state("visits", first_day)),
        "top_pages_daily": lambda: pages.top_pages_daily(pages.page_days(state("pages", first_day))),
    }
    return {name: mart() for name, mart in marts.items() if name in only}


def run_marts_from_state(
    spark: SparkSession, clean_path: str, state_path: str, marts_path: str, as_of: datetime,
    lookback_days: int = LOOKBACK_DAYS, only: tuple[str, ...] = tuple(schemas.MARTS),
) -> list[date]:
    """Refresh the states of the marts, then replace the days of the range in the mart tables.

    Same tables and rows as ``marts.run_marts`` writes for whole days; the events read are those of
    days with news, which are returned.
    """
    days = refresh(spark, clean_path, state_path, as_of, tuple(dict.fromkeys(_MADE_OF[name] for name in only)))
    last_day = as_of.date()
    first_day = last_day - timedelta(days=lookback_days)
    in_range = [first_day + timedelta(days=i) for i in range(lookback_days + 1)]
    with staging(spark) as stage:
        for name, mart in marts_from_state(spark, state_path, first_day, last_day, only).items():
            stamped = mart.select(*schemas.MARTS[name].names, as_time(as_of).alias("calculation_timestamp"))
            if name == "element_conversion":
                stamped = stamped.withColumn("run_date", F.lit(str(last_day)).cast("date"))
                replace_days(stamped, f"{marts_path}/{name}", "element_id", day="run_date", days=[last_day])
            else:
                replace_days(stage(stamped, name), f"{marts_path}/{name}", days=in_range)
    return days
