"""Tables with a key: duplicates, upsert, delete, expiry.

No row of a key is ever ranked inside one task. The winner of a key is an aggregate, so map tasks
reduce a hot key to one row each before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .. import schemas
from ..functions.events import DUPLICATE_NAMES, duplicate_coordinates
from ..functions.text import last_of_each
from ..functions.timestamps import as_time


def keep_one(
    df: DataFrame,
    keys: tuple[str, ...],
    order: tuple[str, ...],
    last: bool,
    computed_keys: tuple[Column, ...] = (),
) -> DataFrame:
    """One whole row per key: the first or last one by ``order``, then by all other columns.

    The remaining columns break ties, so the result does not depend on the scan order.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    ranked = [*order, *rest]
    # Maps have no order; their sorted entries do. Stored maps may repeat a key.
    maps = {name for name in ranked if isinstance(df.schema[name].dataType, T.MapType)}
    row = F.struct(
        *(
            (F.array_sort(last_of_each(F.map_entries(name))) if name in maps else F.col(name)).alias(name)
            for name in ranked
        )
    )
    grouped = df.groupBy(*keys, *(c.alias(f"key_{i}") for i, c in enumerate(computed_keys)))
    winners = grouped.agg((F.max(row) if last else F.min(row)).alias("row"))
    values = {name: F.col(name) for name in keys} | {name: F.col(f"row.{name}") for name in ranked}
    values |= {name: F.map_from_entries(values[name]) for name in maps}
    return winners.select(*(values[name].alias(name) for name in df.columns))


def first_seen(events: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Drop repeats of an event, keeping the first by ``order``."""
    return keep_one(events, DUPLICATE_NAMES, order, False, duplicate_coordinates())


def last_write_wins(
    df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = ("ingested_at",)
) -> DataFrame:
    """The state of an append-only table: for every key the row written last."""
    return keep_one(df, keys, order, last=True)


def delete_processed(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is not listed. A null in the key matches nothing, so such rows stay."""
    return rows.join(keys.select(*schemas.RAW_KEY), list(schemas.RAW_KEY), "left_anti")


def unexpired(df: DataFrame, as_of) -> DataFrame:
    return df.where(F.col("expires_at") > as_time(as_of))


def expired(df: DataFrame, as_of) -> DataFrame:
    return df.where(F.col("expires_at") <= as_time(as_of))


def late_rows(raw: DataFrame, window_start) -> DataFrame:
    """Rows older than the cleaning window, which no run will pick up again."""
    return raw.where(F.col("created_at") < as_time(window_start))


def latest_snapshot(
    mart: DataFrame, keys: tuple[str, ...] = ("date",), stamp: str = "calculation_timestamp"
) -> DataFrame:
    """Of an append-only mart, the rows of the latest run for every key."""
    newest = mart.groupBy(*keys).agg(F.max(stamp).alias(stamp))
    return mart.join(newest, [*keys, stamp], "left_semi")
