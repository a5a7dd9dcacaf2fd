"""Tables on a path, partitioned by day, and their range scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..functions.timestamps import as_time
from ..operators import keyed

_DAY = T.StructField("date", T.DateType())


def _extended(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType(
        [*schema.fields, *(T.StructField(name, kind) for name, kind in fields), _DAY]
    )


RAW_TABLE = _extended(schemas.RAW, ("ingested_at", schemas.TS), ("source", schemas.S))
CLEAN_TABLE = _extended(schemas.CLEAN, ("loaded_at", schemas.TS), ("expires_at", schemas.TS))
INVALID_TABLE = _extended(schemas.INVALID, ("expires_at", schemas.TS))
PROCESSED_TABLE = T.StructType(
    [*(schemas.RAW[name] for name in schemas.RAW_KEY), T.StructField("ingested_at", schemas.TS), _DAY]
)


def mart_table(name: str) -> T.StructType:
    fields = [*schemas.MARTS[name].fields, T.StructField("calculation_timestamp", schemas.TS)]
    if name == "element_conversion":
        return T.StructType([*fields, T.StructField("run_date", T.DateType())])
    return T.StructType([*(f for f in fields if f.name != "date"), _DAY])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, may_be_absent: bool = False
) -> DataFrame:
    """The table at ``path``. Only one that the job itself creates ``may_be_absent``: it is empty then."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if not may_be_absent or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def time_range(df: DataFrame, low, high, closed: bool = False) -> DataFrame:
    """``low <= created_at < high`` (``<= high`` if closed); prunes day partitions if there are any."""
    start, end = as_time(low), as_time(high)
    created = F.col("created_at")
    if "date" in df.columns:
        df = df.where(F.col("date").between(F.to_date(start), F.to_date(end)))
    return df.where((created >= start) & ((created <= end) if closed else (created < end)))


def raw_window(raw: DataFrame, low, high) -> DataFrame:
    """Raw rows of ``[low, high)``."""
    return time_range(raw, low, high)


def clean_window(clean: DataFrame, low, high) -> DataFrame:
    """Clean rows of ``[low, high]`` as the analysis frame."""
    rows = time_range(clean, low, high, closed=True)
    return analysis_frame(rows)


def analysis_frame(clean: DataFrame) -> DataFrame:
    """Clean rows under their analysis names; a coordinate of 0 counts as unknown."""
    renamed = clean.select(*schemas.CLEAN_COLUMNS).withColumnsRenamed(
        {"id": "event_id", "type": "event_type"}
    )
    return renamed.withColumns({axis: F.nullif(axis, F.lit(0)) for axis in ("x", "y")})


def invalid_state(invalid: DataFrame, as_of) -> DataFrame:
    """Unexpired quarantine rows, one per key: the verdict written last."""
    return keyed.last_write_wins(keyed.unexpired(invalid, as_of), schemas.INVALID_KEY, ("processed_at",))


def clean_state(clean: DataFrame, as_of) -> DataFrame:
    """Unexpired clean rows, one per key."""
    return keyed.last_write_wins(keyed.unexpired(clean, as_of), schemas.CLEAN_KEY, ("loaded_at",))
