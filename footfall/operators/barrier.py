"""Keeps costly columns from being computed twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the given columns added, each computed once per row.

    Spark pushes a filter on a computed column below the projection that computes it, with the
    whole expression copied into the filter: a row would be parsed again for every mention. A
    filter on the output of a generator stays above it. Filters on columns that ``df`` has already
    still move down to the scan.
    """
    computed = {f"computed_{name}": column for name, column in columns.items()}
    # The projection does the work in generated code; the generator only passes its results on.
    projected = df.select("*", *(column.alias(name) for name, column in computed.items()))
    row = F.struct(*(F.col(f"computed_{name}").alias(name) for name in columns))
    return projected.select(*df.columns, F.inline(F.array(row)))
