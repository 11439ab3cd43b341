"""Vector columns taken apart."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


def split_array(df: DataFrame, column: str, width: int) -> DataFrame:
    """Replace an array column by `column_0 .. column_{width-1}`."""
    kept = [F.col(name) for name in df.columns if name != column]
    return df.select(*kept, *[F.get(column, F.lit(i)).alias(f"{column}_{i}") for i in range(width)])


def split_vector(df: DataFrame, column: str, width: int | None = None) -> DataFrame:
    """The same for an ML vector. The width comes from the column's ML metadata when not given, so
    neither a job nor a first row is needed, and an empty table works."""
    if width is None:
        width = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
        if width is None:
            raise ValueError(f"column {column} does not carry its size; pass width")
    return split_array(df.withColumn(column, vector_to_array(column)), column, width)
