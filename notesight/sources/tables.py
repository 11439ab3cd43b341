"""Stage tables: Parquet or CSV folders written in parallel, found again by their success marker."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from notesight.functions.vectors import split_vector
from notesight.sources.quoted_csv import read_quoted_csv


def path_exists(spark: SparkSession, path: str) -> bool:
    """Works on any file system Spark reads; one look-up, no listing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def is_finished(spark: SparkSession, path: str) -> bool:
    """True if a writer has completed the folder."""
    return path_exists(spark, os.path.join(path, "_SUCCESS"))


def load_table(
    spark: SparkSession, name: str, data_dir: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """A table by file name: CSV with a header (all strings unless a schema is given) or Parquet. A missing
    table is empty and has the given schema. Only a CSV file with line breaks inside fields needs `multi_line`."""
    path = os.path.join(data_dir, name)
    if not path_exists(spark, path):
        if schema is None:
            raise FileNotFoundError(f"{path} is missing and no schema was given for an empty table")
        return spark.createDataFrame([], schema)
    if ".csv" in name and multi_line:
        return read_quoted_csv(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if ".csv" in name:
        return reader.option("header", True).option("escape", '"').csv(path)
    return reader.parquet(path)


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another one. The old one is moved aside and deleted last, so that it is there,
    under one name or the other, whenever this breaks off."""
    place, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{new}-old"))
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(place) and not files.rename(place, old):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(new), place):
        raise OSError(f"{new} cannot be moved to {path}")
    if files.exists(old):
        files.delete(old, True)


def save_table(df: DataFrame, name: str, data_dir: str, single_file: bool = False) -> str:
    """Write a table by file name, replacing the old one once the new one is complete; so `df` may read the old one. An
    empty table replaces it by an empty one. `single_file` is for reports that are known to be small."""
    path = os.path.join(data_dir, name)
    new = os.path.join(data_dir, f".{name}-{uuid.uuid4().hex}")
    writer = (df.coalesce(1) if single_file else df).write
    if ".csv" in name:
        writer.option("header", True).option("escape", '"').csv(new)
    else:
        writer.parquet(new)
    replace_folder(df.sparkSession, new, path)
    return path


def save_vectors_csv(df: DataFrame, column: str, name: str, data_dir: str, width: int | None = None) -> str:
    """A table with a vector column as CSV, one column per slot."""
    return save_table(split_vector(df, column, width), name, data_dir)


def load_word_list(spark: SparkSession, path: str, lower: bool = False) -> DataFrame:
    """(term), one per line; line ends and empty lines dropped, everything else kept."""
    term = F.regexp_replace("value", "[\r\n]+$", "")
    terms = spark.read.text(path).select((F.lower(term) if lower else term).alias("term"))
    return terms.filter("term != ''").distinct()
