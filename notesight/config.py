"""Settings of a run, and the few session helpers every job shares."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JobConfig:
    data_dir: str
    model_dir: str
    seed: int = 12345
    splits: tuple[float, ...] = (30.0,)
    skip_elective: bool = False
    test_ratio: float = 0.15
    validation_ratio: float = 0.0
    cleaner: str | None = "notes"
    featurizer: str = "bag_of_words"
    learner: str = "lr"
    csv_copies: bool = False  # also write the combined table, vectors and predictions as CSV, for people


def local_session(app: str = "notesight", cpus: str | None = None, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`; only a session of one process falls back to a folder
    of its own, and keeps it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="notesight-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Cut the lineage of `df` by a reliable checkpoint in the shared folder, so that iterative fits do not redo the text
    work and a lost executor does not lose it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by `keys` only if the scan has fewer splits than the cluster has cores (one small
    file, say). A large table already has more splits than that and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
