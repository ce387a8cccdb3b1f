"""Session factory and run-time settings shared by every operator."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(app: str = "quayline", cpus: str | None = None, **conf: str) -> SparkSession:
    """A local session with the settings that the operators rely on: UTC, ANSI, AQE."""
    cores = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("QUAYLINE_DRIVER_MEMORY", "8g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Folders of our own making, by process; they are removed when it ends.
_OWN: list[str] = []
#: Tables written for this session; ``release`` removes them.
_WRITTEN: list[str] = []


def _own_folder(spark: SparkSession) -> str:
    """A temporary folder where one machine is all there is; a cluster has to name one that all executors share."""
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"spark.checkpoint.dir is not set, and a folder of this machine is of no use to {master}")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="quayline-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return _OWN[0]


def _named_folder(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors see: under the checkpoint folder of the cluster, our own only where none is named."""
    return f"{(_named_folder(spark) or _own_folder(spark)).rstrip('/')}/quayline-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage by a table in the shared folder.

    Unlike a checkpoint of rows it is compressed, read by columns, and its size is known, so that the planner
    broadcasts it only if it is as small as the session allows.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove the tables that ``written`` made; what was read from them must be done with."""
    jvm = spark.sparkContext._jvm
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, by exact name, whatever other columns clash with them in case or are there twice."""
    have = df.columns
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"columns are missing: {missing}")
    places = [have.index(n) for n in names]
    return df.toDF(*[f"_{k}" for k in range(len(have))]).select(*[F.col(f"_{k}").alias(n) for k, n in zip(places, names)])


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions the cluster was configured for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
