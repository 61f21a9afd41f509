"""A session with the settings the library is written for."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "starweave", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the benchmark; a cluster brings its own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``. A local
    temporary folder is used only where that setting is missing and the whole
    session is one process (tests); elsewhere executors could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder shared by all executors of {master}")
        shared = tempfile.mkdtemp(prefix="starweave-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def free_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files go that nothing refers to any more. Spark removes them when the driver collects its garbage,
    which may be long after (``spark.cleaner.periodicGC.interval``) if the driver has little to do."""
    spark._jvm.System.gc()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a result that several branches of a plan use, and read it back.

    Column pruning differs between the branches, so Spark would otherwise
    compute it once for each. The copy survives lost executors.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
