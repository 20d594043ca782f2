"""Session defaults for local runs; a cluster brings its own settings."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, name: str = "spindrift", **conf: str) -> SparkSession:
    """A local[N] session in UTC with adaptive execution and shuffle partitions sized to the cores."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPINDRIFT_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoints(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, that driver and executors share; one in the temporary folder where none is set
    and all run in one process. A cluster without one is an error: executors would write to their own disks."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = f"file://{os.path.join(tempfile.gettempdir(), 'spindrift-checkpoints')}"
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoints(spark).rstrip('/')}/spindrift-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
