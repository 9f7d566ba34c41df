"""Sessions with the settings that the engine assumes; and a checkpoint folder where none is named."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(app: str = "siltstone", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=SETTINGS | settings).getOrCreate()


def ensure_checkpoints(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; only where it is unset and all runs in one machine, a temporary one that goes at exit."""
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if context.getCheckpointDir():
            return context.getCheckpointDir()
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="siltstone-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named
