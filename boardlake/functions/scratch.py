"""Text files in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a local session without it (tests) gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = os.path.join(tempfile.gettempdir(), f"boardlake-{os.getpid()}")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base.rstrip("/")


def text_files(lines: DataFrame, name: str, compression: str = "none") -> str:
    """Writes a DataFrame of one text column as files of lines and gives their folder."""
    path = f"{shared_folder(lines.sparkSession)}/{name}-{uuid.uuid4().hex}"
    lines.write.option("compression", compression).text(path)
    return path


def arrow_files(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, for tasks that read ranges of a file or write single files, and the path there."""
    return fs.FileSystem.from_uri("/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else path)
