"""Intermediate tables in the folder that all executors share, and the package on executors that lack it."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

import strandmart
from strandmart.session import shared_folder

_SENT: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Send the package along with the application, unless Python's path or the working folder has it for all."""
    root = Path(strandmart.__file__).resolve().parents[1]
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if root not in (*paths, Path.cwd().resolve()) and context.applicationId not in _SENT:
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/strandmart", "zip", root, "strandmart"))
        _SENT.add(context.applicationId)
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, under ``spark.checkpoint.dir``."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table aside and read it back: the plan is cut, and a lost executor loses none of it."""
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
