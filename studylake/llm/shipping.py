"""Python code for the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable

import studylake
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once for each application.

    Spark's file server carries the archive, so the package need not be installed there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(studylake.__file__)))
    package = os.path.basename(os.path.dirname(os.path.abspath(studylake.__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{package}-"), f"{package}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder in (package, f"{package}/llm"):
            for name in sorted(os.listdir(os.path.join(root, folder))):
                if name.endswith(".py"):
                    out.write(os.path.join(root, folder, name), f"{folder}/{name}")
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def map_batches(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
