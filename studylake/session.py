"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "studylake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with adaptive execution and UTC; ``master`` only for local runs."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


#: Set while ``scratch_run`` is open: the folder of the run.
_RUN = "studylake.scratch.run"


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, that of the open run if there is one.

    It is named by ``spark.checkpoint.dir``. A temporary folder, gone with this
    process, is made only when the setting is absent and driver and executors are
    one process; on any cluster a missing setting is an error.
    """
    folder = spark.conf.get(_RUN, None) or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="studylake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables of the block go to one folder, removed when it ends.

    What the block returns must not read them any more: store it elsewhere first.
    """
    folder = f"{scratch_folder(spark)}/run-{uuid.uuid4().hex}"
    before = spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, folder)
    try:
        yield folder
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        remove_folder(folder)


def remove_folder(path: str) -> None:
    """Delete a folder in any store that Arrow reaches; a missing one is no error."""
    files, place = fs.FileSystem.from_uri(path)
    if files.get_file_info(place).type == fs.FileType.Directory:
        files.delete_dir(place)


def materialize(df: DataFrame, file_rows: int = 0) -> DataFrame:
    """``df`` written as a table in the scratch folder and read back.

    Cuts the lineage and fixes every value, so partition-dependent columns stay
    what they were when an executor is lost. Readers still prune columns. With ``file_rows``
    no file has more rows: narrow rows compress so well that a task would else read too many.
    """
    path = f"{scratch_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
