"""Shared folder for staged tables."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder that the session names in `spark.checkpoint.dir`.

    Only a local session may do without that setting; a machine-local folder would not be seen
    by other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.mkdtemp(prefix="orderlake-")
    return f"{folder.rstrip('/')}/orderlake/{purpose}-{uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function that writes a frame to the shared folder and reads it back.

    When the block ends well its copies are deleted; if it fails they stay, for whoever looks into it.
    """
    paths = []

    def staged(df: DataFrame, purpose: str) -> DataFrame:
        paths.append(scratch_path(spark, purpose))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    yield staged
    delete_paths(spark, paths)


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete files or folders, in whatever file system they are; those that are not there are passed over."""
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(configuration).delete(place, True)
