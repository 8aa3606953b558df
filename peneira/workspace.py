"""Folders for the files a job writes on its way."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="peneira-")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: the session's ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. A cluster
    session without it is refused, since a folder on the driver's own disk
    would be out of reach of the executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_root()
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a new folder below the shared root, grouped by application.

    Each call gives another path, so a DataFrame reading an earlier folder
    stays valid. All folders of a run lie under ``<root>/peneira/<application
    id>`` and can be dropped together when the run's results are published.
    """
    app = spark.conf.get("spark.app.id", "app")
    return f"{shared_root(spark)}/peneira/{app}/{label}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder and all that is in it; False if there was none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def drop_folders(spark: SparkSession) -> bool:
    """Delete all folders this application has made below the shared root; False if there were none.

    For when its results are published: DataFrames that read them fail afterwards.
    """
    app = spark.conf.get("spark.app.id", "app")
    return drop_folder(spark, f"{shared_root(spark)}/peneira/{app}")
