"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Where a session on one machine remembers its temporary folder.
_OWN_FOLDER = "eventlake.scratch"

# Settings every job wants whatever the cluster size. Sizes (executors, memory,
# shuffle partitions) belong to the deployment and are left alone here.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session_builder(app: str = "eventlake") -> SparkSession.Builder:
    builder = SparkSession.builder.appName(app)
    for key, value in COMMON_CONF.items():
        builder = builder.config(key, value)
    return builder


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are instants; every date derived from one is a UTC date."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A session on one machine may leave the setting empty; it then gets a temporary folder,
    removed when the process ends. On a cluster such a folder would be another one on each machine, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_FOLDER, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir: the executors of a local cluster are processes of their own")
        folder = tempfile.mkdtemp(prefix="eventlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set(_OWN_FOLDER, folder)
    return folder.rstrip("/")


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused between calls."""
    return f"{shared_folder(spark)}/eventlake/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def sql_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Run a block under extra SQL settings (dots written as ``__``)."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
