"""Session set-up and the shared folders a job may write to."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL_FOLDERS: dict[str, str] = {}  # by application, for local masters only


def get_session(app_name: str, **conf: str) -> SparkSession:
    """Start or get the session.

    ``SPARK_MASTER`` and ``SPARK_DRIVER_MEMORY`` are read from the environment.
    Under spark-submit the submitted master stands; otherwise the default is
    ``local[*]``. Timestamps are read, compared and truncated in UTC.
    """
    builder = SparkSession.builder.appName(app_name)
    master = os.environ.get("SPARK_MASTER")
    submitted = "PYSPARK_GATEWAY_PORT" in os.environ
    if master or not submitted:
        builder = builder.master(master or "local[*]")
        builder = builder.config(
            "spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "4g")
        )
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared work folder, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder on this machine; on a
    cluster executors elsewhere would not see it, so that is an error.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tallyshore-")
    return _LOCAL_FOLDERS[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoint() at the shared folder unless one is set already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
