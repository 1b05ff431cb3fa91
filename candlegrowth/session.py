"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name="candlegrowth", **conf):
    """A session with adaptive execution on; the master and sizes come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark):
    """The folder all executors see, as the cluster names it.

    A machine-local folder is only taken in local mode, where driver and executors share it.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="candlegrowth-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark, name):
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
