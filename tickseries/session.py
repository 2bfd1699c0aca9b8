"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """Fix the session time zone: in a zone with daylight saving two instants share one calendar minute."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(app_name: str = "tickseries", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder for `purpose` below the folder named in `spark.checkpoint.dir`.

    That folder is shared by all executors of a cluster. Only a local master, which is
    its own single executor, may run without the setting; it then gets a temporary folder. Tables stay there as long as
    a result may read them: who sets the folder removes it after the application.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/tickseries/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once to the working folder and read it back, which also cuts its lineage."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
