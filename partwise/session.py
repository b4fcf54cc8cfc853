"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates: the session's ``spark.checkpoint.dir``.

    Only a local session may go without the setting; there all tasks share one
    machine, so a temporary folder is a shared folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    root = tempfile.mkdtemp(prefix="partwise-")
    context.setCheckpointDir(root)
    return root


def new_scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder; nothing is created yet."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/partwise-{app}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below the scratch folder and read back: the same rows for every use."""
    path = new_scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def child_session(spark: SparkSession, **settings: object) -> SparkSession:
    """A session of its own settings over the same application (``__`` stands for a dot).

    What others do on ``spark`` meanwhile does not see them.
    """
    child = spark.newSession()
    for key, value in settings.items():
        child.conf.set(key.replace("__", "."), str(value))
    return child
