"""The folder for intermediate data."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SHARED_FOLDER_SETTING = "spark.checkpoint.dir"
WAREHOUSE_SETTING = "spark.sql.warehouse.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; where it names none, a folder below the session's warehouse."""
    root = spark.conf.get(SHARED_FOLDER_SETTING, None)
    if root:
        return root.rstrip("/")
    return spark.conf.get(WAREHOUSE_SETTING).rstrip("/") + "/_scratch"


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
