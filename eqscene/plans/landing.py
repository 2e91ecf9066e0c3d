"""Rows of the driver's tables landed as files of the shapes that the readers take."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which driver and executors share; a local session without it gets a folder of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="spark-")
    return found.rstrip("/")


def landed(rows: DataFrame, key: str, item: Column, root: str | None = None, most: int = 1000) -> str:
    """The folder of one JSON file for every ``most`` values of the whole number ``key``: an array of
    items, or an object that holds it under ``root``.
    """
    path = f"{shared_dir(rows.sparkSession)}/landed-{uuid4().hex}"
    items = F.collect_list(item)
    value = F.to_json(F.struct(items.alias(root)) if root else items)
    rows.groupBy(F.floor(F.col(key) / most).alias("part")).agg(value.alias("value")).write.partitionBy("part").text(path)
    return path


def staged(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written once to the shared folder and read again; what is used several times is then made once."""
    path = f"{shared_dir(rows.sparkSession)}/{label}-{uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
