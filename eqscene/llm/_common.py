"""Small helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: A table is sent to all executors only if its values, as text, and 16 bytes for each take less.
BROADCAST_BYTES = 64_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may lack the setting; it then gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def staged_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read again, where lineage ends; and its folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, label: str) -> DataFrame:
    return staged_at(df, label)[0]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str | Column = "text") -> Column:
    """The text, a null one as the empty string."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A staged ``df`` with a broadcast hint when its bytes, which are added up, stay within ``most``, else as it is."""
    wide = sum((F.octet_length(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) + 16 for c in df.columns), F.lit(0))
    return F.broadcast(df) if (df.agg(F.sum(wide)).first()[0] or 0) <= most else df
