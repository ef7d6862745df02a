"""Published tables: a reader sees the last complete version or the one before, never half of one.

A version is written aside, in a folder of its own. Only when that write has ended is a row added to
the table's log (version, folder, rows); readers take the folder of the newest row. A write that fails
leaves a folder that no row names, and the log as it was. Nothing that readers may be reading is
ever overwritten or removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "version long, folder string, n_rows long, published_at timestamp"


def publish_log(spark: SparkSession, root: str) -> DataFrame:
    """The versions of a table, none if it has not been published."""
    try:
        return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def write_aside(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """(folder, rows) of a version that nobody sees yet; its rows are counted from the files' footers."""
    folder = f"versions/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/{folder}")
    return folder, df.sparkSession.read.parquet(f"{root}/{folder}").count()


def announce(spark: SparkSession, root: str, folder: str, n_rows: int) -> int:
    """Makes a written version the current one; returns its number. The row's file appears at once or not at all."""
    version = (publish_log(spark, root).agg(F.max("version")).first()[0] or 0) + 1
    row = spark.createDataFrame([(version, folder, n_rows)], "version long, folder string, n_rows long")
    row.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{root}/log")
    return version


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> int:
    """Writes ``df`` aside and then makes it the table's current version."""
    return announce(df.sparkSession, root, *write_aside(df, root, partition_by))


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The current (or the given) version. Two publishers of one number: the later row counts, then the folder's name."""
    log = publish_log(spark, root)
    rows = log if version is None else log.filter(F.col("version") == version)
    last = rows.orderBy(F.desc("version"), F.desc("published_at"), F.desc("folder")).first()
    if last is None:
        raise ValueError(f"nothing has been published under {root}")
    return spark.read.parquet(f"{root}/{last.folder}")
