"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_scratch: str | None = None


def local_session(cores: str = "*", name: str = "claimweft", **conf: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without the setting gets a folder of its own; a cluster
    session without it is an error, since a machine-local folder would not survive
    the loss of that machine.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="claimweft-")
    return _local_scratch


def staged_root(spark: SparkSession) -> str:
    """Folder of this application's staged tables; it can go once the application has ended."""
    return f"{scratch_dir(spark)}/staged/{spark.sparkContext.applicationId}"


def checkpoint_folder(spark: SparkSession) -> None:
    """Checkpoints of long lineages go to the folder of staged tables, where the session names no other."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{staged_root(spark)}/checkpoints")


def staged_path(spark: SparkSession, label: str) -> str:
    """A new place in the folder of staged tables."""
    return f"{staged_root(spark)}/{label}-{uuid.uuid4().hex}"


#: Rows that a pass of ``stage_in_passes`` takes, and its most passes.
PASS_ROWS, MAX_PASSES = 2_000_000, 4
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_table(df: DataFrame, label: str, tidy: bool = False) -> DataFrame:
    """Write a small derived table to the shared folder and read it back.

    This cuts the lineage and, because the files have a known size, lets the optimizer
    decide between a broadcast and a shuffled join from that size: a fresh aggregate
    would be estimated at the size of its input, and the big side of the join would be
    shuffled before adaptive execution found out that it did not need to be. With ``tidy`` the
    shuffle files of the write go when it has ended, not when the driver collects its garbage.
    """
    path = staged_path(df.sparkSession, label)
    _write(df, path, tidy)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _write(df: DataFrame, path: str, tidy: bool) -> None:
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    if tidy:
        conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            conf.set(_CLEANUP, before)


def stage_in_passes(df: DataFrame, label: str, keys: Sequence[str], n_rows: int) -> DataFrame:
    """``stage_table`` of a wide table that needs shuffles, over one hash range of ``keys`` after the other.

    Input is read once a pass, and only one pass's shuffle files are there at a time. ``n_rows`` tells the number of passes.
    """
    path = staged_path(df.sparkSession, label)
    parts = in_passes(df, keys, n_rows)
    for i, part in enumerate(parts):
        _write(part, f"{path}/{i}", tidy=True)
    return df.sparkSession.read.schema(df.schema).parquet(*[f"{path}/{i}" for i in range(len(parts))])


def in_passes(df: DataFrame, keys: Sequence[str], n_rows: int) -> list[DataFrame]:
    """``df`` by hash ranges of ``keys``, as many as ``n_rows`` asks for."""
    passes = max(1, min(MAX_PASSES, n_rows // PASS_ROWS))
    return [df] if passes == 1 else [df.filter(F.pmod(F.xxhash64(*keys), F.lit(passes)) == i) for i in range(passes)]


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a staged table that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    jvm = spark._jvm
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if f"/staged/{spark.sparkContext.applicationId}/" in folder:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
