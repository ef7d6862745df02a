"""Delimited and parquet files: readers, writers, per-client layout, manifests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.functions.text import MISSING_TOKENS, null_tokens, strip_delimiter


def text_schema(columns: Sequence[str]) -> T.StructType:
    """Every column as text; dirty extracts are typed after reading, not guessed."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _name(text: str) -> str:
    return text.lstrip("\ufeff").strip().strip('"').lower()


def _bound(schema: T.StructType, header: Sequence[str], files: Sequence[str], rest_in_order: bool) -> T.StructType:
    """The schema in the order of a file's header; columns that nobody asked for are text."""
    fields = {f.name.lower(): f for f in schema.fields}
    missing = [f for f in schema.fields if f.name.lower() not in header]
    spare = [i for i, name in enumerate(header) if name not in fields]
    if missing and not (rest_in_order and len(missing) <= len(spare)):
        raise ValueError(f"no column {[f.name for f in missing]} in {list(files)[:3]}")
    given = dict(zip(spare, missing, strict=False))
    out = [fields.get(name) or given.get(i) or T.StructField(f"_unused_{i}", T.StringType()) for i, name in enumerate(header)]
    return T.StructType(out)


def headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, header): the first line of every file that has one, found by one job over the files' first blocks."""
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start").withColumn("_at", F.monotonically_increasing_id())
    return lines.filter("file_block_start = 0").groupBy(F.col("file_path").alias("file")).agg(F.min_by("value", "_at").alias("header"))


def read_csv_by_name(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, sep: str = ",", rest_in_order: bool = False
) -> DataFrame:
    """CSV files with header, columns bound by the names in each file's own header.

    Files may order their columns differently and hold further ones; a file that lacks a column of
    the schema is an error. With ``rest_in_order`` the schema's names that a header lacks go to
    the header's other columns in their order. The headers are read first, all files in one
    job, and files with the same header are one scan.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in headers(spark, paths).orderBy("file").collect():
        by_header.setdefault(tuple(_name(n) for n in row.header.split(sep)), []).append(unquote(row.file))
    parts = [
        spark.read.schema(_bound(schema, header, files, rest_in_order)).option("sep", sep).option("header", True).csv(files).select(*schema.names)
        for header, files in by_header.items()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_pipe_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, only_na: bool = False
) -> DataFrame:
    """Pipe-separated files with header, plain or bzip2 (which Spark splits); columns by name.

    ``only_na`` treats just the token NA as missing; otherwise every usual token is.
    """
    df = read_csv_by_name(spark, paths, schema, "|")
    text = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    if only_na:
        # the reader gives NULL for an empty field, which is text of its own here
        whole = {c: F.coalesce(F.col(c), F.lit("")) for c in text}
        return df.withColumns({c: null_tokens(v, ["NA"]) for c, v in whole.items()})
    return df.withColumns({c: null_tokens(F.col(c), MISSING_TOKENS) for c in text})


def read_dimension(spark: SparkSession, path: str, schema: T.StructType, key: str, blank: str = "(blank)") -> DataFrame:
    """Small comma-separated dimension; the pivot-table row for blanks is left out.

    Columns named as in the header are bound by name, the schema's other names in order.
    """
    df = read_csv_by_name(spark, path, schema, rest_in_order=True)
    return df.filter(F.col(key).isNotNull() & (F.trim(key) != blank))


def read_parts(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Same-shaped CSV parts (one per former workbook sheet) as one table."""
    return read_csv_by_name(spark, list(paths), schema)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_per_client(spark: SparkSession, path_glob: str, schema: T.StructType, folder_level: int = 3, sep: str = ",") -> DataFrame:
    """Per-client report files stacked, each row tagged with the client folder of its file.

    ``folder_level`` counts path parts from the end: 1 is the file, 2 its folder, 3 the one above.
    """
    tail = r"/[^/]+" * (folder_level - 1)
    rows = read_csv_by_name(spark, path_glob, schema, sep)
    return rows.withColumn("pcode", F.url_decode(F.regexp_extract(F.input_file_name(), rf"/([^/]+){tail}$", 1)))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrites the whole folder, or with ``partition_by`` only the partitions that ``df`` has."""
    _overwriting(df, partition_by).parquet(path)


def _overwriting(df: DataFrame, partition_by: Sequence[str]) -> DataFrameWriter:
    mode = "dynamic" if partition_by else "static"
    return df.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partition_by)


def write_model_table(df: DataFrame, root: str, start: str, end: str, pull_date: str) -> str:
    """Parquet under a window folder, the pull date as partition; returns the folder."""
    path = f"{root}/model_{start}_to_{end}"
    _overwriting(df.withColumn("pull_date", F.lit(pull_date)), ["pull_date"]).parquet(path)
    return path


def write_pipe_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Pipe-separated bzip2 files with header, NA for missing values; other partitions stay."""
    (
        _overwriting(df, partition_by)
        .option("header", True)
        .option("sep", "|")
        .option("nullValue", "NA")
        .option("emptyValue", "")
        .option("compression", "bzip2")
        .csv(path)
    )


def write_sample(df: DataFrame, path: str, n: int = 100_000) -> None:
    """One pipe-separated bzip2 file with the first ``n`` rows, delimiters removed from text."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    clean = df.limit(n).withColumns({c: strip_delimiter(F.col(c)) for c in text})
    clean.coalesce(1).write.mode("overwrite").option("header", True).option("sep", "|").option(
        "compression", "bzip2"
    ).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_per_client(df: DataFrame, path: str, keys: Sequence[str] = ("pcode", "pull_date")) -> None:
    """One folder per client and pull date, whatever the client's size.

    Rows are not gathered per client first: a client holding a third of all rows is written by
    many tasks, each adding its own file to the folder. Folders of other clients and of earlier
    pulls are left alone; those of the same client and pull are replaced.
    """
    _overwriting(df, keys).parquet(path)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """(file, n_bytes, modified) of all files with content under a folder; only Spark's listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(F.col("path").alias("file"), F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified"))


def file_manifest(spark: SparkSession, rows: DataFrame, root: str, expected: DataFrame, client: str = "pcode") -> DataFrame:
    """(client, n_files, n_bytes, n_rows, state) per expected client of the files under ``root`` that ``rows`` are read from.

    ``state`` is ``missing`` (no file), ``empty`` (files of no bytes), ``header only`` (bytes, but no row: the
    extract ran and found nothing) or ``ok``. Clients are told by the folders ``<client>=...``.
    """
    folder = F.url_decode(F.replace(F.regexp_extract("file", rf"/{client}=([^/]+)/", 1), F.lit("+"), F.lit("%2B")))
    # files without bytes are in the index of the rows' files only, whose addresses are encoded once more
    known = spark.createDataFrame([(unquote(f), 0) for f in rows.inputFiles()], "file string, n_bytes long").withColumn("n", F.lit(1))
    sized = listing(spark, root).select("file", "n_bytes", F.lit(0).alias("n"))
    found = known.unionByName(sized).withColumn(client, folder).filter(F.col(client) != "")
    files = found.groupBy(client).agg(F.sum("n").alias("n_files"), F.sum("n_bytes").alias("n_bytes"))
    counts = rows.groupBy(F.col(client).cast("string").alias(client)).agg(F.count("*").alias("n_rows"))
    wanted = expected.select(F.col(client).cast("string").alias(client)).distinct()
    whole = wanted.join(files, client, "left").join(counts, client, "left").fillna(0, ["n_files", "n_bytes", "n_rows"])
    state = F.when(F.col("n_files") == 0, "missing").when(F.col("n_bytes") == 0, "empty").when(F.col("n_rows") == 0, "header only").otherwise("ok")
    return whole.withColumn("state", state)
