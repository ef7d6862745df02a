"""Files written and read back; database reads through a recording stand-in."""

import bz2
import os
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimweft.session import scratch_dir, stage_table
from claimweft.sources import files, jdbc, publish


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_bz2_pipe_csv_round_trip(spark, folder):
    df = spark.createDataFrame([("1", "a|b"), ("2", None), ("3", "")], "id string, name string")
    path = f"{folder}/out"
    files.write_pipe_csv(df, path)
    assert all(f.endswith(".bz2") for f in os.listdir(path) if f.startswith("part"))
    text = "".join(bz2.open(f"{path}/{f}", "rt").read() for f in sorted(os.listdir(path)) if f.startswith("part"))
    assert "id|name" in text and "2|NA" in text
    schema = files.text_schema(["id", "name"])
    usual = {r.id: r.name for r in files.read_pipe_csv(spark, path, schema).collect()}
    assert usual == {"1": "a|b", "2": None, "3": None}
    only = {r.id: r.name for r in files.read_pipe_csv(spark, path, schema, only_na=True).collect()}
    assert only == {"1": "a|b", "2": None, "3": ""}


def test_usual_missing_tokens(spark, folder):
    with open(f"{folder}/a.csv", "w") as f:
        f.write("id|v\n1|nan\n2|NULL\n3|x\n4|N/A\n")
    got = files.read_pipe_csv(spark, f"{folder}/a.csv", files.text_schema(["id", "v"])).collect()
    assert [r.v for r in got] == [None, None, "x", None]


def test_dimension_with_bom_and_blank_row(spark, folder):
    with open(f"{folder}/rates.csv", "wb") as f:
        f.write(b"\xef\xbb\xbfPARENT_CLIENT,Average of MINIMUM_RATE,Average of WEIGHTED_AVERAGE_RATE\nABC-P,0.1,0.2\n(blank),,\n")
    schema = T.StructType().add("PARENT_CLIENT", "string").add("min_rate", "double").add("avg_rate", "double")
    got = files.read_dimension(spark, f"{folder}/rates.csv", schema, "PARENT_CLIENT").collect()
    assert [tuple(r) for r in got] == [("ABC-P", 0.1, 0.2)]


def test_parts_and_per_client_tag(spark, folder):
    for client in ("ABC-P", "DEF P"):
        os.makedirs(f"{folder}/{client}/summary")
        with open(f"{folder}/{client}/summary/out.csv", "w") as f:
            f.write("month,n\n2024-01,1\n")
    schema = T.StructType().add("month", "string").add("n", "integer")
    got = files.read_per_client(spark, f"{folder}/*/summary/*.csv", schema)
    assert sorted((r.pcode, r.n) for r in got.collect()) == [("ABC-P", 1), ("DEF P", 1)]
    parts = [f"{folder}/{c}/summary/out.csv" for c in ("ABC-P", "DEF P")]
    assert files.read_parts(spark, parts, schema).count() == 2


def test_manifest_lists_missing_clients(spark, folder):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "pcode string, n int")
    files.write_per_client(df.withColumn("pull_date", F.lit("2025-01-09")), f"{folder}/t")
    assert os.path.isdir(f"{folder}/t/pcode=A/pull_date=2025-01-09")
    expected = spark.createDataFrame([("A",), ("B",), ("C",)], "pcode string")
    got = {r.pcode: r.n_rows for r in files.file_manifest(spark, files.read_parquet(spark, f"{folder}/t"), f"{folder}/t", expected).collect()}
    assert got == {"A": 2, "B": 1, "C": 0}


def test_second_pull_and_other_client_leave_folders_alone(spark, folder):
    first = spark.createDataFrame([("A", "2025-01-09", 1), ("B", "2025-01-09", 2)], "pcode string, pull_date string, n int")
    second = spark.createDataFrame([("A", "2025-02-09", 3)], "pcode string, pull_date string, n int")
    again = spark.createDataFrame([("A", "2025-02-09", 4)], "pcode string, pull_date string, n int")
    for df in (first, second, again):
        files.write_per_client(df, f"{folder}/c")
        files.write_parquet(df, f"{folder}/p", ["pcode", "pull_date"])
        files.write_pipe_csv(df, f"{folder}/t", ["pcode", "pull_date"])
    for got in (spark.read.parquet(f"{folder}/c"), spark.read.parquet(f"{folder}/p"), spark.read.option("sep", "|").option("header", True).csv(f"{folder}/t")):
        assert sorted((r.pcode, int(r.n)) for r in got.collect()) == [("A", 1), ("A", 4), ("B", 2)]


def test_columns_are_bound_by_name(spark, folder):
    os.makedirs(f"{folder}/in")
    for name, text in (("a", "x|y\n1|2\n"), ("b", "y|extra| X \n4|e|3\n"), ("empty", "")):
        with open(f"{folder}/in/{name}.csv", "w") as f:
            f.write(text)
    got = files.read_pipe_csv(spark, f"{folder}/in", files.text_schema(["x", "y"]))
    assert sorted(tuple(r) for r in got.collect()) == [("1", "2"), ("3", "4")]
    with pytest.raises(ValueError, match="z"):
        files.read_pipe_csv(spark, f"{folder}/in/a.csv", files.text_schema(["x", "z"]))


def test_manifest_tells_empty_from_missing(spark, folder):
    for client, text in (("A", "n|v\n1|x\n2|y\n"), ("B", "n|v\n"), ("C", ""), ("D+E%20F", "n|v\n1|x\n")):
        os.makedirs(f"{folder}/t/pcode={client}")
        with open(f"{folder}/t/pcode={client}/out.csv", "w") as f:
            f.write(text)
    rows = spark.read.option("header", True).option("sep", "|").schema("n int, v string").csv(f"{folder}/t")
    expected = spark.createDataFrame([("A",), ("B",), ("C",), ("D+E F",), ("G",)], "pcode string")
    got = {r.pcode: (r.n_files, r.n_bytes, r.n_rows, r.state) for r in files.file_manifest(spark, rows, f"{folder}/t", expected).collect()}
    assert got == {"A": (1, 12, 2, "ok"), "B": (1, 4, 0, "header only"), "C": (1, 0, 0, "empty"), "D+E F": (1, 8, 1, "ok"), "G": (0, 0, 0, "missing")}


def test_headers_of_many_files_are_one_job(spark, folder):
    os.makedirs(f"{folder}/in")
    for i in range(200):
        with open(f"{folder}/in/f {i}.csv", "w") as f:
            f.write(("a|b\n" if i % 2 else "b|extra|a\n") + (f"{i}|x\n" if i % 2 else f"x|e|{i}\n") * 3)
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    try:
        found = {r.header for r in files.headers(spark, f"{folder}/in").collect()}
        jobs = len(sc.statusTracker().getJobIdsForGroup("headers"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert found == {"a|b", "b|extra|a"} and jobs <= 2  # adaptive execution runs the shuffle as a job of its own
    got = files.read_pipe_csv(spark, f"{folder}/in", files.text_schema(["a", "b"]))
    assert got.count() == 600 and {r.b for r in got.select("b").distinct().collect()} == {"x"}
    assert got.select("a").distinct().count() == 200


def test_published_versions(spark, folder, monkeypatch):
    root = f"{folder}/table"
    with pytest.raises(ValueError, match="nothing"):
        publish.read_published(spark, root)
    assert publish.publish(spark.range(3), root) == 1
    assert publish.publish(spark.range(5).withColumn("p", F.col("id") % 2), root, ["p"]) == 2
    assert publish.read_published(spark, root).count() == 5 and publish.read_published(spark, root, 1).count() == 3
    assert [(r.version, r.n_rows) for r in publish.publish_log(spark, root).orderBy("version").collect()] == [(1, 3), (2, 5)]
    # a write that breaks off
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish.publish(broken, root)
    assert publish.read_published(spark, root).count() == 5
    # killed between the two steps
    monkeypatch.setattr(publish, "announce", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark.range(9), root)
    assert publish.read_published(spark, root).count() == 5


def test_predicates_of_equal_rows(spark):
    start = date(2024, 1, 1)
    days = [(start + timedelta(days=i), 10 + 1000 * (i == 40) + 300 * (i in (7, 8))) for i in range(100)] + [(None, 50)]
    rows = [(d, i) for d, n in days for i in range(n)] + [(date(2030, 1, 1), 1), (date(2000, 1, 1), 2)]
    df = spark.createDataFrame(rows, "d date, k long").cache()
    predicates = jdbc.balanced_predicates("d", days[::-1], 8)
    counts = [df.filter(p).count() for p in predicates]
    assert sum(counts) == len(rows) and counts[-1] == 52
    share = sum(n for d, n in days if d) / 8
    assert 1010 in counts and all(n <= 1.5 * share for n in counts[:-1] if n != 1010) and len(counts) <= 12
    split = jdbc.balanced_predicates("d", days, 8, "k")
    # the hash that the database has, as Spark writes it
    spark_form = [re.sub(r"NVL\(ORA_HASH\(k, (\d+)\), 0\)", lambda m: f"pmod(coalesce(hash(k), 0), {int(m[1]) + 1})", p) for p in split]
    counts = [df.filter(p).count() for p in spark_form]
    assert sum(counts) == len(rows) and max(counts) <= 1.5 * share
    assert jdbc.balanced_predicates("d", [(None, 3)], 4) == ["1 = 1"]
    df.unpersist()


def test_balanced_load_counts_days_first(monkeypatch):
    calls = []

    class Counted:
        def collect(self):
            return [(datetime(2024, 1, d), 10) for d in range(1, 9)] + [(None, 2)]

    monkeypatch.setattr(jdbc, "load", lambda spark, query, options, is_query=False, predicates=None: calls.append((query, predicates)) or Counted())
    jdbc.balanced_load(None, "SELECT * FROM C;", {}, "D", 4)
    assert calls[0] == ("SELECT TRUNC(D) AS DAY, COUNT(*) AS N FROM (SELECT * FROM C) Q GROUP BY TRUNC(D)", None)
    assert calls[1][0] == "SELECT * FROM C;" and len(calls[1][1]) == 5 and calls[1][1][-1].startswith("(D IS NULL")


def test_model_table_keeps_other_pulls(spark, folder):
    df = spark.range(3)
    files.write_model_table(df, folder, "2025-01-01", "2026-01-01", "2026-03-06")
    path = files.write_model_table(df.limit(1), folder, "2025-01-01", "2026-01-01", "2026-03-07")
    assert path.endswith("model_2025-01-01_to_2026-01-01")
    got = {r["pull_date"]: r["count"] for r in spark.read.parquet(path).groupBy(F.col("pull_date").cast("string").alias("pull_date")).count().collect()}
    assert got == {"2026-03-06": 3, "2026-03-07": 1}


def test_sample_is_one_file_without_delimiters(spark, folder):
    df = spark.range(50).withColumn("name", F.lit("x|y")).repartition(4)
    files.write_sample(df, f"{folder}/s", 20)
    parts = [f for f in os.listdir(f"{folder}/s") if f.startswith("part")]
    assert len(parts) == 1
    lines = bz2.open(f"{folder}/s/{parts[0]}", "rt").read().splitlines()
    assert len(lines) == 21 and lines[1].endswith("|xy")


def test_report_and_parquet(spark, folder):
    files.write_report(spark.range(2), f"{folder}/r")
    assert spark.read.option("header", True).csv(f"{folder}/r").count() == 2
    files.write_parquet(spark.range(2), f"{folder}/p")
    assert files.read_parquet(spark, f"{folder}/p").count() == 2


def test_staged_table_is_small_enough_to_broadcast(spark):
    staged = stage_table(spark.range(10).select("id", (F.col("id") * 2).alias("v")), "test")
    plan = spark.range(10_000_000).join(staged, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert scratch_dir(spark)


class Recorder:
    """Stands in for ``spark.read``: notes what it was asked to read."""

    def __init__(self):
        self.calls = []
        self.read = self

    def __getattr__(self, name):
        def record(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return record


ENV = {"DB_URL": "jdbc:oracle:thin:@x", "DB_USER": "u", "DB_PASSWORD": "p"}


def test_database_options():
    options = jdbc.oracle_options(ENV)
    assert options["fetchsize"] == "10000" and "sessionInitStatement" in options
    with pytest.raises(ValueError, match="DB_PASSWORD"):
        jdbc.oracle_options({"DB_URL": "x", "DB_USER": "u"})


def test_query_is_pushed_down_as_derived_table():
    spark = Recorder()
    jdbc.load(spark, "SELECT 1 FROM DUAL;", jdbc.oracle_options(ENV), is_query=True)
    assert ("option", ("dbtable", "(SELECT 1 FROM DUAL) T"), {}) in spark.calls
    spark = Recorder()
    jdbc.load(spark, "ADMIN.CLAIMS", jdbc.oracle_options(ENV))
    assert ("option", ("dbtable", "ADMIN.CLAIMS"), {}) in spark.calls


def test_predicates_are_an_argument_of_the_reader():
    spark = Recorder()
    predicates = jdbc.month_predicates("PROCESSED_DT", ["2024-11", "2024-12"])
    assert predicates[1] == "PROCESSED_DT >= DATE '2024-12-01' AND PROCESSED_DT < DATE '2025-01-01'"
    jdbc.load(spark, "ADMIN.CLAIMS", jdbc.oracle_options(ENV), predicates=predicates)
    (name, args, kwargs), = spark.calls
    assert name == "jdbc" and args == ("jdbc:oracle:thin:@x", "ADMIN.CLAIMS")
    assert kwargs["predicates"] == predicates and "url" not in kwargs["properties"]


def test_predicates_cover_every_row_once(spark):
    rows = [(None,), ("2023-12-31",), ("2024-11-30",), ("2024-12-31",), ("2025-01-01",)]
    df = spark.createDataFrame(rows, "d string").withColumn("d", F.to_date("d"))
    predicates = jdbc.month_predicates("d", ["2024-11", "2024-12"])
    assert [df.filter(p).count() for p in predicates] == [1, 1, 3]
    assert df.filter(jdbc.month_predicates("d", [])[0]).count() == 5


def test_pull_reads_the_database_once(spark, folder, monkeypatch):
    from claimweft.plans import database_pull

    calls = []

    def fake_load(session, query, options, is_query, predicates):
        calls.append(query)
        return session.createDataFrame([("a|b", i) for i in range(5)], "PROVIDERGROUPNAME string, n int")

    monkeypatch.setattr(database_pull, "load", fake_load)
    stored = database_pull.pull(spark, "SELECT 1", {}, f"{folder}/pull", ["1 = 1"], sample_rows=2)
    assert calls == ["SELECT 1"] and stored.count() == 5
    assert {r.PROVIDERGROUPNAME for r in stored.collect()} == {"ab"}
    assert spark.read.option("header", True).option("sep", "|").csv(f"{folder}/pull_sample").count() == 2


def test_named_parameters_are_not_spliced(spark):
    df = spark.createDataFrame([("a'; --",), ("b",)], "v string")
    got = jdbc.run_extract(spark, "SELECT v FROM {t} WHERE v = :v", {"v": "a'; --"}, t=df)
    assert got.count() == 1
