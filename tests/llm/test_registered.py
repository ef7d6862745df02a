"""The registered queries as the driver calls them."""

import duckdb
from compare import compare, duck

from __spark_entry__ import oracle_sql, queries


def test_every_operator_is_registered():
    names = [n for n in queries() if not n.startswith("q_")]
    assert sorted(names) == sorted(["pipeline", *[next(n for n in names if n.startswith(f"op{i}_")) for i in range(1, 11)], *[n for n in names if n.startswith(("op11_", "op12_", "op13_"))]])


def test_queries_with_sql(spark, sf_dir):
    con = duck(sf_dir)
    for name in [n for n in oracle_sql() if not n.startswith("q_")]:
        diff, rows = compare(spark, con, name, queries()[name], oracle_sql()[name], sf_dir)
        assert diff is None and rows > 0, (name, diff)


def test_top_k_with_repeated_rows_against_the_sql(spark, tmp_path):
    """Equal rows, more of them than a list has room for, and a query's vec_id with two vectors."""
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (0, [-1.0, 2.0]), (50, [0.5, 0.5]), (50, [0.5, 0.5]), (100, [0.25, -1.0])]
    rows += [(i, [i / 8, 1 - i / 8]) for i in range(1, 9) for _ in range(1 + i % 3)] + [(9, [0.25, 4.0])] * 7
    folder = str(tmp_path)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").toPandas().to_parquet(f"{folder}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{folder}/embeddings.parquet')")
    name = "op8_segment_top_k"
    diff, n = compare(spark, con, name, queries()[name], oracle_sql()[name], folder)
    assert diff is None and n == 15


def test_pipeline_runs_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = queries()["pipeline"](spark, sf_dir)
    assert out.columns == [*docs.columns, "shard", "slot"]
    assert 0 < out.select("doc_id").distinct().count() < docs.count()
