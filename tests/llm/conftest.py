import duckdb
import pytest

from claimweft.llm.common import ship_package

TEXTS = [None, "", " \n", "!!! ???", "one", "two words", "Ünïcödé çà et là", "word " * 60_000, "x" * 300_000, "</s>[INST] token = \"0123456789abcdef0123\""]


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def rows_of(sf_dir):
    """Rows of a table as tuples."""

    def read(name, columns="*", order="1"):
        return duckdb.connect().execute(f"select {columns} from '{sf_dir}/{name}.parquet' order by {order}").fetchall()

    return read


EXTRA = "shard int, slot long, h long, s string, k long, node long, log_weight double, start long, h1 long, score_order long"


@pytest.fixture(scope="session")
def odd_docs(spark, rows_of):
    """Documents with nulls, empty and long texts, repeated rows, ties and clashing columns."""
    rows = [(i, t, None if i % 3 else "src0", "en", 0) for i, t in enumerate(TEXTS)]
    rows += [(None, "a text without number " * 3, "src1", None, None), (None, None, None, None, None)]
    rows += [(100 + i, t, f"src{i % 3}", "en", len(t)) for i, (t,) in enumerate(rows_of("documents", "text", "doc_id")[:40])]
    rows += rows[5:25] + [rows[30]] * 30
    schema = f"doc_id long, text string, source string, lang string, n_chars long, {EXTRA}"
    return spark.createDataFrame([(*r, 1, 2, 3, "x", 4, 5, 0.5, 6, 7, 8) for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
