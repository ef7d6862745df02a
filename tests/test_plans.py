"""Shape of the physical plans: what must hold at any size of the data."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from claimweft.operators import dedupe, encoding, joins, sampling
from claimweft.session import stage_table


def plan(df):
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def shuffled_joins(spark):
    """Settings of a cluster in miniature: no broadcast, skew found in small partitions."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def hot_rows(spark, n=300_000):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(n).repartition(8).select(key.cast("long").alias("k"), "id", F.md5(F.col("id").cast("string")).alias("pad"))


def test_hot_key_of_a_semi_join_is_split(shuffled_joins):
    spark = shuffled_joins
    wanted = spark.range(5000).select(F.col("id").alias("k")).union(spark.range(1000).select(F.lit(7).cast("long")))
    out = joins.present_in(hot_rows(spark), wanted, "k", "k")
    assert "skew=true" in final_plan(out)
    assert out.count() == 300_000


def test_hot_key_of_an_encoding_is_split(shuffled_joins):
    spark = shuffled_joins
    rows = hot_rows(spark).withColumn("y", (F.col("id") % 2).cast("int"))
    maps = stage_table(encoding.fit_target_encoding(rows, "k", "y"), "plan-test")
    out = encoding.apply_target_encoding(rows, maps, "k")
    assert "skew=true" in final_plan(out)


def test_hot_key_is_cut_before_the_shuffle(spark):
    text = plan(dedupe.latest_per_key(hot_rows(spark, 3000), ["k"], "id"))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_assigning_segments_does_not_shuffle(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("c"))
    cuts = sampling.hash_cuts(rows, "c", ["A", "B"], ["id"], lambda t: [F.floor(t / 2)])
    text = plan(sampling.assign_segment(rows, cuts, "c", ["A", "B"], ["id"]))
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(queries()["q_monthly_pay_rate"](spark, sf_dir))
    assert "GreaterThan(o_orderdate" in text or "o_orderdate" in text.split("DataFilters")[1]
    lineitem = next(s for s in re.findall(r"ReadSchema: (struct<.*?>)", text) if "l_orderkey" in s)
    assert lineitem == "struct<l_orderkey:bigint,l_linestatus:string>"


def test_no_python_workers_and_no_cross_joins(spark, sf_dir):
    for name, fn in queries().items():
        if not name.startswith("q_"):  # the optional corpus operators may use Python
            continue
        text = plan(fn(spark, sf_dir))
        assert "Python" not in text and "CartesianProduct" not in text, name
        for part in text.split("BroadcastNestedLoopJoin")[1:]:
            # only a single aggregated row is ever joined without keys
            assert "BroadcastExchange IdentityBroadcastMode" in part and "SinglePartition" in part, name
