"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from claimweft.llm import chatformat, importance, leaks, mixing, neardup, secretscan, sharding, tokencount, topk, urlfilter
from pyspark.sql import functions as F

STAGES = dict(corpus_pipeline.STAGES)


def listed(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_odd_rows(spark, sf_dir, odd_docs, name):
    out = STAGES[name](spark, odd_docs, sf_dir)
    before, after = Counter(listed(odd_docs)), Counter(listed(out.select(odd_docs.columns)))
    if name == "shards":
        assert out.columns == [*odd_docs.columns, "_shard", "_slot"]
        assert after == before
    else:
        assert out.columns == odd_docs.columns and out.dtypes == odd_docs.dtypes
        assert set(after) <= set(before)
    if name == "source_mix":
        assert all(n <= 3 * before[r] for r, n in after.items())
    if name == "near_duplicates":
        assert all(n == 1 for r, n in after.items() if r[1] is not None)
        assert sum(n for r, n in after.items() if r[1] is None) == sum(n for r, n in before.items() if r[1] is None)


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_on_an_empty_table(spark, sf_dir, no_docs, name):
    assert STAGES[name](spark, no_docs, sf_dir).count() == 0


def test_stages_with_empty_side_tables(spark, odd_docs, sf_dir):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert importance.resample(odd_docs, labels).count() == odd_docs.count()
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert leaks.decontaminate(odd_docs, benchmark).count() == odd_docs.count()
    assert leaks.find_leaks(odd_docs, benchmark).count() == 0
    nothing = spark.createDataFrame([(None, None), (1, ""), (2, "?")], "item_id long, text string")
    assert leaks.find_leaks(odd_docs, nothing).count() == 0


def test_labels_with_nulls_and_conflicts(spark, odd_docs):
    rows = [(None, 1, 0), (100, 1, 0), (100, 0, 0), (101, None, None), (102, 1, None), (103, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    assert [r[0] for r in importance.good_documents(labels).collect()] == [102]
    assert importance.resample(odd_docs, labels).count() > 0


def test_target_model_reads_all_good_labels(spark):
    """No sample of the labelled documents: 20,500 good ones, each text with a word of its own."""
    docs = spark.range(20_500).selectExpr("id as doc_id", "concat('word', id) as text")
    labels = docs.selectExpr("doc_id", "cast(1 as int) as quality", "cast(0 as int) as toxic")
    good = importance.good_documents(labels)
    raw, target = importance.fit(docs, good)
    assert good.count() == 20_500 and (raw == target).all() and raw.sum() == 2 * 20_500


def test_row_operators_keep_every_row(spark, odd_docs, no_docs):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    for docs in (odd_docs, no_docs):
        n = docs.count()
        assert tokencount.count_tokens(docs, path).count() == n
        assert secretscan.scan(docs, secretscan.train(docs)).count() == n
        assert neardup.near_duplicates(docs).count() == n
        assert mixing.mix(docs).count() == n


def test_shards_of_odd_rows(odd_docs):
    out = sharding.histogram_sort(odd_docs, 5).select(F.col("_shard").alias("p"), F.col("_slot").alias("i")).collect()
    by = {}
    for r in out:
        by.setdefault(r.p, []).append(r.i)
    assert len(out) == odd_docs.count() and set(by) <= set(range(5))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_top_k_on_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0]), (4, []),
            (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [9.0, 9.0]), (9, [3e30, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("lane", F.lit(2))
    got = listed(topk.top_k(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank"))
    assert [r[:3] for r in got if r[0] == 0] == [(0, 1, 9), (0, 2, 1), (0, 3, 2), (0, 4, 50), (0, 5, 3)]
    assert [r[3] for r in got if r[0] == 0][1:4] == [65536, 65536, 32768]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_any_length(spark):
    """More results than a list of the registered query has, over several cells, against a sort."""
    rows = [(i, [float((i * 37) % 101) / 8, float((i * 53) % 97) / 8]) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    whole = {i: [int(256 * x // 1) for x in v] for i, v in rows}
    for k in (1, 50, 1000):
        got = topk.top_k(df, F.col("vec_id") % 350 == 0, k).collect()
        for q in (0, 350):
            want = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:k]
            assert [(-r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] == want


def test_urls_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://A.Com"), (6, "x://h?q"), (None, "http://b.net/es/1"), (6, "x://h?q"), (7, "a://b://c/d")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("shape", F.lit(1))
    got = Counter(listed(urlfilter.judge(df, [("block", "net", "/es/")]).select("page_id", "host", "path", "rule", "verdict")))
    assert got[(6, "h", "", None, "allow")] == 2 and got[(None, "b.net", "/es/1", "net/es/", "block")] == 1
    assert got[(1, "", "", None, "allow")] == 1 and got[(5, "a.com", "", None, "allow")] == 1 and got[(7, "b:", "//c/d", None, "allow")] == 1
    assert urlfilter.judge(df.limit(0), []).count() == 0


def test_conversations_on_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 2, "x|>\n", "<|end|>"), (2, 5, "assistant", "é" * 400_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(3))
    got = {r.conv_id: r for r in chatformat.read_back(chatformat.format_turns(df.withColumn("parts", chatformat.text_parts("text")))).collect()}
    assert got[1].n_turns == 3 and got[None].n_turns == 1 and got[2].loss_chars == 400_000
    assert chatformat.read_back(chatformat.format_turns(df.limit(0).withColumn("parts", chatformat.text_parts("text")))).count() == 0


def test_nothing_is_left_in_the_working_folder():
    assert not [f for f in os.listdir(".") if f.startswith(("spark-warehouse", "part-"))]


def test_deduplication_shuffles_repeated_texts_only(spark, odd_docs):
    """One row of each text stays, null texts all do; only the branch of repeated rows is numbered."""
    kept = neardup.deduplicate(odd_docs)
    rows = odd_docs.collect()
    assert kept.columns == odd_docs.columns and kept.filter("text is null").count() == sum(r.text is None for r in rows)
    texts = [r.text for r in kept.collect() if r.text is not None]
    assert len(texts) == len(set(texts)) and set(texts) <= {r.text for r in rows}
    lines = kept._jdf.queryExecution().optimizedPlan().toString().splitlines()
    single = [x for x in lines if x.startswith(":")]  # the first of the two branches
    assert any("LeftSemi" in x for x in single) and not any("Window" in x for x in single) and any("Window" in x for x in lines)
