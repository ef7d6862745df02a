"""Operators on small tables: null keys, missing statuses, ties, hot keys, brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimweft.operators import (
    aggregates, booking, columns, dedupe, encoding, filters, joins, links, metrics, profiling, quantiles,
    revenue, sampling,
)
from claimweft.session import stage_table


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- filters and projections ------------------------------------------------------------


def population(spark):
    data = [
        (1, 10.0, "No", "LEE", 1007, 0), (2, 0.0, "No", "LEE", 1007, 0), (3, 10.0, "Yes", "LEE", 1007, 0),
        (4, 10.0, "No", "TEST", 1007, 0), (5, 10.0, "No", None, None, 2004), (6, 10.0, "No", "LEE", 1009, 0),
        (7, 10.0, "No", "LEE", 1007, 5), (8, None, "No", "LEE", 1007, 0),
    ]
    return spark.createDataFrame(
        data, "id int, savings_amt double, patient_age_65_ind string, patient_last_nm string, claimstatus int, adjustmentstatus int"
    )


def test_population_keeps_null_name_and_state(spark):
    assert rows(filters.claim_population(population(spark)).select("id"), "id") == [(1,), (5,)]


def test_population_optional_filters(spark):
    df = population(spark).withColumns(
        {"status_code": F.when(F.col("id") == 1, "8001"), "transactiontype": F.when(F.col("id") == 5, "PY")}
    )
    kept = filters.claim_population(df, excluded_status_prefix="800", transaction_types=["PY"])
    assert kept.count() == 0


def test_resubmits_and_text_dates(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-10", "2024-01-10"), (2, "2024-01-11", "2024-01-10"), (3, None, "2024-01-10")],
        "id int, entry_dt string, processed_dt string",
    ).withColumns({c: F.to_date(c) for c in ("entry_dt", "processed_dt")})
    assert rows(filters.drop_resubmits(df).select("id"), "id") == [(2,), (3,)]
    stamps = spark.createDataFrame([(1, "2023-12-31 10:00:00"), (2, "2024-01-01")], "id int, d string")
    assert rows(filters.received_after(stamps, "d", "2023-12-31").select("id")) == [(2,)]


def test_required_columns_guard(spark):
    with pytest.raises(ValueError, match="nope"):
        columns.require_columns(spark.range(1), ["id", "nope"])


def test_align_ignores_extra_and_fills_missing(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    assert rows(columns.align_columns(df, ["b", "c", "a"])) == [(0.0, 0.0, 1.0)]


def test_zero_missing_strict(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, s string, d date")
    assert rows(columns.zero_missing(df)) == [(0, "0", None)]
    assert rows(columns.zero_missing(df, strict_compat=True)) == [(0, "0", "0")]


# --- one row per key ---------------------------------------------------------------------


def test_paid_beats_unpaid_and_ties_are_stable(spark):
    df = spark.createDataFrame(
        [("a", "UNPAID", 1), ("a", "PAID", 3), ("a", "PAID", 2), (None, "UNPAID", 4), (None, "UNPAID", 5)],
        "k string, payment_status string, claim_id int",
    )
    got = rows(dedupe.priority_dedupe(df, ["k"], tie=["claim_id"]).select("k", "claim_id"), "claim_id")
    assert got == [("a", 2), (None, 4)]


def test_first_row_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = dedupe.latest_per_key(df, ["k"], "id")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_duplicate_count(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(2, "x")], "a int, b string")
    assert rows(dedupe.duplicate_count(df)) == [(4, 2, 2)]
    assert dedupe.exact_dedupe(df).count() == 2


# --- reports ------------------------------------------------------------------------------


def claims_table(spark, data):
    df = spark.createDataFrame(
        data, "pcode string, processed string, entry string, payment_status string, claim_id string, savings double"
    )
    return df.select(
        "pcode", F.to_date("processed").alias("processed_dt"), F.to_date("entry").alias("entry_dt"),
        "payment_status", "claim_id", F.col("savings").cast("decimal(18,2)").alias("savings_amt"),
    )


def test_booking_month_with_one_status_only(spark):
    df = claims_table(spark, [
        ("P", "2024-01-05", "2024-02-01", "PAID", "1", 10.0),
        ("P", "2024-02-05", None, "UNPAID", "2", 5.0),
        ("P", "2024-02-06", None, "UNPAID", "3", 0.0),
    ])
    got = rows(booking.booking_status(df).drop("pcode"), "processed_month")
    assert [tuple(float(x) if i else x for i, x in enumerate(r)) for r in got] == [
        ("2024-01", 1.0, 0.0, 10.0, 0.0, 1.0, 1.0), ("2024-02", 0.0, 1.0, 0.0, 5.0, 1.0, 0.0),
    ]
    wide = rows(booking.booking_pivot(df, ["2024-02", "2024-03"]).select("processed_month", "entry_2024_02", "entry_2024_03"), "processed_month")
    assert wide == [("2024-01", 100.0, 0.0), ("2024-02", None, None)]


def test_booking_percents_stay_within_hundred(spark, sf_dir):
    from claimweft.plans.adapters import claims

    long = booking.booking_long(claims(spark, sf_dir, "claim_id", "pcode", "processed_dt", "entry_dt", "payment_status", "savings_amt"))
    sums = long.groupBy("pcode", "processed_month").agg(F.sum("percent").alias("p"), F.count("*").alias("n"))
    assert sums.filter(F.col("p") > 100 + F.col("n") * 0.05 + 1e-9).count() == 0


def test_pay_rate_counts_absent_status_as_zero(spark):
    df = spark.createDataFrame(
        [("P", "2024-01", "PAID", "1"), ("P", "2024-01", "PAID", "2"), ("P", None, "PAID", "3"), (None, "2024-01", "PAID", "4")],
        "pcode string, processed_month string, payment_status string, claim_id string",
    )
    assert rows(aggregates.monthly_pay_rate(df)) == [("P", "2024-01", 2, 0, 2, 100.0, 0.0)]


def test_remaining_with_few_months_uses_zero(spark):
    df = spark.createDataFrame(
        [("A", "2024-01", 0.5, 10.0, 20.0), ("A", "2024-02", 0.25, 10.0, 20.0)]
        + [("B", f"2024-0{m}", r, 10.0, 20.0) for m, r in ((1, 0.8), (2, None), (3, 0.6), (4, 0.5), (5, 0.1))],
        "pcode string, processed_month string, paid_rate double, revenue_lower_unpaid double, revenue_upper_unpaid double",
    )
    got = {(r.pcode, r.processed_month): (r.remaining_rate, r.remaining_lower) for r in revenue.remaining_to_pay(df).collect()}
    assert got[("A", "2024-01")] == (-0.5, -5.0)
    assert got[("B", "2024-01")] == (0.0, 0.0)
    assert got[("B", "2024-05")] == (pytest.approx(0.7), pytest.approx(7.0))  # mean of 0.8 with NULL skipped is 0.8


def test_fee_bounds_keep_null_networks_in_the_count(spark):
    df = spark.createDataFrame(
        [("PAID", 2.0, "C", "N"), ("PAID", 4.0, "C", None), ("PAID", 0.0, "C", "N"), ("UNPAID", 1.0, "C", "N")],
        "payment_status string, fee double, client_cd string, network_cd string",
    ).withColumn("fee_amount", F.col("fee").cast("decimal(9,2)"))
    assert rows(revenue.fee_bounds(df)) == [(2.0, 1.0, 2)]


def test_rate_dimension_without_client(spark):
    claims = spark.createDataFrame([(" Abc-P ", "2024-01", "PAID", "1", 10.0), ("zz", "2024-01", "PAID", "2", 10.0)],
                                   "pcode string, processed_month string, payment_status string, claim_id string, s double")
    claims = claims.withColumns({"total_charge_amt": F.col("s").cast("decimal(18,2)"), "savings_amt": F.col("s").cast("decimal(18,2)")})
    rates = spark.createDataFrame([("abc-p", 0.1, 0.2)], "parent_client string, min_rate double, avg_rate double")
    got = rows(revenue.revenue_by_rate_dim(claims, rates).select("pcode", "revenue_lower", "revenue_upper"), "pcode")
    assert got == [(" Abc-P ", 1.0, 2.0), ("zz", 0.0, 0.0)]


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    got = rows(aggregates.value_counts(df, "v"), "v")
    assert sum(r[2] for r in got) == pytest.approx(1.0) and len(got) == 2


# --- joins ----------------------------------------------------------------------------------


def test_join_quality_kinds(spark):
    left = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), ("d",), ("d",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), ("d",), ("d",), ("e",)], "k string")
    got = {r.relationship: (r.n_keys, r.joined_rows) for r in joins.join_quality(left, right, "k", "k").collect()}
    assert got == {"1:1": (1, 1), "n:1": (1, 2), "1:n": (1, 2), "n:m": (1, 4), "right_only": (1, 0)}


def test_anti_join_keeps_null_ids(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    sent = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(joins.absent_from(df, sent, "id", "id"), F.col("id").asc_nulls_last()) == [(2,), (None,)]
    assert rows(joins.present_in(df, sent, "id", "id")) == [(1,)]


def test_eligible_does_not_multiply(spark):
    claims = spark.createDataFrame([("c", "n", 1)], "client_cd string, network string, id int")
    dim = spark.createDataFrame([("c", "n")] * 3, "ccode string, productcode string")
    assert joins.eligible_only(claims, dim, {"client_cd": "ccode", "network": "productcode"}).count() == 1


# --- sampling: exact against brute force, hot keys included ------------------------------------


def sample_frame(spark, n=3000, hot=0):
    rng = random.Random(7)
    data = [(i, rng.choice("AAAB")) for i in range(n)] + [(n, "A")] * hot
    return data, spark.createDataFrame(data, "id long, cls string").repartition(8)


def order_of(i):
    return ((i % 2**31) * 2654435761) % 2**32, i


@pytest.mark.parametrize("bits", [1, 8, 16])
def test_cuts_equal_a_full_sort(spark, bits, monkeypatch):
    data, df = sample_frame(spark)
    h = sampling.arithmetic_hash("id")
    cuts = sampling.hash_cuts(df, "cls", ["A", "B"], ["id"], lambda t: [F.floor(t * j / 5) for j in (1, 2, 3, 4)], h, bits)
    got = {r.id: r.segment for r in sampling.assign_segment(df, cuts, "cls", ["A", "B"], ["id"], h).collect()}
    for cls in "AB":
        ids = sorted((i for i, c in data if c == cls), key=order_of)
        n = len(ids)
        for rank, i in enumerate(ids, 1):
            assert got[i] == sum(rank > n * j // 5 for j in (1, 2, 3, 4))


def test_folds_are_even_and_partition_the_rows(spark):
    _, df = sample_frame(spark)
    sizes = defaultdict(Counter)
    folded = sampling.stratified_folds(df, "cls", ["A", "B"], ["id"], 5)
    for r in folded.collect():
        sizes[r.cls][r.fold] += 1
    for per_fold in sizes.values():
        assert set(per_fold) == set(range(5)) and max(per_fold.values()) - min(per_fold.values()) <= 1
    assert folded.count() == df.count()


def test_copies_of_a_hot_key_stay_together(spark):
    _, df = sample_frame(spark, hot=1500)
    folded = sampling.stratified_folds(df, "cls", ["A", "B"], ["id"], 5)
    assert folded.count() == df.count()
    assert folded.filter("id = 3000").select("fold").distinct().count() == 1


def test_split_of_a_tiny_class_and_of_other_classes(spark):
    df = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B"), (4, None), (5, "Z")], "id long, cls string")
    got = rows(sampling.stratified_split(df, "cls", ["A", "B"], ["id"], 0.2).select("id", "is_test"), "id")
    # rows of other classes stay, without a side
    assert got == [(1, 0), (2, 0), (3, 0), (4, None), (5, None)]


def test_balanced_sample_sizes(spark):
    data, df = sample_frame(spark)
    n = Counter(c for _, c in data)
    got = Counter(r.cls for r in sampling.balanced_sample(df, "cls", ["A", "B"], ["id"], 1000).collect())
    assert got == {"A": 1000, "B": min(1000, n["B"])}


# --- quantiles: exact against numpy, with a coarse sketch and heavy ties ---------------------------


@pytest.mark.parametrize("kind", ["uniform", "heavy", "constant", "tiny"])
def test_quantiles_are_exact(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.random(20000) * 1e6,
        "heavy": np.concatenate([np.zeros(7000), np.exp(rng.normal(5, 3, 13000))]),
        "constant": np.full(500, 2.5),
        "tiny": np.array([3.0, 1.0]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(8)
    probs = (0.0, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0)
    out = quantiles.exact_quantiles(df, ["x"], probs, accuracy=200).first()
    assert out.n == len(values)
    assert out.quantiles == pytest.approx(np.percentile(values, [p * 100 for p in probs]).tolist(), rel=1e-12)


def test_median_skips_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,)], "x double")
    assert rows(quantiles.medians(df, ["x"])) == [("x", 2.5)]


def test_chi_square_with_and_without_correction(spark):
    data = [("m", 1)] * 10 + [("m", 0)] * 20 + [("f", 1)] * 30 + [("f", 0)] * 5
    df = spark.createDataFrame(data, "sex string, y int")
    plain = profiling.chi_square(df, ["sex"], "y", [0, 1], yates=False).first()
    table = np.array([[20, 10], [5, 30]])
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    assert plain.chi2 == pytest.approx(((table - expected) ** 2 / expected).sum())
    corrected = profiling.chi_square(df, ["sex"], "y", [0, 1]).first()
    assert corrected.chi2 == pytest.approx(((np.abs(table - expected) - 0.5) ** 2 / expected).sum())
    assert corrected.dof == 1
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    ix = StringIndexer(inputCol="sex", outputCol="ix").fit(df).transform(df)
    ml = ChiSquareTest.test(VectorAssembler(inputCols=["ix"], outputCol="f").transform(ix), "f", "y").first()
    assert ml.statistics[0] == pytest.approx(plain.chi2)
    assert ml.pValues[0] == pytest.approx(plain.p_value, abs=1e-12)


def test_chi_square_p_values(spark):
    from claimweft.functions.stats import chi_square_p_value

    cases = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (18.307038053275146, 10, 0.05),
             (1000.0, 1, 0.0), (5000.0, 3, 0.0), (0.0, 2, 1.0), (124.34211340400407, 100, 0.05), (90.0, 100, 0.7531)]
    df = spark.createDataFrame([(x, k) for x, k, _ in cases], "x double, k long")
    got = [r.p for r in df.select(chi_square_p_value(F.col("x"), F.col("k")).alias("p")).collect()]
    assert got == pytest.approx([p for _, _, p in cases], abs=2e-4)
    assert got[:4] == pytest.approx([0.05] * 4, abs=1e-12)


def test_side_by_side(spark):
    from claimweft.operators.union import side_by_side

    a, b = spark.createDataFrame([(1, "x")], "id int, a string"), spark.createDataFrame([(1, "y")], "id int, b string")
    assert rows(side_by_side([a, b], "id")) == [(1, "x", "y")]


# --- encoding --------------------------------------------------------------------------------------


def brute_encoding(data, smoothing=20):
    overall = sum(y for _, y in data) / len(data)
    sums, counts = Counter(), Counter()
    for v, y in data:
        sums[v] += y
        counts[v] += 1
    out = {}
    for v, n in counts.items():
        w = 1 / (1 + np.exp(-(n - smoothing)))
        out[v] = overall * (1 - w) + sums[v] / n * w
    return out, overall


def test_out_of_fold_never_sees_its_own_fold(spark):
    rng = random.Random(5)
    data = [(i, rng.choice(["a", "b", None, f"rare{i}"]), rng.random() < 0.4) for i in range(400)]
    df = spark.createDataFrame([(i, v, int(y)) for i, v, y in data], "id long, v string, y int")
    folded = stage_table(sampling.stratified_folds(df, "y", [0, 1], ["id"], 5), "test-folds")
    got = encoding.out_of_fold_encode(folded, "v", "y").collect()
    assert len(got) == 400
    by_fold = {}
    for f in range(5):
        by_fold[f] = brute_encoding([(r.v, r.y) for r in got if r.fold != f])
    for r in got:
        maps, overall = by_fold[r.fold]
        assert r.v_te == pytest.approx(maps.get(r.v, overall), abs=1e-12)


def test_unseen_value_gets_the_global_mean_and_null_is_a_value(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), (None, 1), (None, 1)], "v string, y int")
    maps = stage_table(encoding.fit_target_encoding(train, "v", "y", smoothing=0), "test-maps")
    test = spark.createDataFrame([("a",), (None,), ("new",)], "v string")
    got = {r.v: r.v_te for r in encoding.apply_target_encoding(test, maps, "v").collect()}
    expected, overall = brute_encoding([("a", 1), ("a", 0), (None, 1), (None, 1)], 0)
    assert got["new"] == pytest.approx(overall) and got["a"] == pytest.approx(expected["a"])
    assert got[None] == pytest.approx(expected[None])


def test_encode_several_columns(spark):
    train = spark.createDataFrame([(i, f"v{i % 3}", i % 2, i % 2, i % 5) for i in range(60)], "id int, a string, b int, y int, fold int")
    test = spark.createDataFrame([(1, "v1", 0), (2, "zz", 9)], "id int, a string, b int")
    tr, te, maps = encoding.encode_columns(train, test, ["a", "b", "absent"], "y")
    assert {"a_te", "b_te"} <= set(tr.columns) & set(te.columns) and tr.count() == 60 and te.count() == 2
    assert {r.column for r in maps.collect()} == {"a", "b"}


def test_group_mode(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, None), (2, None), (None, None), (3, "z"), (3, "z"), (3, "a"), (3, None)], "k int, v string"
    )
    got = Counter((r.k, r.v) for r in encoding.group_mode_fill(df, "v", ["k"]).collect())
    assert got[(1, "a")] == 2 and got[(2, "Unknown")] == 1 and got[(None, "Unknown")] == 1 and got[(3, "z")] == 3


def test_imputation_falls_back(spark):
    df = spark.createDataFrame([(None, None, 2.0), (None, None, 4.0)], "e double, t string, n double")
    fills = encoding.fit_imputation(df, ["e", "n"], ["t"])
    assert rows(fills) == [(0.0, 3.0, "Unknown")]
    assert rows(encoding.apply_imputation(df, fills).select("e", "t")) == [(0.0, "Unknown")] * 2


def test_one_hot_limits_and_unknown(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert encoding.one_hot_categories(df, ["v"]) == {"v": ["a", "b"]}
    with pytest.raises(ValueError):
        encoding.one_hot_categories(df, ["v"], max_values=1)
    got = rows(encoding.one_hot_wide(df, {"v": ["a"]}).select("v_a"))
    assert sorted(got) == [(0,), (0,), (1,)]


# --- metrics ------------------------------------------------------------------------------------------


@pytest.mark.parametrize("bins", [1, 7, 65536])
def test_auc_and_best_f1(spark, bins):
    rng = random.Random(11)
    data = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(2000)]
    df = spark.createDataFrame(data, "score double, y int")
    auc = metrics.roc_auc(df, "score", "y", bins).first().auc
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute, abs=1e-12)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ml = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", numBins=0).evaluate(df)
    assert auc == pytest.approx(ml, abs=1e-9)
    holes = df.unionByName(spark.createDataFrame([(float("nan"), 1), (None, 1), (0.5, None)], "score double, y int"))
    assert metrics.roc_auc(holes, "score", "y", bins).first().auc == auc
    best = metrics.best_f1_threshold(df, "score", "y", bins).first()
    curve = {}
    for t in {s for s, _ in data}:
        tp = sum(y for s, y in data if s >= t)
        curve[t] = 2 * tp / (sum(s >= t for s, _ in data) + len(pos))
    top = max(curve.values())
    assert best.f1 == pytest.approx(top) and best.threshold == min(t for t, f in curve.items() if f == top)


# --- links -----------------------------------------------------------------------------------------------


def test_posted_dates_and_years(spark):
    urls = ["https://x/a/01-23-2026.zip", "https://x/1_5_2021.xls?d=2", "https://x/b-08.03.2020.zip", "https://x/12182020.zip",
            "https://x/2020-01-01/none.zip", "https://x/13-40-2020_07092021.zip"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [str(r.d) for r in df.select(links.posted_date(F.col("u")).alias("d")).collect()]
    assert got == ["2026-01-23", "2021-01-05", "2020-08-03", "2020-12-18", "None", "2021-07-09"]
    year = spark.createDataFrame([("x/2019/cy2025.zip", "T"), ("x/a", "Rates 2024"), ("x", None)], "u string, t string")
    assert [r.y for r in year.select(links.named_year(F.col("u"), F.col("t")).alias("y")).collect()] == ["2025", "2024", None]


def test_latest_prefers_dates_then_year(spark):
    df = spark.createDataFrame(
        [(1, 0, "x/01-01-2020.zip", "a"), (1, 1, "x/02-01-2020.zip", "b"), (1, 2, "x/02-01-2020.zip", "c"), (1, 3, "x/cy2030.zip", "d"),
         (2, 0, "x/b.zip", "cy2021"), (2, 1, "x/c.zip", "cy2021"), (2, 2, "x/z.zip", "none")],
        "site int, position int, href string, text string",
    )
    got = rows(links.latest_link(df, ["site"]).select("site", "href", "text"), "site")
    assert got == [(1, "x/02-01-2020.zip", "c"), (2, "x/c.zip", "cy2021")]


def test_links_and_first_seen(spark):
    html = """<p><A class="k" HREF='/a.zip'> First <b>x</b></A><a href="/b.xlsx">B</a><a name="n">no</a><a href="/a.zip">again</a>"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<a href='/b.xlsx'>B</a>")], "page_id int, html string")
    found = links.extract_links(pages)
    assert rows(found, "page_id", "position") == [
        (1, 0, "/a.zip", "First x"), (1, 1, "/b.xlsx", "B"), (1, 2, "/a.zip", "again"), (3, 0, "/b.xlsx", "B"),
    ]
    assert rows(links.extract_links(pages, extensions=[".zip"]).select("href")) == [("/a.zip",), ("/a.zip",)]
    seen = rows(dedupe.first_seen(found, "href", ["page_id", "position"]), "href")
    assert seen == [("/a.zip", 1, 0), ("/b.xlsx", 1, 1)]


def test_next_iteration(spark):
    records = spark.createDataFrame([("p", 1), ("p", 3), ("q", None)], "project string, iteration int")
    projects = spark.createDataFrame([("p",), ("q",), ("r",)], "project string")
    assert rows(links.next_iteration(records, projects, "project", "iteration"), "project") == [("p", 4, 2), ("q", 1, 1), ("r", 1, 0)]


def test_any_fold_number_has_an_encoding(spark):
    from claimweft.operators.encoding import fold_encodings

    df = spark.createDataFrame([("a", f, y) for f in (0, 5000, -3) for y in (0, 1, 1)], "v string, fold int, y int")
    assert all(r.encoded is not None for r in fold_encodings(df, "v", "y").collect())


def test_splits_keep_rows_without_a_class(spark):
    from claimweft.operators import sampling

    df = spark.createDataFrame([(i, [0, 1, None, 7][i % 4]) for i in range(80)], "id long, y int")
    split = sampling.stratified_split(df, "y", [0, 1], ["id"])
    folds = sampling.stratified_folds(df, "y", [0, 1], ["id"])
    assert split.count() == folds.count() == 80
    assert {r.y for r in split.filter("is_test is null").collect()} == {None, 7}
    assert folds.filter("fold is null").count() == 40 and split.filter("is_test = 1").count() == 8
    assert sampling.hash_sample(df, ["id"], 13).count() == 13


def test_nan_is_missing_in_profiles(spark):
    from claimweft.operators import profiling

    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (nan, 1.0), (3.0, None), (4.0, 8.5)], "a double, b double")
    assert {r.column: r.n_missing for r in profiling.missing_profile(df).collect()} == {"a": 1, "b": 1}
    corr = {(r.column_a, r.column_b): r.corr for r in profiling.correlation_matrix(df, ["a", "b"]).collect()}
    assert corr["a", "b"] > 0.99 and profiling.correlation_with(df, ["a"], "b").first().corr > 0.99


def test_link_targets_without_quotes_and_addresses(spark):
    from claimweft.operators import links

    html = """<a href=/a.zip>A</a> <a class=x href='b&amp;c.html'>B</a> <A HREF="it's.xls">C</A><a name=q>no</a>"""
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [r.href for r in links.extract_links(df).orderBy("position").collect()] == ["/a.zip", "b&c.html", "it's.xls"]
    base = "https://h.org/x/y/page.html?q=1#f"
    cases = {"/a.zip": "https://h.org/a.zip", "b.html": "https://h.org/x/y/b.html", "../c": "https://h.org/x/c", "../../../d": "https://h.org/d",
             "//o.net/e": "https://o.net/e", "http://k.com": "http://k.com", "?p=2": "https://h.org/x/y/page.html?p=2", "./f": "https://h.org/x/y/f",
             "#top": "https://h.org/x/y/page.html?q=1#top", "mailto:a@b.c": "mailto:a@b.c"}
    df = spark.createDataFrame([(base, h) for h in cases], "b string, h string")
    got = {r.h: r.u for r in df.select("h", links.absolute_url(F.col("b"), F.col("h")).alias("u")).collect()}
    assert got == cases
