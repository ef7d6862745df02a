"""Composed jobs and models end to end on small data."""

import os
import random

import pytest
import collections
import math

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from claimweft import session
from claimweft.models import factors, scoring, training, valuetree
from claimweft.operators import metrics
from claimweft.plans import income_model, monthly_reports, payment_model
from claimweft.plans.adapters import LEDGER_AMOUNTS, claims, ledger, model_claims
from claimweft.plans.worklists import WORKLIST_COLUMNS, unpaid_worklist
from claimweft.session import stage_table


def people(spark, n=600):
    rng = random.Random(1)
    data = []
    for i in range(n):
        school, hours = rng.randint(0, 23), rng.choice([None, 10, 20, 40, 60])
        wage = 2500 * school + 400 * (hours or 0) + rng.randint(0, 20000)
        data.append((i, 1, rng.randint(1, 9), 1, school, 2, 4, rng.randint(0, 5), rng.randint(1, 5), rng.randint(1, 2), 1, 1,
                     rng.randint(10, 80), 1, 20, hours, float(wage), 13))
    cols = "id long, " + ", ".join(f"{c} int" for c in ("TEN", "RAC1P", "CIT", "SCHL", "BLD", "HUPAC", "COW", "MAR", "SEX", "VEH", "WKL", "AGEP", "NPF", "GRPIP", "WKHP"))
    return spark.createDataFrame(data, cols + ", WAGP double, ST int")


def test_income_training_and_scoring(spark, tmp_path):
    rows = income_model.labelled(people(spark))
    assert rows.filter("AGEP < 16").count() == 0 and "ST" not in rows.columns
    grids = {"logreg": {"C": (0.1, 10)}, "gbt": {"maxIter": (5,), "maxDepth": (3,)}}
    name, model, threshold, aucs, fold_aucs, fit_rows, scored = income_model.train(
        rows, ["id"], grids, k=3, categorical=["SCHL", "SEX", "COW"], numeric=["AGEP", "WKHP"]
    )
    assert {n: len(a) for n, a in fold_aucs.items()} == {"logreg": 2, "gbt": 1} and min(map(min, fold_aucs.values())) > 0.7
    assert fit_rows.count() + scored.count() == rows.count()
    assert name in aucs and aucs[name] == max(aucs.values()) > 0.8 and 0 < threshold < 1
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    batch = people(spark, 20).withColumn("SCHL", F.when(F.col("id") == 0, 99).when(F.col("id") > 1, F.col("SCHL")))
    out = scoring.score_batch(loaded, batch, ["id"], threshold).collect()
    assert len(out) == 20
    for r in out:
        high = r.probability_income_gt_50k >= threshold
        assert r.prediction == scoring.LABELS[int(high)]
        p = r.probability_income_gt_50k if high else 1 - r.probability_income_gt_50k
        assert r.confidence_percent == pytest.approx(p * 100, abs=0.0051)
    with pytest.raises(ValueError, match="SEX"):
        scoring.score_batch(loaded, batch.drop("SEX"))


def test_tree_leaves_and_importances(spark, sf_dir):
    rows = claims(spark, sf_dir).select(
        "claim_id", "claim_type", "client_cd", F.col("total_charge_amt").cast("double").alias("charge"),
        F.col("fee_amount").cast("double").alias("fee"), (F.col("fee_amount") > 4).cast("int").alias("target"),
    ).withColumn("client_cd", F.when(F.col("client_cd") != "HOUSEHOLD", F.col("client_cd")))
    model = training.fit_tree(rows, ["charge", "fee"], ["claim_type", "client_cd"])
    labelled = training.label_leaves(model, rows, ["claim_id", "target"])
    assert labelled.count() == rows.count()
    tree = model.stages[-1]
    leaves = (tree.numNodes + 1) // 2
    assert labelled.agg(F.max("leaf_label")).first()[0] < leaves and tree.depth <= 5
    per_leaf = labelled.groupBy("leaf_label").agg(F.countDistinct("prob_paid").alias("n")).filter("n > 1")
    assert per_leaf.count() == 0
    assert labelled.filter("abs(prob_paid + prob_unpaid - 1) > 1e-9").count() == 0
    top = training.feature_importances(model, rows, 1).collect()
    assert top[0].feature == "fee_in" and top[0].importance > 0.9
    auc = metrics.roc_auc(labelled, "prob_paid", "target").first().auc
    ml = BinaryClassificationEvaluator(rawPredictionCol="prob_paid", labelCol="target", numBins=0)
    assert auc == pytest.approx(ml.evaluate(labelled), abs=1e-9)


def test_tree_over_a_column_of_many_values(spark, tmp_path):
    """3,000 categories: no list in the driver, unknown ones fall to their own index, and saving keeps the table."""
    rows = spark.range(6000).selectExpr("id", "cast(id % 3000 as string) as name", "cast(id % 3000 < 1000 as int) as target", "cast(null as double) as empty")
    model = training.fit_tree(rows, ["empty"], ["name"])
    assert model.stages[1].getOrDefault("sizes") == [3000] and model.stages[-1].getMaxBins() == 3001
    labelled = training.label_leaves(model, rows, ["id", "target"])
    assert labelled.count() == 6000 and labelled.filter("abs(prob_paid - target) > 1e-9").count() == 0
    model.save(str(tmp_path / "tree"))
    loaded = PipelineModel.load(str(tmp_path / "tree"))
    again = training.label_leaves(loaded, rows, ["id", "target"])
    assert again.exceptAll(labelled).count() == 0
    strange = spark.createDataFrame([(1, "nobody", 0, None), (2, None, 0, 1.0)], "id long, name string, target int, empty double")
    assert training.label_leaves(loaded, strange, ["id"]).count() == 2


def test_tree_tries_every_value(spark):
    """Ten hits at the end of 5,000 values, past the last of 32 bins, and the best split of two columns by brute force."""
    rows = spark.range(5000).selectExpr("id", "cast(id as double) as x", "cast(id >= 4990 as int) as target")
    model = training.fit_tree(rows, ["x"], [])
    assert model.stages[-1].numNodes == 3
    assert training.label_leaves(model, rows, ["target"]).filter("abs(prob_paid - target) > 1e-9").count() == 0
    listed = [(float(i * 37 % 101), str(i * 53 % 17), int((i * 37 % 101 > 60) ^ (i % 3 == 0) ^ (i * 53 % 17 < 5))) for i in range(1500)]
    rows = spark.createDataFrame(listed, "x double, c string, target int").repartition(3)
    tree = training.fit_tree(rows, ["x"], ["c"], depth=1).stages[-1].tree()

    def bits(ys):
        return -sum(p * math.log2(p) for p in (sum(ys) / len(ys), 1 - sum(ys) / len(ys)) if p) * len(ys) if ys else 0.0

    ys, share = [y for *_, y in listed], collections.defaultdict(list)
    for _, c, y in listed:
        share[c].append(y)
    ranked = sorted(share, key=lambda c: (sum(share[c]) / len(share[c]), int(c)))
    sides = [lambda r, v=v: r[0] <= v for v in {r[0] for r in listed}]
    sides += [lambda r, k=k: r[1] in ranked[:k] for k in range(1, len(ranked))]
    gains = [bits(ys) - bits([r[2] for r in listed if s(r)]) - bits([r[2] for r in listed if not s(r)]) for s in sides]
    assert tree[1]["gain"] == pytest.approx(max(gains) / len(ys), abs=1e-12) and len(tree) == 3


def test_tree_shuffles_single_values_only_where_they_may_matter(spark, monkeypatch):
    """20,000 distinct numbers beside a telling category: single numbers are not counted; files in between are gone."""
    rows = spark.range(20_000).selectExpr("id", "cast(id * 7919 % 20000 as double) as x", "cast(id % 200 as string) as c", "cast(id % 200 < 90 as int) as target")
    staged, keep = [], valuetree.stage_table

    def seen(df, label, *args, **kw):
        out = keep(df, label, *args, **kw)
        staged.append((label, out.count(), out.inputFiles()[0].removeprefix("file://")))
        return out

    monkeypatch.setattr(valuetree, "stage_table", seen)
    model = training.fit_tree(rows, ["x"], ["c"])
    assert training.label_leaves(model, rows, ["target"]).filter("abs(prob_paid - target) > 1e-9").count() == 0
    assert max(n for _, n, _ in staged) <= valuetree.BINS + 201
    assert {label for label, _, path in staged if os.path.exists(path)} == {"tree-sets"}


def test_tree_in_passes_and_chunks_is_the_same(spark, monkeypatch):
    rows = spark.range(6000).selectExpr("id", "cast(hash(id) % 2500 as double) as x", "cast(hash(id, 1) % 4 as string) as c", "cast(pmod(hash(id, 2), 3) = 0 as int) as target")
    whole = training.fit_tree(rows, ["x"], ["c"], depth=2).stages[-1].tree()
    monkeypatch.setattr(session, "PASS_ROWS", 3000)
    monkeypatch.setattr(valuetree, "LOOK_ROWS", 100)
    parts = training.fit_tree(rows, ["x"], ["c"], depth=2)
    assert parts.stages[-1].tree() == whole and len(whole) > 3
    assert training.label_leaves(parts, rows, ["id"]).count() == 6000
    assert len(session.in_passes(rows, ["id"], 6000)) == 2
    assert session.stage_in_passes(rows, "in-passes", ["id"], 6000).exceptAll(rows).count() == 0 == rows.count() - 6000


def test_factor_table(spark):
    raw = spark.createDataFrame(
        [(1, "Y", "C1", "S", "N1", None, "02139-1", "MA", 5.0, 10.0, "PAID", "EN"),
         (2, "N", "C2", "S", "N2", "I", "2139.0", "GA", 5.0, 0.0, "UNPAID", "NA"),
         (3, "N", "C2", None, "N2", "I", None, "GA", None, 2.0, None, "NA")],
        "claim_id long, appealed_flag string, client_cd string, claim_specialty string, last_closure_network_cd string, "
        "mpi_surprise_bill_ind string, zip5 string, provider_state string, savings_amt double, total_charge_amt double, "
        "payment_status string, claim_indicator_bmp string",
    )
    got = {r.claim_id: r for r in factors.factor_table(raw).collect()}
    assert got["1"].target == 1 and got["2"].target == 0 and got["3"].target == 0
    assert got["1"].savings_rate == 0.5 and got["2"].savings_rate == 1.0 and got["3"].savings_rate == 0.0
    assert got["1"].zip3_021 == 1 and got["2"].zip3_021 == 1 and got["3"].zip3_0 == 1
    assert got["1"].claim_indicator_bmp_EN == 1 and got["2"].client_cd_C2 == 1
    scored = factors.factor_table(raw.filter("claim_id = 2"), values={"client_cd": ["C1"]})
    assert [r.client_cd_C1 for r in scored.collect()] == [0]


def test_payment_model_rows(spark, sf_dir):
    entries = ledger(spark, sf_dir).withColumns({"feetype": F.lit("A"), "method": F.lit("B")})
    table = payment_model.extract(
        model_claims(spark, sf_dir), entries, "1994-01-01", "2000-01-01", "2001-12-31", 60,
        ("feetype", "A"), ("method", "B"), ledger_key="claim_number", amounts=LEDGER_AMOUNTS,
    )
    per_class = {r.paid_flag: r["count"] for r in table.groupBy("paid_flag").count().collect()}
    assert per_class[1] == 60
    rows = payment_model.model_rows(table)
    assert not {"payments_sum", "refunds_sum", "writeoffs_sum"} & set(rows.columns)
    assert {"log_billed_amount_sum", "claim_age_bucket"} <= set(rows.columns)
    train, test, maps = payment_model.train_and_test(rows, ["claim_type", "provider"])
    assert train.count() + test.count() == rows.count()
    assert test.filter("paid_flag = 1").count() == 12
    assert train.filter("claim_type_te is null or provider_te is null").count() == 0
    assert test.filter("claim_type_te is null or provider_te is null").count() == 0


def raw_claims(spark):
    base = dict(
        claim_id="1", savings_amt="10.50", total_charge_amt="20", patient_age_65_ind="No", patient_last_nm="Lee",
        patient_first_nm="Ann", patient_birth_dt="1980-01-01", first_dos="2024-01-01", original_provider_tax_id="9",
        claim_type="X", payment_status="UNPAID", claimstatus=1007, adjustmentstatus=0, contract_name="Big Net-1",
        provider_state="ga", claim_indicator="ADJ=Y;BMP=EN;", client_cd="C1", last_closure_network_cd="NetExt",
        productcode="DIP", processed_dt="2024-01-05", entry_dt="0", pcode="P", fee_amount="2", network_cd="N",
    )
    data = [
        base,
        {**base, "claim_id": "2", "payment_status": "PAID", "entry_dt": "2/1/2024"},
        {**base, "claim_id": "3", "patient_last_nm": "TEST"},
        {**base, "claim_id": "4", "patient_first_nm": "Bob", "client_cd": "C2", "savings_amt": "junk"},
        {**base, "claim_id": "5", "patient_first_nm": "Bob", "client_cd": "C2", "processed_dt": "2024-02-07"},
    ]
    return spark.createDataFrame([tuple(r.values()) for r in data], ", ".join(
        f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in base.items()))


def test_monthly_reports(spark, tmp_path):
    typed = monthly_reports.typed_extract(raw_claims(spark), ["processed_dt", "entry_dt"], ["savings_amt", "total_charge_amt", "fee_amount"])
    cleaned = monthly_reports.clean_claims(typed)
    got = {r.claim_id: r for r in cleaned.collect()}
    assert set(got) == {"2", "5"}
    assert got["2"].contract_name == "BigNet1" and got["2"].provider_state == "GA"
    assert got["2"].claim_indicator_adj == "ADJ=Y;" and got["2"].claim_indicator_bmp == "EN"
    dim = spark.createDataFrame([("C1", "Prac", "F"), ("C1", "Prac", "G")], "ccode string, productcode string, feetype string")
    kept = monthly_reports.clean_claims(typed, eligible=dim, product_names={"Prac": "DIP"})
    assert [(r.claim_id, r.last_closure_network_cd) for r in kept.collect()] == [("2", "DIP")]
    assert [r.claim_id for r in monthly_reports.clean_claims(typed, excluded_clients=["C1"]).collect()] == ["5"]
    paths = monthly_reports.write_reports(cleaned, str(tmp_path), "2025-01-09")
    curve = spark.read.parquet(paths["booking_curve"]).collect()
    assert [(r.pcode, r.processed_month, r.entry_month, r.percent) for r in curve] == [("P", "2024-01", "2024-02", 100.0)]
    stats = spark.read.parquet(paths["summary_stats"]).collect()
    assert sorted(r.processed_month for r in stats) == ["2024-01", "2024-02"]
    assert monthly_reports.export_form(cleaned).filter("entry_dt is null").count() == 1


def test_all_reports_from_one_scan(spark, sf_dir, tmp_path):
    """Five outputs; the claims' rows are counted as they are read, and each report equals the one made from the claims."""
    from claimweft.operators import booking, revenue

    names = ["claim_id", "pcode", "client_cd", "network_cd", "payment_status", "processed_dt", "entry_dt", "savings_amt", "total_charge_amt", "fee_amount"]
    base = stage_table(claims(spark, sf_dir, *names).withColumn("received_dt", F.col("processed_dt")).withColumn("provider_zip_code", F.lit("2139.0")), "base")
    read = spark.sparkContext.accumulator(0)

    def counting(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    counted = base.mapInArrow(counting, base.schema)
    rates = base.select(F.col("pcode").alias("parent_client")).distinct().withColumns({"min_rate": F.lit(0.1), "avg_rate": F.lit(0.2)})
    paths = monthly_reports.write_reports(counted, str(tmp_path), "2025-01-09", rates, "1995-06-30")
    assert read.value == base.count() and len(paths) == 5
    month = base.withColumn("processed_month", F.date_format("processed_dt", "yyyy-MM"))
    wanted = {
        "booking_curve": booking.booking_long(base), "booking_status": booking.booking_status(base), "summary_stats": monthly_reports.summary(base),
        "rate_revenue": revenue.revenue_by_rate_dim(month, rates),
        "worklist": unpaid_worklist(base, "1995-06-30", ["pcode", "claim_id", "received_dt", "total_charge_amt", "savings_amt", "provider_zip_code", "payment_status"]),
    }
    for name, want in wanted.items():
        got = spark.read.parquet(paths[name]).drop("pull_date").transform(lambda df: df.toDF(*[c.lower() for c in df.columns]))
        want = want.toDF(*[c.lower() for c in want.columns])
        shared = [c for c in want.columns if c != "zip3"]
        assert set(shared) <= set(got.columns)
        text = lambda df: sorted(tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r) for r in df.select(shared).collect())
        assert text(got) == text(want.select(shared)), name


def test_quality_counts_come_with_the_write(spark, tmp_path):
    spark = spark.newSession()
    raw = raw_claims(spark).withColumn("processed_dt", F.when(F.col("claim_id") == "5", "31/31/2024").otherwise(F.col("processed_dt")))
    quality = Observation("quality")
    typed = monthly_reports.typed_extract(raw, ["processed_dt", "entry_dt"], ["savings_amt", "total_charge_amt", "fee_amount"], quality)
    typed.write.parquet(str(tmp_path / "typed"))
    assert quality.get == {"n_rows": 5, "unparsed_processed_dt": 1, "unparsed_entry_dt": 0, "unparsed_savings_amt": 1, "unparsed_total_charge_amt": 0, "unparsed_fee_amount": 0}


def test_pivot_takes_the_months_of_the_data(spark):
    from claimweft.operators import booking

    data = [("P", "1989-12-05", "1990-01-02", "PAID", "1", 1.0), ("P", "1989-12-06", "2031-07-01", "PAID", "2", 1.0), ("P", "1990-01-06", None, "UNPAID", "3", 1.0)]
    df = spark.createDataFrame(data, "pcode string, p string, e string, payment_status string, claim_id string, savings_amt double").selectExpr(
        "*", "to_date(p) as processed_dt", "to_date(e) as entry_dt")
    wide = booking.booking_pivot(df)
    assert [c for c in wide.columns if c.startswith("entry_")] == ["entry_1990_01", "entry_2031_07"]
    cells = booking.booking_cells(df)
    assert booking.pivot_completeness(cells, wide).first().complete
    partial = booking.pivot_completeness(cells, booking.booking_pivot(df, ["1990-01"])).first()
    assert (partial.n_entered, partial.n_shown, partial.complete) == (2, 1, False)


def test_worklist_has_all_columns(spark):
    raw = spark.createDataFrame([tuple("x" for _ in WORKLIST_COLUMNS)], ", ".join(f"{c} string" for c in WORKLIST_COLUMNS)).drop("ZIP3")
    raw = raw.withColumns({
        "PAYMENT_STATUS": F.lit("UNPAID"), "SAVINGS_AMT": F.lit(5.0), "RECEIVED_DT": F.lit("2024-01-01"),
        "CLAIM_ID": F.lit(12), "PROVIDER_ZIP_CODE": F.lit("2139.0"),
    })
    out = unpaid_worklist(raw, "2023-12-31")
    assert [c.upper() for c in out.columns] == list(WORKLIST_COLUMNS)
    row = out.first()
    assert row["ZIP3"] == "021" and row["CLAIM_ID"] == "12"
    with pytest.raises(ValueError, match="MEMBER_ID"):
        unpaid_worklist(raw.drop("MEMBER_ID"), "2023-12-31")
