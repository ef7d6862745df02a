"""Factor table, payment tree and batch scoring over the claims."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from claimweft.functions.codes import CATEGORICAL, NUMERIC
from claimweft.models.factors import factor_table, factors_long
from claimweft.models.scoring import score_batch
from claimweft.models.training import GRIDS, candidate_models, feature_importances, feature_stages, fit_tree, label_leaves
from claimweft.plans.adapters import CLAIMS_SQL, claims, table
from claimweft.plans.income_model import CLASSES, LABEL, labelled, train as train_income
from claimweft.operators.encoding import with_class_weight
from claimweft.plans.registry import query
from claimweft.session import stage_in_passes, stage_table, staged_path

_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query("q_factor_table", f"""
WITH {CLAIMS_SQL}
SELECT claim_id, CAST(savings_amt AS DOUBLE) AS savings_amt, CAST(total_charge_amt AS DOUBLE) AS total_charge_amt,
       CASE WHEN fee_amount = 0 THEN CASE WHEN savings_amt > 0 THEN 1.0 ELSE 0.0 END
            ELSE CAST(savings_amt AS DOUBLE) / CAST(total_charge_amt AS DOUBLE) END AS savings_rate,
       CASE WHEN payment_status = 'PAID' THEN 1 ELSE 0 END AS target,
       {', '.join(f"(client_cd = '{s}')::INT AS client_cd_{s}" for s in _SEGMENTS)},
       {', '.join(f"(adjustmentstatus = '{s}')::INT AS adjustmentstatus_{s}" for s in 'ANR')}
FROM (SELECT * REPLACE (CASE WHEN fee_amount = 0 THEN 0 ELSE total_charge_amt END AS total_charge_amt) FROM claims)
""")
def factors(spark, folder):
    rows = claims(
        spark, folder, "claim_id", "client_cd", "adjustmentstatus", "savings_amt", "total_charge_amt", "payment_status",
        "fee_amount",
    )
    rows = rows.withColumn(
        "total_charge_amt", F.when(F.col("fee_amount") == 0, F.lit(0)).otherwise(F.col("total_charge_amt"))
    )
    values = {"client_cd": _SEGMENTS, "adjustmentstatus": "ANR"}
    return factor_table(rows, categories=["client_cd", "adjustmentstatus"], values=values)


@query("q_factors_long", """
WITH r AS (SELECT o_orderkey::VARCHAR AS claim_id, o_orderpriority AS client_cd, o_custkey::VARCHAR AS network,
                  left(lpad((o_orderkey % 100000)::VARCHAR, 5, '0'), 3) AS zip3, o_totalprice AS charge, o_totalprice * 0.25 AS savings,
                  (o_orderstatus = 'F')::INT AS target FROM orders)
SELECT claim_id, 'client_cd_' || client_cd AS factor, 1.0::DOUBLE AS value FROM r UNION ALL
SELECT claim_id, 'last_closure_network_cd_' || network, 1.0 FROM r UNION ALL
SELECT claim_id, 'zip3_' || zip3, 1.0 FROM r UNION ALL
SELECT claim_id, 'savings_amt', savings FROM r WHERE savings <> 0 UNION ALL
SELECT claim_id, 'total_charge_amt', charge FROM r WHERE charge <> 0 UNION ALL
SELECT claim_id, 'savings_rate', 0.25 FROM r WHERE charge <> 0 UNION ALL
SELECT claim_id, 'target', 1.0 FROM r WHERE target = 1
""")
def factors_sparse(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey as claim_id", "o_orderpriority as client_cd", "o_custkey as last_closure_network_cd",
        "lpad(cast(o_orderkey % 100000 as string), 5, '0') as zip5", "o_totalprice as total_charge_amt",
        "o_totalprice * 0.25 as savings_amt", "case when o_orderstatus = 'F' then 'PAID' end as payment_status",
    )
    return factors_long(rows, categories=["client_cd", "last_closure_network_cd", "zip3"])


def _tree_rows(spark, folder):
    """Factor rows, staged: fitting goes over them several times."""
    rows = claims(
        spark, folder, "claim_id", "line_number", "claim_type", "client_cd", "savings_amt", "total_charge_amt",
        "fee_amount", "payment_status", "part_key",
    ).select(
        "claim_id", "line_number", "claim_type", "client_cd", F.col("part_key").alias("procedure_cd"),
        *[F.col(c).cast("double").alias(c) for c in ("savings_amt", "total_charge_amt", "fee_amount")],
        F.expr("cast(payment_status = 'PAID' as int)").alias("target"),
    )
    return stage_in_passes(rows, "factors", ["claim_id"], table(spark, folder, "lineitem").count())


def _tree(rows):
    """The procedure takes thousands of values."""
    return fit_tree(rows, ["savings_amt", "total_charge_amt", "fee_amount"], ["claim_type", "client_cd", "procedure_cd"])


@query("q_tree_leaves")
def tree_leaves(spark, folder):
    rows = _tree_rows(spark, folder)
    return stage_in_passes(label_leaves(_tree(rows), rows, ["claim_id", "line_number", "target"]), "leaves", ["claim_id"], rows.count())


@query("q_tree_check", """
SELECT COUNT(*) AS n_rows, CAST(SUM((l_linestatus = 'F')::INT) AS BIGINT) AS n_paid, TRUE AS shares_hold, TRUE AS leaves_bounded,
       TRUE AS importances_sum, 0 AS n_unknown_features
FROM lineitem
""")
def tree_check(spark, folder):
    """What must hold of any fitted tree: its leaves cover all rows and predict their own shares."""
    rows = _tree_rows(spark, folder)
    model = _tree(rows)
    leaves = label_leaves(model, rows, ["target"]).groupBy("leaf_label").agg(
        F.count("*").alias("n"), F.sum("target").alias("paid"), F.max("prob_paid").alias("high"), F.min("prob_paid").alias("low")
    )
    share = F.col("paid") / F.col("n")
    used = feature_importances(model, rows).agg(
        (F.abs(F.sum("importance") - 1) < 1e-6).alias("importances_sum"),
        F.count_if(~F.col("feature").rlike("savings_amt|total_charge_amt|fee_amount|claim_type|client_cd|procedure_cd")).cast("int").alias("n_unknown_features"),
    )
    return leaves.agg(
        F.sum("n").alias("n_rows"), F.sum("paid").alias("n_paid"),
        F.every((F.abs(F.col("high") - share) < 1e-9) & (F.abs(F.col("low") - share) < 1e-9)).alias("shares_hold"),
        (F.count("*") <= 32).alias("leaves_bounded"),
    ).crossJoin(F.broadcast(used))  # one row each


@query("q_feature_importance")
def importances(spark, folder):
    rows = _tree_rows(spark, folder)
    return feature_importances(_tree(rows), rows, 15)


def _people(spark, folder):
    """Orders as census records: codes from the keys, wage from the price."""
    moduli = {"TEN": 5, "RAC1P": 10, "CIT": 6, "SCHL": 24, "BLD": 11, "HUPAC": 5, "COW": 6, "MAR": 6, "SEX": 3, "VEH": 7, "WKL": 4}
    codes = [f"cast(o_custkey % {m} as int) as {c}" for c, m in moduli.items()]
    numbers = [
        "cast(10 + o_custkey % 70 as int) as AGEP", "1 as NPF", "cast(o_orderkey % 50 as string) as GRPIP",
        "case when o_orderkey % 9 <> 0 then cast(o_totalprice / 8000 as int) end as WKHP",
    ]
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey as person", "13 as ST", *codes, *numbers,
        "o_totalprice / 6 + 500 * (o_custkey % 24) as WAGP",
    )


def _income(spark, folder):
    """People, staged, and the logistic model of the income search with its own iterations, fitted on four fifths."""
    people = stage_table(_people(spark, folder), "people")
    train = stage_table(with_class_weight(labelled(people.filter("person % 5 <> 0")), LABEL, CLASSES), "train-rows")
    stages = feature_stages(train, NUMERIC, CATEGORICAL, scale=True)
    logreg = candidate_models(LABEL, "weight", train.count())["logreg"]
    return people, PipelineModel([*stages, logreg.fit(PipelineModel(stages).transform(train))])


@query("q_batch_scoring")
def batch_scoring(spark, folder):
    people, model = _income(spark, folder)
    return score_batch(model, people.drop("WAGP"), ["person"])  # all are scored; a fifth was not trained on


_PEOPLE_SQL = """
  SELECT o_orderkey AS person, (o_totalprice / 6 + 500 * (o_custkey % 24) > 50000)::INT AS y, 10 + o_custkey % 70 >= 16 AS of_age FROM orders
"""


@query("q_scoring_check", f"""
WITH p AS ({_PEOPLE_SQL})
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT person) AS n_people, 0 AS n_wrong_answers, 0 AS n_wrong_confidence, 0 AS n_changed_by_saving, TRUE AS better_than_chance
FROM p
""")
def scoring_check(spark, folder):
    """Train, save, load, score: the answers follow the threshold and do not depend on the saved form."""
    people, model = _income(spark, folder)
    path = staged_path(spark, "income-model")
    model.save(path)
    threshold = 0.5
    batch = people.drop("WAGP")
    out = score_batch(PipelineModel.load(path), batch, ["person"], threshold)
    before = score_batch(model, batch, ["person"], threshold).select("person", F.col("probability_income_gt_50k").alias("before"))
    p = F.col("probability_income_gt_50k")
    sure = F.when(p >= threshold, p).otherwise(1 - p) * 100
    answers = labelled(people).select("person", LABEL)
    checked = out.join(before, "person").join(answers, "person", "left")
    right = (F.col("prediction") == "Income > 50K").cast("int") == F.col(LABEL)
    base = F.greatest(F.avg(LABEL), 1 - F.avg(LABEL))
    return checked.agg(
        F.count("*").alias("n_rows"), F.countDistinct("person").alias("n_people"),
        F.count_if((p >= threshold) != (F.col("prediction") == "Income > 50K")).cast("int").alias("n_wrong_answers"),
        F.count_if(F.abs(F.col("confidence_percent") - sure) > 0.0051).cast("int").alias("n_wrong_confidence"),
        F.count_if(F.abs(p - F.col("before")) > 1e-12).cast("int").alias("n_changed_by_saving"),
        (F.avg(F.when(F.col(LABEL).isNotNull(), right.cast("int"))) > base).alias("better_than_chance"),
    )


@query("q_model_choice", f"""
WITH p AS ({_PEOPLE_SQL}),
     n AS (SELECT y, COUNT(*) AS n, CAST(round_even(COUNT(*) * 0.2, 0) AS BIGINT) AS held FROM p WHERE of_age GROUP BY y)
SELECT CAST(SUM(n - held) AS BIGINT) AS n_train, CAST(SUM(held) AS BIGINT) AS n_holdout, CAST(SUM(CASE WHEN y = 1 THEN held ELSE 0 END) AS BIGINT) AS n_holdout_paid,
       5 AS n_folds, CAST(SUM((n - held) // 5) AS BIGINT) AS smallest_fold, CAST(SUM((n - held + 4) // 5) AS BIGINT) AS largest_fold,
       TRUE AS auc_agrees, TRUE AS best_is_chosen, TRUE AS folds_agree, TRUE AS threshold_is_best
FROM n
""")
def model_choice(spark, folder):
    """Three models searched over five folds, chosen on hold-out rows; areas and threshold counted again from the scores."""
    choice = train_income(labelled(_people(spark, folder)), ["person"])
    scores = choice.scored.select(F.col("probability_1").alias("p"), F.col(LABEL).alias("y"))
    # ranks of the positives (mean rank among equal scores), over counts per distinct score
    counts = scores.groupBy("p").agg(F.sum("y").alias("pos"), F.count("*").alias("n"))
    steps = spark.sql("""
        SELECT p, pos, n, SUM(n) OVER (ORDER BY p) AS upto, SUM(pos) OVER (ORDER BY p DESC) AS hits, SUM(n) OVER (ORDER BY p DESC) AS flagged,
               SUM(pos) OVER () AS positives, SUM(n) OVER () AS total FROM {counts}
    """, counts=stage_table(counts, "holdout-scores"))
    f1 = 2 * F.col("hits") / (F.col("flagged") + F.col("positives"))
    auc = (F.sum(F.col("pos") * (F.col("upto") - (F.col("n") - 1) / 2)) - F.max("positives") * (F.max("positives") + 1) / 2) / (
        F.max("positives") * (F.max("total") - F.max("positives")))
    folds = choice.train_rows.groupBy("fold").count()
    per_class = choice.train_rows.groupBy("fold", LABEL).count().groupBy(LABEL).agg((F.max("count") - F.min("count")).alias("spread"))
    held = scores.agg(F.count("*").alias("n_holdout"), F.sum("y").alias("n_holdout_paid"))
    fitted = folds.agg(F.sum("count").alias("n_train"), F.count("*").cast("int").alias("n_folds"))
    sizes = choice.train_rows.groupBy(LABEL).count().agg(F.sum(F.floor(F.col("count") / 5)).alias("smallest_fold"), F.sum(F.floor((F.col("count") + 4) / 5)).alias("largest_fold"))
    measured = steps.agg(
        (F.abs(auc - choice.holdout_auc[choice.name]) < 1e-9).alias("auc_agrees"),
        (F.abs(F.max(f1) - F.max(F.when(F.col("p") == choice.threshold, f1))) < 1e-12).alias("threshold_is_best"),
    )
    told = F.lit(max(choice.holdout_auc.values()) == choice.holdout_auc[choice.name] and set(choice.holdout_auc) == set(GRIDS))
    parts = [fitted, held, sizes, measured.withColumn("best_is_chosen", told), per_class.agg((F.max("spread") <= 1).alias("folds_agree"))]  # one row each
    rows = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    names = ("n_train", "n_holdout", "n_holdout_paid", "n_folds", "smallest_fold", "largest_fold", "auc_agrees", "best_is_chosen", "folds_agree", "threshold_is_best")
    return rows.agg(*[F.max(n).alias(n) for n in names])
