"""D: classification and distribution metrics, and the scorers of H."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqltext as S
from checks.registry import query
from checks.scans import length_model
from safelabel.catalog import BINARY_TEMPLATE, CATEGORIES, SAFE, UNSAFE
from safelabel.functions import vectors as V
from safelabel.operators import confusion as C
from safelabel.operators import ranking as R
from safelabel.operators import reports as P
from safelabel.operators.pairs import render_prompt
from safelabel.operators.sampling import ratio_split
from safelabel.operators.scoring import fit_binary_head, moderate_with_models, predict_binary_head, score_batches
from safelabel.plans.evaluation import normalised
from safelabel.streaming.jobs import moderated

METRICS = ("precision", "recall", "f1")


def judged(spark, sf):
    return normalised(I.predictions(spark, sf))


def scored(spark, sf):
    return R.score_rows(I.distributions(spark, sf))


# --- classification ------------------------------------------------------------------
@query("d07_accuracy", f"WITH {S.JUDGED} SELECT count(*) AS valid, round(avg(CASE WHEN gold = pred THEN 1.0::DOUBLE ELSE 0.0 END), 6) AS accuracy FROM valid")
def _(spark, sf):
    return C.accuracy(judged(spark, sf)).withColumns(I.six("accuracy"))


@query("d08_balanced_accuracy", f"""WITH {S.JUDGED}, r AS (SELECT gold, avg(CASE WHEN gold = pred THEN 1.0::DOUBLE ELSE 0.0 END) AS r FROM valid GROUP BY gold)
    SELECT round(avg(r), 6) AS balanced_accuracy FROM r""")
def _(spark, sf):
    return C.balanced_accuracy(judged(spark, sf)).withColumns(I.six("balanced_accuracy"))


_KAPPA = """SELECT {lead} round((po - pe) / (1 - pe), 6) AS kappa FROM (SELECT {lead} avg(CASE WHEN gold = pred THEN 1.0::DOUBLE ELSE 0.0 END) AS po,
    (SELECT sum(g.c * p.c)::DOUBLE FROM (SELECT gold, count(*) AS c FROM valid GROUP BY gold) g JOIN (SELECT pred, count(*) AS c FROM valid GROUP BY pred) p
    ON g.gold = p.pred) / (count(*)::DOUBLE * count(*)) AS pe FROM valid)"""


@query("d09_cohen_kappa", f"WITH {S.JUDGED} {_KAPPA.format(lead='')}")
def _(spark, sf):
    return C.cohen_kappa(judged(spark, sf)).withColumns(I.six("kappa"))


@query("d10_mcc", f"""WITH {S.JUDGED}, q AS (SELECT count(*) FILTER (WHERE gold = 'UNSAFE' AND pred = 'UNSAFE')::DOUBLE AS tp, count(*) FILTER (WHERE gold = 'SAFE' AND pred = 'SAFE')::DOUBLE AS tn,
    count(*) FILTER (WHERE gold = 'SAFE' AND pred = 'UNSAFE')::DOUBLE AS fp, count(*) FILTER (WHERE gold = 'UNSAFE' AND pred = 'SAFE')::DOUBLE AS fn FROM valid)
    SELECT round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc FROM q""")
def _(spark, sf):
    return C.mcc(judged(spark, sf)).withColumns(I.six("mcc"))


@query("d11_prf", f"""WITH {S.JUDGED}, {S.stats('valid', S.BINARY_LIST)} SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM classes""")
def _(spark, sf):
    return C.prf(judged(spark, sf)).withColumns(I.six(*METRICS))


@query("d12_confusion", f"""WITH {S.JUDGED} SELECT g AS gold, count(*) FILTER (WHERE pred = 'SAFE') AS "SAFE", count(*) FILTER (WHERE pred = 'UNSAFE') AS "UNSAFE"
    FROM unnest({S.BINARY_LIST}) AS u(g) LEFT JOIN valid ON gold = g GROUP BY g""")
def _(spark, sf):
    return C.confusion_matrix(judged(spark, sf))


@query("d13_confusion_17", f"""WITH {S.SCORED} SELECT g AS gold, p2 AS pred, count(top1.doc_id) AS n FROM unnest({S.CATEGORY_LIST}) AS u(g), unnest({S.CATEGORY_LIST}) AS w(p2)
    LEFT JOIN top1 ON gold = g AND pred = p2 GROUP BY ALL""")
def _(spark, sf):
    return C.confusion(R.winners(scored(spark, sf)), CATEGORIES)


@query("d14_report_binary", f"WITH {S.JUDGED}, {S.stats('valid', S.BINARY_LIST)} {S.report('valid', S.BINARY_LIST)}")
def _(spark, sf):
    return C.classification_report(judged(spark, sf)).withColumns(I.six(*METRICS))


@query("d14_report_17", f"WITH {S.SCORED}, {S.stats('top1', S.CATEGORY_LIST)} {S.report('top1', S.CATEGORY_LIST)}")
def _(spark, sf):
    return C.classification_report(R.winners(scored(spark, sf)), CATEGORIES, CATEGORIES).withColumns(I.six(*METRICS))


@query("d18_report_by_language", f"WITH {S.SCORED}, {S.stats('top1', None, 'language')} {S.report('top1', None, 'language')}")
def _(spark, sf):
    top = R.winners(scored(spark, sf))
    return C.classification_report(top, "present", CATEGORIES, by=["language"]).withColumns(I.six(*METRICS))


# --- distributions ---------------------------------------------------------------------
_USED = f"CASE WHEN {S.USABLE} THEN 1 END"
_COUNTS = f"""count(*) AS rows, count({_USED}) AS samples, count(CASE WHEN t IS NOT NULL AND p IS NOT NULL THEN 1 END) AS parsed,
    count(CASE WHEN t IS NOT NULL AND p IS NULL THEN 1 END) AS format_errors, count({_USED}) - count(t) AS truth_errors"""
_MEANS = "round(avg(kl), 6) AS mean_kl, round(avg(ap), 6) AS map, round(avg(r1), 6) AS top1_recall, round(avg(r3), 6) AS top3_recall"
_RATES = f"""round(count(CASE WHEN t IS NOT NULL AND p IS NOT NULL THEN 1 END)::DOUBLE / count(*), 6) AS success_rate,
    round((count({_USED}) - count(CASE WHEN t IS NOT NULL AND p IS NULL THEN 1 END))::DOUBLE / count({_USED}), 6) AS group_success_rate"""

MULTI = (f"{_COUNTS}, {_RATES}, {_MEANS}, round(avg(jac), 6) AS jaccard, round(avg(em), 6) AS exact_match, "
         "round(avg(hit), 6) AS top1_accuracy")


@query("d15_distribution_metrics", f"WITH {S.SCORED} SELECT {_MEANS} FROM scored")
def _(spark, sf):
    names = ["mean_kl", "map", "top1_recall", "top3_recall"]
    return R.distribution_metrics(scored(spark, sf)).withColumns(I.six(*names)).select(*names)


@query("d16_success_rate", f"WITH {S.SCORED} SELECT * EXCLUDE (group_success_rate) FROM (SELECT {_COUNTS}, {_RATES} FROM scored)")
def _(spark, sf):
    return R.success_rate(scored(spark, sf)).withColumns(I.six("success_rate"))


@query("d17_metrics_by_language", f"""WITH {S.SCORED}, m AS (SELECT language, FALSE AS is_overall, {_COUNTS}, {_RATES}, {_MEANS}, round(avg(jac), 6) AS jaccard,
    round(avg(em), 6) AS exact_match, round(avg(hit), 6) AS top1_accuracy FROM scored GROUP BY language UNION ALL SELECT NULL, TRUE, {_COUNTS}, {_RATES}, {_MEANS},
    round(avg(jac), 6), round(avg(em), 6), round(avg(hit), 6) FROM scored) SELECT * FROM m""")
def _(spark, sf):
    table = R.distribution_metrics(scored(spark, sf), "language", overall=True)
    doubles = [f.name for f in table.schema.fields if f.dataType.typeName() == "double"]
    return table.withColumns(I.six(*doubles))


@query("d19_jaccard", f"WITH {S.SCORED} SELECT round(avg(jac), 6) AS jaccard FROM scored")
def _(spark, sf):
    return R.distribution_metrics(scored(spark, sf)).withColumns(I.six("jaccard")).select("jaccard")


@query("d20_exact_match", f"WITH {S.SCORED} SELECT round(avg(em), 6) AS exact_match FROM scored")
def _(spark, sf):
    return R.distribution_metrics(scored(spark, sf)).withColumns(I.six("exact_match")).select("exact_match")


_BY = f"m AS (SELECT language, count({_USED}) AS samples, avg(ap) AS map, avg(kl) AS mean_kl FROM scored GROUP BY language)"


@query("d30_best_language", f"""WITH {S.SCORED}, {_BY} SELECT 'map' AS metric, arg_max(language, map) AS language, round(max(map), 6) AS value FROM m
    UNION ALL SELECT 'mean_kl', arg_min(language, mean_kl), round(min(mean_kl), 6) FROM m""")
def _(spark, sf):
    table = R.distribution_metrics(scored(spark, sf), "language")
    return R.best_of(table, "language", {"map": True, "mean_kl": False}).withColumns(I.six("value"))


@query("d31_mean_group_size", f"WITH {S.SCORED}, {_BY} SELECT avg(samples) AS mean_size FROM m")
def _(spark, sf):
    return R.mean_group_size(R.distribution_metrics(scored(spark, sf), "language"))


def _run_sql():
    s = S.stats("valid", S.BINARY_LIST, "run")
    return f"""WITH {S.JUDGED}, {s}, basic AS (SELECT run, count(*) AS valid, avg(CASE WHEN gold = pred THEN 1.0::DOUBLE ELSE 0.0 END) AS acc,
    avg(CASE WHEN gold = pred THEN 1.0::DOUBLE ELSE 0.0 END) FILTER (WHERE gold = 'SAFE') AS rs, avg(CASE WHEN gold = pred THEN 1.0::DOUBLE ELSE 0.0 END) FILTER (WHERE gold = 'UNSAFE') AS ru,
    count(*) FILTER (WHERE gold = 'UNSAFE' AND pred = 'UNSAFE')::DOUBLE AS tp, count(*) FILTER (WHERE gold = 'SAFE' AND pred = 'SAFE')::DOUBLE AS tn,
    count(*) FILTER (WHERE gold = 'SAFE' AND pred = 'UNSAFE')::DOUBLE AS fp, count(*) FILTER (WHERE gold = 'UNSAFE' AND pred = 'SAFE')::DOUBLE AS fn FROM valid GROUP BY run),
    chance AS (SELECT g AS run, sum(support * predicted)::DOUBLE / (sum(support) * sum(support))::DOUBLE AS pe FROM stats GROUP BY g)
    SELECT b.run, b.valid, round(acc, 6) AS accuracy, round((rs + ru) / 2, 6) AS balanced_accuracy, round((acc - pe) / (1 - pe), 6) AS kappa,
    round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc,
    (SELECT round(f, 6) FROM classes c WHERE c.g = b.run AND label = 'SAFE') AS f1_safe, (SELECT round(f, 6) FROM classes c WHERE c.g = b.run AND label = 'UNSAFE') AS f1_unsafe
    FROM basic b JOIN chance USING (run)"""


@query("d32_compare_runs", _run_sql())
def _(spark, sf):
    table = P.compare_runs(judged(spark, sf))
    return table.withColumns(I.six(*[c for c in table.columns if c not in ("run", "valid")]))


@query("d32_compare_distributions", f"""WITH {S.SCORED}, runs AS (SELECT *, CASE WHEN {S.digit('run')} < '8' THEN 'run_a' ELSE 'run_b' END AS run FROM scored)
    SELECT run, {_COUNTS}, {_RATES}, {_MEANS}, round(avg(jac), 6) AS jaccard, round(avg(em), 6) AS exact_match, round(avg(hit), 6) AS top1_accuracy,
    round(avg((doc_id % 7)::DOUBLE / 4), 6) AS mean_latency_sec FROM runs GROUP BY run""")
def _(spark, sf):
    runs = scored(spark, sf).withColumns({
        "run": F.when(I.digit("run") < "8", "run_a").otherwise("run_b"), "latency_sec": (F.col("doc_id") % 7) / 4})
    table = R.compare_distribution_runs(runs, latency="latency_sec")
    return table.withColumns(I.six(*[f.name for f in table.schema.fields if f.dataType.typeName() == "double"]))


# --- scorers ---------------------------------------------------------------------------
def _prompts(spark, sf):
    return render_prompt(I.documents(spark, sf), BINARY_TEMPLATE).select("doc_id", "prompt")


_CHARS = f"(length(text) + {len(BINARY_TEMPLATE.replace("{text}", ""))})"


@query("h02_batched_scores", f"WITH {S.DOCS} SELECT doc_id, CASE WHEN {_CHARS} % 3 = 0 THEN 'UNSAFE' ELSE 'SAFE' END AS pred_raw FROM docs")
def _(spark, sf):
    return score_batches(_prompts(spark, sf), length_model(), batch_size=64).select("doc_id", "pred_raw")


def failing_model():
    """As ``length_model``, but a batch with a prompt whose length 7 divides fails as a whole."""
    def make():
        def answer(prompts):
            for p in prompts:
                if len(p) % 7 == 0:
                    raise ValueError(f"length {len(p)}")
            return ["UNSAFE" if len(p) % 3 == 0 else "SAFE" for p in prompts]

        return answer

    return make


@query("h02_failing_prompts", f"""WITH {S.DOCS} SELECT doc_id, CASE WHEN {_CHARS} % 7 = 0 THEN NULL WHEN {_CHARS} % 3 = 0 THEN 'UNSAFE' ELSE 'SAFE' END AS pred_raw,
    CASE WHEN {_CHARS} % 7 = 0 THEN 'ValueError: length ' || {_CHARS} END AS error FROM docs""")
def _(spark, sf):
    scored_rows = score_batches(_prompts(spark, sf), failing_model(), batch_size=64, error="error", retries=1)
    return scored_rows.select("doc_id", "pred_raw", "error")


@query("d21_latency_by_run", f"WITH {S.PREDICTIONS} SELECT run, round(avg((doc_id % 7)::DOUBLE / 4), 6) AS mean_latency_sec FROM predictions GROUP BY run")
def _(spark, sf):
    rows = I.predictions(spark, sf).withColumn("latency_sec", (F.col("doc_id") % 7) / 4)
    return P.mean_latency(rows, ["run"]).withColumns(I.six("mean_latency_sec"))


@query("d21_mean_latency")
def _(spark, sf):
    rows = score_batches(_prompts(spark, sf), length_model(), batch_size=64, latency="latency_sec")
    return P.mean_latency(rows)


def category_model():
    """Stand-in for the second model."""
    return lambda: (lambda prompts: [f"S{len(p) % 17 + 1}" for p in prompts])


@query("h03_two_models", f"""WITH {S.DOCS} SELECT doc_id, CASE WHEN {_CHARS} % 3 = 0 THEN 'UNSAFE' ELSE 'SAFE' END AS binary_raw,
    CASE WHEN {_CHARS} % 3 = 0 THEN concat('S', {_CHARS} % 17 + 1) END AS category_raw FROM docs""")
def _(spark, sf):
    rows = moderate_with_models(_prompts(spark, sf), length_model(), category_model(), batch_size=64)
    return rows.select("doc_id", "binary_raw", "category_raw")


@query("h03_two_stage_moderation", f"""WITH {S.VECTORS} SELECT doc_id, CASE WHEN safe THEN 'SAFE' WHEN list_sum(c) = 0 THEN '' ELSE {S.winner('v')} END AS category,
    CASE WHEN safe THEN 'SAFE' ELSE 'UNSAFE' END AS safety FROM (SELECT *, NOT {S.any_term('text')} AS safe FROM vectors)""")
def _(spark, sf):
    return moderated(I.documents(spark, sf), I.LEXICON, I.TAXONOMY).select("doc_id", "response.category", "response.safety")


def _held_out(spark, sf):
    """Gold and predicted label of the test rows, by a head fitted on the training rows."""
    rows = I.binary_rows(spark, sf).select("doc_id", "text", F.when(F.col("harmful") == "1", UNSAFE).otherwise(SAFE).alias("label"))
    rows = ratio_split(rows, 0.9, I.SEED, "doc_id")
    model = fit_binary_head(rows.filter("split = 'train'"), kind="logistic")
    return predict_binary_head(model, rows.filter("split = 'test'")).withColumnRenamed("label", "gold")


@query("h04_binary_head")
def _(spark, sf):
    return C.prf(_held_out(spark, sf)).withColumns(I.six(*METRICS))


@query("h04_held_out", f"""WITH {S.BINARY}, total AS (SELECT count(*) AS n FROM binary_rows),
    placed AS (SELECT harmful, row_number() OVER (ORDER BY {S.row_hash(I.SEED, 'doc_id')}, doc_id) AS rn FROM binary_rows),
    test AS (SELECT harmful FROM placed, total WHERE rn > greatest(1, least(floor(n * 0.9::DOUBLE), n - 1)))
    SELECT label, count(*) FILTER (WHERE harmful = h) AS support FROM test, (VALUES ('SAFE', '0'), ('UNSAFE', '1')) AS l(label, h) GROUP BY label""")
def _(spark, sf):
    return C.prf(_held_out(spark, sf)).select("label", "support")
