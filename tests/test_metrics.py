import pytest

from safelabel.operators import confusion as C
from safelabel.operators import ranking as R
from safelabel.operators import reports as P
from safelabel.plans.evaluation import evaluate_binary, evaluate_distributions


@pytest.fixture(scope="module")
def published(spark):
    """The published 2x2 matrix, spread out to one row per prediction."""
    cells = [("SAFE", "SAFE", 10103), ("SAFE", "UNSAFE", 518), ("UNSAFE", "SAFE", 669), ("UNSAFE", "UNSAFE", 15670)]
    return spark.createDataFrame(cells, "gold string, pred string, n int").selectExpr("gold", "pred", "explode(sequence(1, n)) AS i")


def test_published_matrix(published):
    row = C.agreement(published).first()
    assert row.valid == 26960
    assert row.accuracy == pytest.approx(0.955972, abs=1e-6)
    assert row.balanced_accuracy == pytest.approx(0.955142, abs=1e-6)
    assert row.kappa == pytest.approx(0.908025, abs=1e-6)
    assert C.mcc(published).first().mcc == pytest.approx(0.908087, abs=1e-6)
    classes = {r.label: r for r in C.prf(published).collect()}
    assert classes["SAFE"].precision == pytest.approx(0.937895, abs=1e-6)
    assert classes["SAFE"].recall == pytest.approx(0.951229, abs=1e-6)
    assert classes["SAFE"].f1 == pytest.approx(0.944515, abs=1e-6)
    assert classes["UNSAFE"].precision == pytest.approx(0.968001, abs=1e-6)
    assert classes["UNSAFE"].recall == pytest.approx(0.959055, abs=1e-6)
    assert classes["UNSAFE"].f1 == pytest.approx(0.963507, abs=1e-6)
    matrix = {r.gold: (r.SAFE, r.UNSAFE) for r in C.confusion_matrix(published).collect()}
    assert matrix == {"SAFE": (10103, 518), "UNSAFE": (669, 15670)}
    assert "accuracy" in [r.label for r in C.classification_report(published).collect()]


@pytest.fixture(scope="module")
def with_unknown(spark):
    rows = [("SAFE", "SAFE"), ("SAFE", "UNKNOWN"), ("UNSAFE", "UNSAFE"), ("UNSAFE", "SAFE"), ("UNKNOWN", "SAFE")]
    return spark.createDataFrame(rows, "gold string, pred string")


def test_unknown_predictions_count_as_wrong(with_unknown):
    row = C.agreement(with_unknown).first()
    assert (row.valid, row.accuracy, row.balanced_accuracy) == (4, 0.5, 0.5)
    # Chance agreement: SAFE 2*2, UNSAFE 2*1, UNKNOWN 0*1, over 16.
    assert row.kappa == pytest.approx((0.5 - 6 / 16) / (1 - 6 / 16))
    matrix = {r.gold: (r.SAFE, r.UNSAFE) for r in C.confusion_matrix(with_unknown).collect()}
    assert matrix == {"SAFE": (1, 0), "UNSAFE": (1, 1)}
    report = {r.label: r for r in C.classification_report(with_unknown).collect()}
    assert set(report) == {"SAFE", "UNSAFE", "micro avg", "macro avg", "weighted avg"}
    assert report["micro avg"].precision == pytest.approx(2 / 3) and report["micro avg"].recall == 0.5
    present = {r.label for r in C.classification_report(with_unknown, "present").collect()}
    assert "UNKNOWN" in present and "accuracy" in present


def test_metrics_without_rows(spark, with_unknown):
    nothing = with_unknown.filter("gold = 'none'")
    assert C.agreement(nothing).count() == 0
    assert C.prf(nothing).count() == 0


def test_one_class_only(spark):
    rows = spark.createDataFrame([("SAFE", "SAFE")] * 3, "gold string, pred string")
    row = C.agreement(rows).first()
    assert (row.accuracy, row.balanced_accuracy, row.kappa) == (1.0, 1.0, None)
    assert C.mcc(rows).first().mcc == 0.0
    unsafe = {r.label: r for r in C.prf(rows).collect()}["UNSAFE"]
    assert (unsafe.precision, unsafe.recall, unsafe.f1, unsafe.support) == (0.0, 0.0, 0.0, 0)


def test_confusion_lists_every_pair(spark):
    labels = [f"S{i}" for i in range(1, 18)]
    rows = spark.createDataFrame([("S1", "S2"), ("S1", "S2"), ("S17", "S17")], "gold string, pred string")
    cells = {(r.gold, r.pred): r.n for r in C.confusion(rows, labels).collect()}
    assert len(cells) == 289 and cells["S1", "S2"] == 2 and cells["S17", "S17"] == 1 and sum(cells.values()) == 3


def test_evaluation_plans(spark, sf):
    from checks import inputs

    reports = evaluate_binary(inputs.predictions(spark, sf), by=["run"])
    assert {r.run for r in reports["metrics"].collect()} == {"run_a", "run_b"}
    whole = evaluate_binary(inputs.predictions(spark, sf))
    assert whole["metrics"].first().valid == sum(r.valid for r in reports["metrics"].collect())
    reports = evaluate_distributions(inputs.distributions(spark, sf))
    metrics = reports["metrics"].collect()
    overall = [r for r in metrics if r.is_overall]
    assert len(overall) == 1 and overall[0].rows == sum(r.rows for r in metrics if not r.is_overall)
    assert reports["confusion"].count() == 289


def test_best_by_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5), ("d", None)], "g string, m double")
    assert R.best_by(df, "g", "m").first().g == "a"
    assert R.best_by(df, "g", "m", largest=False).first().g == "c"


# --- published dataset reports ----------------------------------------------------------
COUNTS = {"S1": 41880, "S2": 18464, "S3": 8548, "S4": 2632, "S5": 580, "S6": 7780, "S8": 528, "S9": 40, "S10": 32844,
          "S11": 596, "S12": 1208, "S13": 308, "S14": 1228, "S15": 36, "S16": 40, "S17": 3148}


def test_published_category_shares(spark):
    rows = spark.createDataFrame([(c, n) for c, n in COUNTS.items()], "c string, n int").selectExpr("c AS safety_categories", "explode(sequence(1, n)) AS i")
    shares = {r.category: (r.n, round(100 * r.share, 2)) for r in P.category_share(rows).collect()}
    assert sum(n for n, _ in shares.values()) == 119860
    assert shares["S1"] == (41880, 34.94) and shares["S10"] == (32844, 27.40) and shares["S2"][1] == 15.40
    top = {r.category: r.n for r in P.top_n_other(P.category_share(rows).drop("share")).collect()}
    assert set(top) == {"S1", "S10", "S2", "S3", "S6", "S17", "Others"} and sum(top.values()) == 119860


def test_published_cross_table(spark):
    table = [("bn", 24942, 46500), ("or", 30000, 32565), ("ml", 26933, 41065), ("kn", 29537, 42704)]
    rows = spark.createDataFrame(table, "language string, safe int, bad int").selectExpr(
        "language", "explode(concat(array_repeat('0', safe), array_repeat('1', bad))) AS harmful")
    out = {r.language: r for r in P.label_by_language(rows).collect()}
    assert (out["(all)"].total, out["(all)"].safe, out["(all)"].harmful) == (274246, 111412, 162834)
    assert out["bn"].harmful_pct == pytest.approx(65.09)


def test_histogram_full_lists_empty_categories(spark):
    df = spark.createDataFrame([([0.0] * 16 + [1.0],), ([0.0] * 17,)], "v array<double>")
    rows = P.category_histogram(df, "v", full=True).collect()
    assert len(rows) == 17 and {r.category: r.n for r in rows if r.n} == {"S1": 1, "S17": 1}
    assert rows[0].category == "S1"


def test_best_of_takes_each_metric_in_one_pass(spark):
    df = spark.createDataFrame([("a", 0.5, 2.0), ("b", 0.9, None), ("c", 0.9, 1.0), ("d", None, 1.0)], "g string, up double, down double")
    rows = {r.metric: (r.g, r.value) for r in R.best_of(df, "g", {"up": True, "down": False}).collect()}
    assert rows == {"up": ("b", 0.9), "down": ("c", 1.0)}
    assert [r.g for r in R.best_of(df.limit(0), "g", {"up": True}).collect()] == [None]


def test_pairing_reports_what_does_not_match(spark):
    from safelabel.operators.pairs import pair_predictions, pairing_summary

    gold = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id int")
    pred = spark.createDataFrame([(2, "x"), (3, "y"), (3, "z"), (4, "w"), (None, "v")], "id int, pred string")
    assert pairing_summary(gold, pred).first() == (2, 1, 1, 1, 1)
    kept = sorted((str(r.id), str(r.pred)) for r in pair_predictions(gold, pred, keep_unmatched=True).collect())
    assert kept == [("1", "None"), ("2", "x"), ("2", "x"), ("3", "y"), ("3", "z"), ("None", "None")]


def test_distribution_sums_add_up_to_the_metrics(spark, sf):
    from checks import inputs

    scored = R.score_rows(inputs.distributions(spark, sf)).withColumn("half", inputs.digit("half") < "8")
    direct = R.distribution_metrics(scored, "language").orderBy("language").collect()
    added = R.distribution_metrics(R.distribution_sums(scored, ["language", "half"]), "language", counted=True).orderBy("language").collect()
    for a, b in zip(direct, added, strict=True):
        assert all(x == y if not isinstance(x, float) else abs(x - y) < 1e-9 for x, y in zip(a, b))
