import math

import pytest
from pyspark.sql import functions as F

from safelabel.functions import vectors as V
from tests.helpers import column

FULL = "{" + ", ".join(f"S{i}: 0.1" for i in range(1, 18)) + "}"


def with_value(value, at=17):
    return "{" + ", ".join(f"S{i}: {value if i == at else '0.1'}" for i in range(1, 18)) + "}"


def test_parse_distribution(spark):
    cases = {
        FULL: [0.1] * 17,
        ", ".join("S3: 0.1" for _ in range(17)): [0.1] * 17,
        ", ".join(f"S{i}: 0.1" for i in range(16)): None,
        ", ".join(f"S{i}: 0.1" for i in range(18)): None,
        "{" + ", ".join(f'"S{i}": 0.2' for i in range(1, 18)) + "}": None,
        " ".join(["0.5"] * 17): [0.5] * 17,
        with_value("1e-05", 1): [1.0] + [0.1] * 16,
        with_value("-0.1"): None,
        with_value("0.05."): None,
        with_value("."): None,
        with_value(".5"): [0.1] * 16 + [0.5],
        with_value("1."): [0.1] * 16 + [1.0],
        with_value("০.৫", 2): [0.1, 0.5] + [0.1] * 15,
        FULL.replace(": ", ":  "): [0.1] * 17,
        FULL.replace(": ", ":"): [0.1] * 17,
        "": None,
        None: None,
    }
    assert column(spark, list(cases), V.parse_distribution) == list(cases.values())


def test_format_then_parse(spark):
    vec = [0.25, 0.75] + [0.0] * 14 + [1e-7]
    df = spark.createDataFrame([(vec,), (None,)], "v array<double>")
    text = V.format_distribution("v")
    assert [r[0] for r in df.select(V.parse_distribution(text)).collect()] == [vec, None]
    assert df.select(text).first()[0].startswith("{S1: 0.2500000000, S2: 0.7500000000, S3: 0, ")


def test_parse_kv_and_json(spark):
    assert column(spark, ["S1: 0.25, S2:0.5 ,S3: x, S4", "a: 1, a: 2", "k: 1.5e1z"], V.parse_kv) == [
        {"S1": 0.25, "S2": 0.5, "S3": None, "S4": None}, {"a": 2.0}, {"k": 15.0}]
    assert column(spark, ['{"S1": 0.2, "S2": 0}', "no", None], V.parse_distribution_json) == [{"S1": 0.2, "S2": 0.0}, {}, {}]


def test_maps(spark):
    maps = [{"S1": 1.0, "S2": 3.0}, {"S1": 0.0}]
    assert column(spark, maps, V.normalise_map, "map<string,double>") == [{"S1": 0.25, "S2": 0.75}, {"S1": 0.0}]
    assert column(spark, maps, V.non_zero, "map<string,double>") == [{"S1": 1.0, "S2": 3.0}, {}]
    assert column(spark, maps, lambda m: V.map_to_vector(m, ["S1", "S2"]), "map<string,double>") == [[1.0, 3.0], [0.0, 0.0]]


def test_choosing(spark):
    vs = [[0.0, 0.5, 0.5], [0.0, 0.0, 0.0], [0.2, 0.1, 0.2]]
    names = ["S1", "S2", "S3"]
    assert column(spark, vs, lambda v: V.winner(v, names), "array<double>") == ["S2", "S1", "S1"]
    assert [tuple(r) for r in column(spark, vs, lambda v: V.majority(v, names), "array<double>")] == [("S2", 0.5), ("", 0.0), ("S1", 0.2)]
    assert column(spark, vs, lambda v: V.top_k(v, 1), "array<double>") == [[2], [2], [2]]
    assert column(spark, vs, V.positives, "array<double>") == [[1, 2], [], [0, 1, 2]]


def pair(spark, truth, pred, expr):
    return spark.createDataFrame([(truth, pred)], "t array<double>, p array<double>").select(expr("t", "p")).first()[0]


def test_row_metrics_by_hand(spark):
    t, p = [0.0, 0.5, 0.5, 0.0], [0.3, 0.3, 0.1, 0.3]
    assert pair(spark, t, p, V.average_precision) == pytest.approx(0.416667, abs=1e-6)
    assert pair(spark, t, p, V.kl_divergence) == pytest.approx(1.060132, abs=1e-6)
    assert pair(spark, t, p, lambda a, b: V.top_k(b, 1)) == [3]
    assert pair(spark, t, p, lambda a, b: V.topk_recall(a, b, 1)) == 0.0
    assert pair(spark, t, p, lambda a, b: V.topk_recall(a, b, 3)) == 0.5
    assert pair(spark, t, p, V.jaccard) == 0.5
    assert pair(spark, t, p, V.exact_match) == 0.0
    assert pair(spark, t, t, V.exact_match) == 1.0
    assert pair(spark, t, t, V.kl_divergence) == pytest.approx(0.0, abs=1e-12)


def test_row_metrics_without_positives(spark):
    zero, p = [0.0] * 4, [0.3, 0.3, 0.1, 0.3]
    assert pair(spark, zero, p, V.average_precision) is None
    assert pair(spark, zero, p, lambda a, b: V.topk_recall(a, b, 3)) is None
    assert math.isfinite(pair(spark, zero, p, V.kl_divergence))
    assert pair(spark, zero, zero, V.jaccard) == 1.0


def test_row_metrics_stay_in_range(spark, sf):
    from checks import inputs
    from safelabel.operators.ranking import score_rows

    rows = score_rows(inputs.distributions(spark, sf)).filter("parsed")
    bad = rows.filter("kl < -1e-9 OR ap < 0 OR ap > 1 OR top1_recall > top3_recall OR jaccard NOT BETWEEN 0 AND 1")
    assert rows.count() > 0 and bad.count() == 0


def test_moderation_response(spark):
    df = spark.createDataFrame([("SAFE", [0.0, 2.0]), ("UNSAFE", [1.0, 3.0]), ("UNSAFE", [0.0, 0.0])], "r string, v array<double>")
    rows = [r[0] for r in df.select(V.moderation_response("r", "v", ["S1", "S2"])).collect()]
    assert tuple(rows[0]) == (None, None, "SAFE", "SAFE", 1.0)
    assert tuple(rows[1]) == ({"S1": 0.25, "S2": 0.75}, {"S1": 0.25, "S2": 0.75}, "S2", "UNSAFE", 0.75)
    assert tuple(rows[2]) == ({"S1": 0.0, "S2": 0.0}, {}, "", "UNSAFE", 0.0)
    sums = df.select(F.aggregate(V.normalise_vector("v"), F.lit(0.0), lambda a, x: a + x))
    assert [r[0] for r in sums.collect()] == [1.0, 1.0, 0.0]
