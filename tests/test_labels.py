import pytest
from pyspark.sql import functions as F

from safelabel.functions import display as D
from safelabel.functions import labels as L
from safelabel.functions import text as T
from safelabel.functions.scripts import tag_language
from tests.helpers import column


def test_safe_label(spark):
    unsafe = ["1", "1.0", "1.9", " 1 ", "true", "1e0"]
    safe = ["2", "0", "nan", "inf", "", None, "-1", "x", "false", "0.99"]
    assert column(spark, unsafe + safe, L.safe_label) == ["UNSAFE"] * len(unsafe) + ["SAFE"] * len(safe)
    assert column(spark, [1, 0, None], L.safe_label, "int") == ["UNSAFE", "SAFE", "SAFE"]


RAW = ["UNSAFE", "unsafe", " SAFE\n", "0", "1", "HARMFUL", "OK", "maybe", "", None, "Not safe, unsafe."]


def test_predictions(spark):
    assert column(spark, RAW, L.normalise_pred) == [
        "UNSAFE", "UNSAFE", "SAFE", "UNSAFE", "SAFE", "UNSAFE", "SAFE", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNSAFE"]
    assert column(spark, RAW, lambda x: L.normalise_pred(x, "default_safe")) == [
        "UNSAFE", "UNSAFE", "SAFE", "SAFE", "SAFE", "SAFE", "SAFE", "SAFE", "SAFE", "SAFE", "UNSAFE"]
    assert column(spark, RAW, lambda x: L.normalise_pred(x, "safe_first")) == [
        "SAFE", "SAFE", "SAFE", "0", "1", "HARMFUL", "OK", "MAYBE", "", None, "SAFE"]
    with pytest.raises(ValueError):
        L.normalise_pred(F.lit("x"), "other")


def test_gold(spark):
    assert column(spark, [" safe\t", "Unsafe", "n/a", None, " SAFE"], L.normalise_gold) == ["SAFE", "UNSAFE", "UNKNOWN", "UNKNOWN", "SAFE"]


def test_texts(spark):
    assert column(spark, ['a,"b"', None], T.clean_text) == ["a 'b'", None]
    assert column(spark, ["a", None], T.coerce_text) == ["a", ""]
    assert column(spark, ["a", None], lambda x: T.coerce_text(x, "None")) == ["a", "None"]
    assert column(spark, [" a  b\nc ", "", None], lambda x: T.truncate_tokens(x, 2)) == ["a b", "", None]
    assert column(spark, [" a  b\nc ", "", None], T.token_count) == [3, 0, 0]
    assert column(spark, [" \t ", "", None, "x"], T.not_blank) == [False, False, False, True]


def test_nested(spark):
    values = [[["p", "r"]], [["p"]], [[]], [], None, [None]]
    kind = "array<array<string>>"
    assert column(spark, values, T.first_prompt, kind) == ["p", "p", None, None, None, None]
    assert column(spark, values, T.first_response, kind) == ["r", None, None, None, None, None]


def test_language_tags(spark):
    texts = ["আমি ভালো আছি", "ମୁଁ ଭଲ ଅଛି", "ನಾನು ಚೆನ್ನಾಗಿ", "ഞാൻ നല്ലത്", "the cat and the dog", "le chat et les chiens",
             "der Hund und das Haus", "el perro con los gatos", "", None, "123", "ok আমি the"]
    assert column(spark, texts, tag_language) == ["bn", "or", "kn", "ml", "en", "fr", "de", "es", "unknown", "unknown", "unknown", "bn"]


def test_bands(spark):
    assert column(spark, [0.29, 0.3, 0.7, 0.71], D.f1_band, "double") == ["low", "medium", "medium", "high"]
    assert column(spark, [0.49, 0.5], D.accuracy_band, "double") == ["low", "ok"]
    assert column(spark, [4.0, 4.1, 5.1], D.kl_band, "double") == ["ok", "high", "severe"]
    assert column(spark, [25.0, 25.1, 50.1], D.imbalance_band, "double") == ["denied", "likely", "confirmed"]
    assert column(spark, [-0.1, 0.5, 1.1], D.clamp, "double") == [0.0, 0.5, 1.0]
    assert column(spark, [0.12345], D.pct, "double") == [12.35]
    assert column(spark, ["S1", "S99", None], lambda c: D.display_name(c, {"S1": "One"})) == ["One", "S99", None]
