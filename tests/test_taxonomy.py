import re

from safelabel.catalog import CATEGORIES, EXAMPLE_TAXONOMY
from safelabel.functions.taxonomy import Taxonomy
from safelabel.functions import vectors as V
from safelabel.functions.patterns import any_of, classify, leading_word
from tests.helpers import column


def python_counts(rows, texts, categories=CATEGORIES):
    """The rule said in Python: every pattern counts on its own, whatever the case."""
    forms = {"stem": r"\b{}\w*", "word": r"\b{}\b", "phrase": "{}"}
    patterns = [(categories.index(c), re.compile(forms[k].replace("{}", re.escape(t) if k != "phrase" else t), re.I)) for c, k, t in rows]
    out = []
    for text in texts:
        counts = [0] * len(categories)
        for at, pattern in patterns:
            counts[at] += len(pattern.findall(text or ""))
        out.append(counts)
    return out


def test_counts_equal_python_on_the_documents(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    assert column(spark, texts, Taxonomy(EXAMPLE_TAXONOMY).counts) == python_counts(EXAMPLE_TAXONOMY, texts)


EDGE_TEXTS = [
    "Fog fog éfog fogé fogs", "", None, "FOG", "fog", "a fog", "fog.", "prefog fog_ fog2",
    "Green  lamp, green lamps; green, lamp", "half moon half-moon halfmoon HALF\tMOONED half half moon",
    "tick tick tick", "ſail SAIL sailing", "Tulip TULIP tulips", "İris ırıs IRIS", "dark-room dark room darkroom dark  room",
    "paints the fence paint fence painting fences", "row on to row of wash yourself washing yourself", "ox OX fox oxo",
    "naïve naïveté", "क् fog cfog", "x" * 5000 + " fog", "colour color colouur",
]
EDGE_ROWS = [
    ("S1", "word", "fog"), ("S1", "stem", "sail"), ("S1", "stem", "tulip"), ("S1", "phrase", r"\bgreen\s+lamp\w*"),
    ("S2", "stem", "fog"), ("S2", "phrase", r"\bdark[-\s]?room\w*"), ("S3", "stem", "half-moon"), ("S3", "phrase", r"\bhalf\s+moon\w*"),
    ("S4", "phrase", r"\btick\s+tick\b"), ("S5", "phrase", r"\bpaint\w*\s+fence\w*"), ("S6", "stem", "iris"), ("S7", "word", "ox"),
    ("S7", "word", "OX"), ("S8", "stem", "naïve"), ("S9", "phrase", r"\brow\s+on\b"), ("S9", "phrase", r"\bwash\w*\s+yourself"),
    ("S10", "phrase", r"\bcolou?r\b"), ("S11", "phrase", r"\bto\s+row\b|\byourself\b"), ("S12", "phrase", r"og\b"), ("S13", "stem", "f"),
    ("S14", "phrase", r"\bg\w*\s+lam\w*"), ("S15", "word", "TULIP"), ("S16", "phrase", r"\d"), ("S16", "phrase", r"\d"),
    ("S17", "phrase", r"\bfog+s?\b"), ("S17", "phrase", r"\bwa+sh\w*"), ("S17", "phrase", r"\Bog\W"), ("S17", "phrase", r"[\s,]lam\S+\D"),
    ("S17", "phrase", r"\bhalf[^\w]moon"), ("S17", "phrase", r"\bmooned|sail\B"),
]


def test_edge_texts_equal_python(spark):
    got = column(spark, EDGE_TEXTS, Taxonomy(EDGE_ROWS).counts)
    want = python_counts(EDGE_ROWS, EDGE_TEXTS)
    for text, a, b in zip(EDGE_TEXTS, got, want):
        assert a == b, text


def test_only_unguarded_patterns(spark):
    rows = [("S1", "phrase", r"og\b"), ("S2", "phrase", r"\w+ing\b")]
    assert column(spark, EDGE_TEXTS, Taxonomy(rows).counts) == python_counts(rows, EDGE_TEXTS)


def test_from_patterns_and_from_table_agree(spark):
    patterns = {"A": [r"\bfog\b", r"\bsail\w*"], "B": [r"\brow\s+on\b", r"\bhalf-moon\w*"]}
    a = Taxonomy.from_patterns(patterns)
    table = spark.createDataFrame(a.rows, "category string, kind string, term string")
    b = Taxonomy.from_table(table, ["A", "B"])
    assert column(spark, EDGE_TEXTS, a.counts) == column(spark, EDGE_TEXTS, b.counts) == python_counts(a.rows, EDGE_TEXTS, ["A", "B"])


def test_classify_and_leading_word():
    assert classify(r"\bfog\b") == ("word", "fog")
    assert classify(r"\bsail\w*") == ("stem", "sail")
    assert classify(r"\brow\s+on\b") == ("phrase", r"\brow\s+on\b")
    assert leading_word(r"\brow\s+on\b") == ("row", False)
    assert leading_word(r"\bpaint\w*\s+x") == ("paint", True)
    assert leading_word(r"\bcolou?r") == ("colo", True)
    assert leading_word(r"\ba\b|\bb\b") == (None, True)


def test_vectors_of_counts(spark):
    rows = [("S1", "stem", "sail"), ("S2", "stem", "sail"), ("S3", "word", "fog")]
    texts = ["sail", "sail fog fog", "calm", None]
    vectors = column(spark, texts, lambda x: V.shares(Taxonomy(rows).counts(x)))
    assert vectors[0][:3] == [0.5, 0.5, 0.0] and vectors[1][:3] == [0.25, 0.25, 0.5]
    assert vectors[2] == vectors[3] == [0.0] * 17
    assert column(spark, texts, lambda x: V.category_list(V.shares(Taxonomy(rows).counts(x)))) == ["S1 S2", "S1 S2 S3", "", ""]
    assert column(spark, texts, lambda x: V.harm_flag(V.shares(Taxonomy(rows).counts(x)))) == ["1", "1", "0", "0"]


def test_any_of_is_a_plain_substring_test(spark):
    terms = ["ab", "abc", "a.c", "x[1]", "é", "ದ ", "^$", "q-r", "b&&c", "#x"]
    texts = ["zabz", "a.c", "abd", "aXc", "x[1]", "x1", "café", "é", "ದx", "ದ x", "^$", "q-r", "qr", "b&&c", "# x", "#x", ""]
    assert column(spark, texts, lambda x: x.rlike(any_of(terms))) == [any(t in s for t in terms) for s in texts]
    assert column(spark, ["a", ""], lambda x: x.rlike(any_of([]))) == [False, False]
