"""Scorers, streams, labelling jobs, and the shape of their plans."""

import pytest
from pyspark.sql import functions as F

from checks import inputs
from checks.scans import DOC_SCHEMA
from safelabel.catalog import BINARY_TEMPLATE, HARM_COLUMN, few_shot_template
from safelabel.functions.lexicon import Lexicon
from safelabel.functions.taxonomy import Taxonomy
from safelabel.operators import profanity as P
from safelabel.operators.labelling import keep_labelled, propagate_labels, with_category_vector
from safelabel.operators.pairs import fill_template, render_prompt, sft_pairs
from safelabel.operators.scoring import fit_binary_head, moderate_with_models, predict_binary_head, score_batches
from safelabel.plans.binary_corpus import binary_table, sampled_pairs
from safelabel.plans.weak_labels import balanced_training_table, label_dialogues, with_distribution_text
from safelabel.sources.sinks import write_jsonl
from safelabel.streaming.jobs import append_available, moderate_stream, moderated, score_to_sink, stream_jsonl
from tests.helpers import optimized, physical


# --- prompts ---------------------------------------------------------------------------
def test_templates(spark):
    df = spark.createDataFrame([("a {} b", "SAFE"), (None, "SAFE")], "text string, label string")
    assert [r[0] for r in df.select(fill_template("<{text}>{}", "text")).collect()] == ["<a {} b>{}", "<>{}"]
    assert render_prompt(df, BINARY_TEMPLATE).first().prompt == BINARY_TEMPLATE.replace("{text}", "a {} b")
    assert tuple(sft_pairs(df, "text", "label", "Q: {text}\nA:").first()) == ("Q: a {} b\nA:", "SAFE")
    assert few_shot_template([("x {}", "SAFE")]).count("{text}") == 1
    with pytest.raises(ValueError):
        fill_template("nothing", "text")


# --- profanity -------------------------------------------------------------------------
LEX = [("bn", "পচা"), ("bn", "পচা মাছ"), ("kn", "ಕೆಟ್ಟ "), ("en", "bad"), ("en", "bad"), ("en", "badly"), ("en", "Rude")]


def test_flags(spark):
    texts = [("bn", "এটা পচা।", 1), ("kn", "ಕೆಟ್ಟ", 0), ("kn", "ಕೆಟ್ಟ ಮಾತು", 1), ("en", "পচা", 0), ("en", "abadon", 1), ("en", "BAD", 0),
             ("en", "Rude", 1), ("fr", "bad", 0), (None, "bad", 0), ("en", None, 0)]
    df = spark.createDataFrame(texts, "language string, text string, want int")
    lexicon = Lexicon.from_table(spark.createDataFrame(LEX, "language string, term string"))
    assert P.flag_profanity(df, lexicon).filter("profanity <> want").count() == 0
    anywhere = [r[0] for r in df.select(lexicon.any_term("text")).collect()]
    assert anywhere == [True, False, True, True, True, False, True, True, True, False]


def test_minimised_lexicon_flags_the_same(spark, sf):
    table = spark.createDataFrame(LEX, "language string, term string")
    small = P.minimise_lexicon(table)
    assert sorted(r.term for r in small.collect()) == sorted(["পচা", "ಕೆಟ್ಟ ", "bad", "Rude"])
    docs = inputs.documents(spark, sf)
    a, b = (P.flag_profanity(docs, lx) for lx in (inputs.LEXICON, Lexicon.from_table(P.minimise_lexicon(inputs.lexicon_table(spark)))))
    assert a.select("doc_id", "profanity").exceptAll(b.select("doc_id", "profanity")).count() == 0


def test_profanity_rows_drop_incomplete_rows(spark):
    rows = [("en", "bad", "S1", "d"), ("en", None, "S1", "d"), ("fr", None, "S1", "d"), (None, "bad", "S1", "d"), ("en", "x", None, "d"), ("en", "x", "S1", None)]
    df = spark.createDataFrame(rows, "language string, text string, safety_categories string, safety_distribution string")
    out = P.profanity_rows(df, Lexicon(LEX)).collect()
    assert sorted((r.language, r.profanity) for r in out) == [("en", 1), ("fr", 0)]
    assert set(out[0].asDict()) == {"language", "text", "profanity"}


def test_term_hits(spark):
    df = spark.createDataFrame([(1, "en", "badly Rude"), (2, "fr", "bad"), (3, "en", "fine")], "id int, language string, text string")
    hits = P.term_hits(df, spark.createDataFrame(LEX, "language string, term string"))
    assert sorted((r.id, r.term) for r in hits.collect()) == [(1, "Rude"), (1, "bad"), (1, "badly")]


# --- labelling -------------------------------------------------------------------------
TAX = Taxonomy([("S1", "stem", "sail"), ("S2", "word", "fog")])
DIALOGUES = [
    (1, [["hi, \"you\"", "fog and sailing"]], [["bn"]], None, [["ml", "x"]], []),
    (2, [["sail"]], [["bn"]], [["kn"]], [["ml"]], [["or"]]),
    (3, None, [["bn"]], [["kn"]], [["ml"]], [["or"]]),
    (4, [["p", "peace"]], [["bn"]], [["kn"]], [["ml"]], [["or"]]),
]
NESTED = "array<array<string>>"
DIALOGUE_SCHEMA = f"id int, eng_Latn {NESTED}, ben_Beng {NESTED}, kan_Kadn {NESTED}, mal_Mlym {NESTED}, ory_Orya {NESTED}"


def test_label_dialogues(spark):
    out = label_dialogues(spark.createDataFrame(DIALOGUES, DIALOGUE_SCHEMA), TAX, source="src").collect()
    assert sorted((r.id, r.language, r.text) for r in out) == [(1, "bn", "bn"), (1, "ml", "ml")]
    assert {(r.harmful, r.safety_categories, r.source) for r in out} == {("1", "S1 S2", "src")}
    assert out[0].safety_distribution["S1"] == 0.5 and len(out[0].safety_distribution) == 17
    named = label_dialogues(spark.createDataFrame(DIALOGUES, DIALOGUE_SCHEMA), TAX, source="src", harm=HARM_COLUMN)
    flagged = binary_table(named, Lexicon(LEX)).withColumn("id", F.concat_ws("-", "id", "language"))
    quotas = spark.createDataFrame([("src", "bn", 1), ("src", "ml", 1)], "source string, language string, quota int")
    assert {(r.text, r.label) for r in sampled_pairs(flagged, quotas).collect()} == {("bn", "UNSAFE"), ("ml", "UNSAFE")}
    with pytest.raises(ValueError):
        propagate_labels(spark.createDataFrame([([0.0],)], "category_vector array<double>"), {"bn": "nope"})


def test_labelling_is_one_narrow_stage_that_reads_each_text_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    df = keep_labelled(with_category_vector(docs, inputs.TAXONOMY, out="v"), "v").select("doc_id", "v")
    assert "Exchange" not in physical(df) and "ReadSchema: struct<doc_id:bigint,text:string>" in physical(df)
    assert optimized(df).count("[\\p{L}\\p{N}_]+, 0)") == 1


def test_flags_are_one_narrow_stage(spark, sf):
    docs = inputs.documents(spark, sf)
    df = P.flag_profanity(docs, inputs.LEXICON).select("doc_id", "profanity")
    assert "Exchange" not in physical(df) and "Python" not in physical(df)


def test_end_to_end_tables(spark, sf):
    labelled = with_distribution_text(label_dialogues(inputs.dialogues(spark, sf), inputs.TAXONOMY, source="translated"))
    labelled = labelled.withColumn("id", F.concat_ws("-", F.col("conv_id").cast("string"), "language"))
    table = balanced_training_table(labelled, 12)
    sizes = {r["count"] for r in table.groupBy("category").count().collect()}
    assert sizes == {12} and "safety_distribution" in table.columns

    rows = binary_table(inputs.labelled(spark, sf).drop("v"), inputs.LEXICON)
    quotas = rows.groupBy("source", "language").agg(F.lit(1).alias("quota"))
    pairs = sampled_pairs(rows, quotas, id_col="doc_id", harm="harmful")
    n = quotas.count()
    assert pairs.count() == n and pairs.filter("split = 'train'").count() == int(n * 0.9)
    assert {r.label for r in pairs.collect()} == {"UNSAFE"}


# --- scorers ---------------------------------------------------------------------------
def batch_sizes():
    """A factory made in here travels to the workers by value."""
    return lambda: (lambda prompts: [f"{len(prompts)}" for _ in prompts])


def test_score_batches(spark):
    df = spark.range(20).selectExpr("id", "cast(id AS string) AS prompt").repartition(2)
    out = score_batches(df, batch_sizes(), batch_size=4, latency="sec").collect()
    assert len(out) == 20 and all(1 <= int(r.pred_raw) <= 4 and r.sec >= 0 for r in out)


def test_second_model_sees_unsafe_rows_only(spark):
    binary = lambda: (lambda ps: ["unsafe" if p == "bad" else "safe" for p in ps])
    category = lambda: (lambda ps: ["seen " + p for p in ps])
    df = spark.createDataFrame([("bad",), ("good",), ("bad",)], "prompt string")
    out = sorted(tuple(r) for r in moderate_with_models(df, binary, category, batch_size=2).collect())
    assert out == [("bad", "unsafe", "seen bad")] * 2 + [("good", "safe", None)]


@pytest.mark.parametrize("kind", ["linear_svc", "logistic"])
def test_binary_head_learns(spark, kind):
    rows = [("বাজে কথা খারাপ", "UNSAFE"), ("ভালো দিন সুন্দর", "SAFE")] * 10
    df = spark.createDataFrame(rows, "text string, label string")
    model = fit_binary_head(df, kind=kind, features=256, max_iter=5)
    assert predict_binary_head(model, df).filter("pred <> label").count() == 0
    with pytest.raises(ValueError):
        fit_binary_head(df, kind="other")


# --- streams ---------------------------------------------------------------------------
def test_stream_equals_batch_and_resumes(spark, sf, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    docs = inputs.documents(spark, sf)
    first, second = docs.filter("doc_id < 100"), docs.filter("doc_id >= 100")
    run = lambda: moderate_stream(spark, src, DOC_SCHEMA, out, state, inputs.LEXICON, inputs.TAXONOMY).awaitTermination()
    write_jsonl(first, src)
    run()
    assert spark.read.parquet(out).count() == first.count()
    write_jsonl(second, src, "append")
    run()
    run()  # nothing new: nothing is added
    columns = ["doc_id", "response.category", "response.safety", "response.score"]
    got = spark.read.parquet(out).select(*columns)
    want = moderated(docs, inputs.LEXICON, inputs.TAXONOMY).select(*columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_scores_survive_a_failing_batch(spark, tmp_path):
    src, out, state, flag = (str(tmp_path / n) for n in ("in", "out", "state", "flag"))
    rows = spark.range(30).selectExpr("id", "cast(id AS string) AS prompt")
    write_jsonl(rows.filter("id < 20").coalesce(1), src)
    schema = "id bigint, prompt string"
    score_to_sink(spark, src, schema, out, state, batch_sizes(), files_per_batch=1).awaitTermination()
    write_jsonl(rows.filter("id >= 20").coalesce(1), src, "append")

    def fails():
        raise MemoryError("the model does not fit")

    with pytest.raises(Exception):
        append_available(score_batches(stream_jsonl(spark, src, schema, 1), fails), out, state).awaitTermination()
    assert spark.read.parquet(out).count() == 20
    score_to_sink(spark, src, schema, out, state, batch_sizes(), files_per_batch=1).awaitTermination()
    assert spark.read.parquet(out).select("id").distinct().count() == spark.read.parquet(out).count() == 30
