"""Failing prompts and rejected lines: told apart, counted once."""

import pytest
from pyspark.sql import functions as F

from safelabel.operators.scoring import answers_or_errors, moderate_with_models, score_batches
from safelabel.streaming.jobs import score_to_sink, split_stream

SPEC = "id int, prompt string"


def factory():
    """Made here, so that it travels to the workers by value."""
    def make():
        def answer(prompts):
            if any("bad" in p for p in prompts):
                raise ValueError("cannot read this")
            return [p.upper() for p in prompts]

        return answer

    return make


def test_failing_prompts_are_found_by_halving():
    calls = []

    def model(prompts):
        calls.append(len(prompts))
        return factory()()(prompts)

    prompts = [f"p{i}" for i in range(64)]
    prompts[17] = prompts[50] = "bad"
    answers, errors = answers_or_errors(model, prompts)
    assert [i for i, e in enumerate(errors) if e] == [17, 50] and errors[17] == "ValueError: cannot read this"
    assert all(a == p.upper() for a, p in zip(answers, prompts) if p != "bad") and answers[17] is None
    assert len(calls) <= 1 + 2 * 2 * 6
    calls.clear()
    assert answers_or_errors(model, ["bad"], retries=3) == ([None], ["ValueError: cannot read this"]) and len(calls) == 4
    assert answers_or_errors(lambda p: ["one"], ["a", "b"]) == (["one", "one"], [None, None])
    assert answers_or_errors(lambda p: [], ["a"])[1] == ["ValueError: 0 answers to 1 prompts"]


def test_rows_without_answer_carry_their_error(spark):
    rows = spark.createDataFrame([(i, "bad" if i % 10 == 3 else f"p{i}") for i in range(50)], SPEC)
    make = factory()
    got = {r.id: (r.pred_raw, r.error) for r in score_batches(rows, make, error="error", latency="s").collect()}
    assert got == {i: (None, "ValueError: cannot read this") if i % 10 == 3 else (f"P{i}", None) for i in range(50)}
    with pytest.raises(Exception, match="cannot read this"):
        score_batches(rows, make).collect()


def test_rows_of_a_batch_are_not_python_objects_at_once(spark):
    """Python holds an Arrow batch (120 MB here) once, as it was read, and no strings of all its prompts besides."""
    def make():
        import tracemalloc

        tracemalloc.start()

        def answer(prompts):
            return [str(tracemalloc.get_traced_memory()[1]) for _ in prompts]

        return answer

    rows = spark.range(0, 6000, 1, 1).select(F.col("id").cast("int").alias("id"), F.lpad(F.col("id").cast("string"), 20_000, "long ").alias("prompt"))
    scored = score_batches(rows, lambda: make(), batch_size=8)
    peak = scored.agg(F.count("*"), F.max(F.length("prompt")), F.max(F.col("pred_raw").cast("long"))).first()
    assert tuple(peak)[:2] == (6000, 20_000) and peak[2] < 160_000_000
    both = moderate_with_models(rows, lambda: lambda p: ["UNSAFE"] * len(p), lambda: make(), batch_size=8)
    assert both.agg(F.max(F.col("category_raw").cast("long"))).first()[0] < 160_000_000


def test_scored_rows_keep_their_columns_and_values(spark):
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else f"p{i}", [i, None], {"k": i}, None) for i in range(1500)] * 2,
                                 "id int, prompt string, a array<int>, m map<string, int>, n timestamp").repartition(1)
    number = lambda: lambda prompts: [None if p is None else len(p) for p in prompts]
    got = score_batches(rows, number, batch_size=7, latency="s", error="error")
    assert got.columns == [*rows.columns, "pred_raw", "s", "error"] and got.filter("s < 0 or s is null or error is not null").count() == 0
    value = lambda r, answer: (r.id, r.prompt, answer, *r.a, r.m["k"], r.n)
    assert {value(r, r.pred_raw) for r in got.collect()} == {value(r, r.prompt and str(len(r.prompt))) for r in rows.collect()}
    assert got.count() == 3000 and score_batches(rows.limit(0), number).count() == 0
    with pytest.raises(Exception, match="length"):
        score_batches(rows, lambda: lambda p: ["one"]).collect()


def test_a_failing_prompt_does_not_stop_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": 1, "prompt": "ok"}\n{"id": 2, "prompt": "bad"}\nnot json\n')
    score_to_sink(spark, str(tmp_path / "in"), SPEC, str(tmp_path / "out"), str(tmp_path / "state"), factory(), error="error").awaitTermination()
    assert {(r.id, r.pred_raw, r.error) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(1, "OK", None), (2, None, "ValueError: cannot read this")}


def test_rejected_lines_are_written_once_also_after_a_crash(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text('{"id": 1, "prompt": "x"}\n\n{"id": \n[3]\n')
    fail = {"now": True}

    def transform(rows):
        if fail["now"] and rows.filter("id = 9").count():
            raise RuntimeError("crash in the middle of a batch")
        return rows.withColumn("n", F.length("prompt"))

    run = lambda: split_stream(spark, source, SPEC, out, state, transform).awaitTermination()
    run()
    (tmp_path / "in" / "b.jsonl").write_text('{"id": 9, "prompt": "xyz"}\n{"id": 10, "prompt": null}\noops\n')
    with pytest.raises(Exception, match="crash in the middle"):
        run()
    fail["now"] = False
    run()
    run()
    assert sorted((r.id, r.n) for r in spark.read.parquet(f"{out}/rows").collect() if r.n is not None) == [(1, 1), (9, 3)]
    assert sorted(r[0] for r in spark.read.parquet(f"{out}/rejects").select("_corrupt_record").collect()) == ["[3]", "oops", '{"id": ']
    counts = spark.read.parquet(f"{out}/counts").agg(F.sum("processed"), F.sum("valid"), F.sum("malformed")).first()
    assert tuple(counts) == (6, 3, 3)
