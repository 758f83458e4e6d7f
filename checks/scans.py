"""A: scans, row checks, sinks, and the stream jobs that go through files."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqltext as S
from checks.registry import query
from safelabel.catalog import BINARY_TEMPLATE, CATEGORIES
from safelabel.functions.vectors import parse_distribution
from safelabel.operators.pairs import render_prompt
from safelabel.operators.sampling import ratio_split
from safelabel.operators.scanning import (
    first_n, preview, reject_summary, require_keys, require_text, scan_summary, with_rejects,
)
from safelabel.session import scratch_path
from safelabel.sources.jsonl import parse_json_lines, read_jsonl
from safelabel.sources.sinks import write_jsonl, write_predictions, write_split
from safelabel.sources.tables import read_parquet_with_id, read_table
from safelabel.streaming.jobs import moderate_stream, score_to_sink, split_stream

DOC_SCHEMA = "doc_id bigint, text string, language string, source string"
DOC_FIELDS = ["doc_id", "text", "language", "source"]


def _line():
    return F.to_json(F.struct(*DOC_FIELDS))


def _lines_with_errors(docs):
    """A third kind of each: whole lines, cut-off lines, lines that hold no object."""
    d = I.digit("line")
    return docs.select(F.when(d == "0", F.concat(F.lit('{"doc_id": '), "doc_id", F.lit(', "text": "')))
                       .when(d == "1", F.concat(F.lit("["), "doc_id", F.lit("]"))).otherwise(_line()).alias("value"))


@query("a01_tolerant_scan", f"WITH {S.DOCS} SELECT doc_id, md5(text) AS text_md5, language, source FROM docs "
       f"WHERE {S.digit('line')} NOT IN ('0', '1')")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    _lines_with_errors(I.documents(spark, sf)).write.text(path)
    return read_jsonl(spark, path, DOC_SCHEMA).select("doc_id", F.md5("text").alias("text_md5"), "language", "source")


@query("a02_strict_scan", f"WITH {S.DOCS} SELECT doc_id, md5(text) AS text_md5, language, source FROM docs")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    I.documents(spark, sf).select(_line().alias("value")).write.text(path)
    return read_jsonl(spark, path, DOC_SCHEMA, "fail").select("doc_id", F.md5("text").alias("text_md5"), "language", "source")


@query("a03_blank_lines", f"WITH {S.DOCS} SELECT language, count(*) AS n FROM docs GROUP BY language")
def _(spark, sf):
    lines = I.documents(spark, sf).select(F.explode(F.array(F.lit(""), _line(), F.lit(" \t"))).alias("value"))
    return parse_json_lines(lines, DOC_SCHEMA, "fail").groupBy("language").agg(F.count(F.lit(1)).alias("n"))


@query("a04_require_keys", f"""WITH {S.DOCS}, keyed AS (SELECT doc_id, language, CASE {S.digit('key')} WHEN '0' THEN NULL
    WHEN '1' THEN '' ELSE source END AS source FROM docs)
    SELECT doc_id, source, CASE WHEN source IS NULL OR language IS NULL THEN 'rejected' ELSE 'kept' END AS status FROM keyed""")
def _(spark, sf):
    d = I.digit("key")
    docs = I.documents(spark, sf).withColumn("source", F.when(d == "0", F.lit(None)).when(d == "1", "").otherwise(F.col("source")))
    kept, rejected = require_keys(docs, ["source", "language"])
    return (kept.select("doc_id", "source", F.lit("kept").alias("status"))
            .unionByName(rejected.select("doc_id", "source", F.lit("rejected").alias("status"))))


@query("a05_reject_counter", f"""WITH {S.DOCS} SELECT language, count(*) AS processed,
    count(*) FILTER (WHERE {S.digit('line')} NOT IN ('0', '1')) AS valid,
    count(*) FILTER (WHERE {S.digit('line')} IN ('0', '1')) AS malformed
    FROM docs GROUP BY language""")
def _(spark, sf):
    docs = I.documents(spark, sf).withColumn("bad", I.digit("line").isin("0", "1"))
    return reject_summary(with_rejects(docs, F.col("bad")), ["language"])


@query("a05_rejected_lines", f"""WITH {S.DOCS} SELECT count(*) AS processed,
    count(*) FILTER (WHERE {S.digit('line')} NOT IN ('0', '1')) AS valid,
    count(*) FILTER (WHERE {S.digit('line')} IN ('0', '1')) AS malformed FROM docs""")
def _(spark, sf):
    lines = parse_json_lines(_lines_with_errors(I.documents(spark, sf)), DOC_SCHEMA, "keep")
    return reject_summary(with_rejects(lines, F.col("_corrupt_record").isNotNull()))


@query("a06_first_n", f"WITH {S.DOCS} SELECT doc_id, language FROM docs ORDER BY doc_id LIMIT 500")
def _(spark, sf):
    return first_n(I.documents(spark, sf).select("doc_id", "language"), 500, order_col="doc_id")


@query("a07_table_source", "SELECT doc_id, quality, toxic FROM labels")
def _(spark, sf):
    return read_table(spark, f"{sf}/labels.parquet")


@query("a07_row_ids", "SELECT count(*) AS n, count(*) AS ids FROM documents")
def _(spark, sf):
    rows = read_parquet_with_id(spark, f"{sf}/documents.parquet", "row_id")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("ids"))


@query("a08_jsonl_sink", f"WITH {S.BINARY} SELECT doc_id, md5(text) AS text_md5, language, "
       f"CASE WHEN harmful = '1' THEN harmful END AS harmful FROM binary_rows")
def _(spark, sf):
    path = scratch_path(spark, "jsonl")
    rows = I.binary_rows(spark, sf).withColumn("harmful", F.when(F.col("harmful") == "1", "1"))
    write_jsonl(rows, path)
    return read_jsonl(spark, path, DOC_SCHEMA + ", harmful string", "fail").select(
        "doc_id", F.md5("text").alias("text_md5"), "language", "harmful")


@query("a09_csv_sink", f"WITH {S.PREDICTIONS} SELECT doc_id, md5(text) AS text_md5, raw_gold AS gold, pred_raw FROM predictions")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    write_predictions(I.predictions(spark, sf).select("doc_id", "text", "gold", "pred_raw"), path)
    rows = read_table(spark, path, "csv", "doc_id bigint, text string, gold string, pred_raw string")
    return rows.select("doc_id", F.md5("text").alias("text_md5"), "gold", "pred_raw")


@query("a10_split_sink", f"""WITH {S.DOCS}, n AS (SELECT count(*) AS n FROM docs),
    r AS (SELECT doc_id, row_number() OVER (ORDER BY {S.row_hash(I.SEED, 'doc_id')}, doc_id) AS rn FROM docs)
    SELECT doc_id, CASE WHEN rn <= greatest(1, least(floor(n * 0.9::DOUBLE), n - 1)) THEN 'train' ELSE 'test' END AS split FROM r, n""")
def _(spark, sf):
    path = scratch_path(spark, "split")
    write_split(ratio_split(I.documents(spark, sf), 0.9, I.SEED, "doc_id"), path)
    parts = [read_jsonl(spark, f"{path}/split={s}", DOC_SCHEMA).select("doc_id", F.lit(s).alias("split")) for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


def length_model():
    """Stand-in for a model: answers by the length of the prompt.

    The factory is made here, so that it travels to the workers by value.
    """
    return lambda: (lambda prompts: ["UNSAFE" if len(p) % 3 == 0 else "SAFE" for p in prompts])


_PROMPT_CHARS = len(BINARY_TEMPLATE.replace("{text}", ""))


@query("a11_restartable_scores", f"""WITH {S.DOCS} SELECT doc_id, CASE WHEN (length(text) + {_PROMPT_CHARS}) % 3 = 0
    THEN 'UNSAFE' ELSE 'SAFE' END AS pred_raw FROM docs""")
def _(spark, sf):
    path, out, state = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    docs = render_prompt(I.documents(spark, sf), BINARY_TEMPLATE)
    write_jsonl(docs.select("doc_id", "prompt"), path)
    score_to_sink(spark, path, "doc_id bigint, prompt string", out, state, length_model()).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "pred_raw")


@query("b44_text_guard", f"WITH {S.DISTRIBUTIONS} SELECT doc_id FROM distributions WHERE trim(text) <> '' AND truth <> ''")
def _(spark, sf):
    return require_text(I.distributions(spark, sf), "text", "truth").select("doc_id")


@query("d04_scan_summary", f"""WITH {S.DISTRIBUTIONS} SELECT language, count(*) AS processed, count({S.parse('truth')}) AS valid,
    count(*) - count({S.parse('truth')}) AS malformed FROM distributions GROUP BY language""")
def _(spark, sf):
    return scan_summary(I.distributions(spark, sf), "truth", ["language"])


@query("e11_preview", f"WITH {S.DOCS} SELECT doc_id, language, source FROM docs ORDER BY doc_id LIMIT 4")
def _(spark, sf):
    return preview(I.documents(spark, sf).select("doc_id", "language", "source"), order_col="doc_id")


@query("g01_streaming_moderation", f"""WITH {S.VECTORS} SELECT doc_id,
    CASE WHEN {S.any_term('text')} THEN CASE WHEN list_sum(c) = 0 THEN '' ELSE {S.winner('v')} END ELSE 'SAFE' END AS category,
    CASE WHEN {S.any_term('text')} THEN 'UNSAFE' ELSE 'SAFE' END AS safety,
    CASE WHEN {S.any_term('text')} THEN round(list_max(v), 6) ELSE 1.0::DOUBLE END AS score FROM vectors""")
def _(spark, sf):
    path, out, state = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    write_jsonl(I.documents(spark, sf), path)
    moderate_stream(spark, path, DOC_SCHEMA, out, state, I.LEXICON, I.TAXONOMY).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "response.category", "response.safety", F.round("response.score", 6).alias("score"))


@query("g01_rejected_lines", f"""WITH {S.DOCS}, lines AS (SELECT doc_id, text, {S.digit('line')} IN ('0', '1') AS bad FROM docs)
    SELECT 'processed' AS kind, count(*) AS n, 0::BIGINT AS letters FROM lines UNION ALL SELECT 'valid', count(*), 0 FROM lines WHERE NOT bad
    UNION ALL SELECT 'malformed', count(*), 0 FROM lines WHERE bad UNION ALL SELECT 'rows', count(*), cast(sum(length(text)) AS BIGINT) FROM lines WHERE NOT bad
    UNION ALL SELECT 'rejects', count(*), cast(sum(length(CASE {S.digit('line')} WHEN '0' THEN '{{"doc_id": ' || doc_id || ', "text": "' ELSE '[' || doc_id || ']' END)) AS BIGINT) FROM lines WHERE bad""")
def _(spark, sf):
    path, out, state = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    _lines_with_errors(I.documents(spark, sf)).write.text(path)
    split_stream(spark, path, DOC_SCHEMA, out, state, lambda rows: rows.withColumn("letters", F.length("text"))).awaitTermination()
    counts = spark.read.parquet(f"{out}/counts").select(F.stack(
        F.lit(3), *[x for name in ("processed", "valid", "malformed") for x in (F.lit(name), F.col(name))]).alias("kind", "n"))
    size = lambda name, letters: spark.read.parquet(f"{out}/{name}").select(F.lit(name).alias("kind"), letters.cast("long").alias("letters"))
    both = size("rows", F.col("letters")).union(size("rejects", F.length("_corrupt_record")))
    summed = both.groupBy("kind").agg(F.count("*").alias("n"), F.sum("letters").alias("letters"))
    return counts.groupBy("kind").agg(F.sum("n").alias("n"), F.lit(0).cast("long").alias("letters")).unionByName(summed)
