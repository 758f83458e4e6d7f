"""D: dataset reports, and the three jobs end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqltext as S
from checks.columns import TOKENS_LOWER, VOTES
from checks.metrics import MULTI
from checks.registry import query
from checks.samples import HASH
from safelabel.catalog import CATEGORIES
from safelabel.operators import reports as P
from safelabel.operators.profanity import flag_profanity
from safelabel.operators.sampling import balance, balance_summary
from safelabel.plans.binary_corpus import binary_table, sampled_pairs
from safelabel.plans.evaluation import evaluate_binary, evaluate_distributions, tagged
from safelabel.plans.weak_labels import balanced_training_table, label_dialogues, with_distribution_text
from safelabel.session import stage_table

_WON = f"won AS (SELECT language, {S.winner('v')} AS category FROM vectors)"


@query("d01_bucket_sizes", f"WITH {S.DOCS} SELECT source, language, count(*) AS n FROM docs GROUP BY ALL")
def _(spark, sf):
    return P.bucket_sizes(I.documents(spark, sf))


@query("d02_category_histogram", f"""WITH {S.LABELLED}, won AS (SELECT language, {S.winner('v')} AS category FROM labelled)
    SELECT *, round(n / sum(n) OVER (PARTITION BY language), 6) AS share FROM (SELECT language, category, count(*) AS n FROM won GROUP BY language, category)""")
def flagship(spark, sf):
    return P.category_histogram(I.labelled(spark, sf), "v", by="language").withColumns(I.six("share"))


@query("d03_full_histogram", f"""WITH {S.LABELLED}, won AS (SELECT {S.winner('v')} AS category FROM labelled), n AS (SELECT c AS category, count(won.category) AS n
    FROM unnest({S.CATEGORY_LIST}) AS u(c) LEFT JOIN won ON won.category = c GROUP BY c) SELECT *, round(n / sum(n) OVER (), 6) AS share FROM n""")
def _(spark, sf):
    return P.category_histogram(I.labelled(spark, sf), "v", full=True).withColumns(I.six("share"))


@query("d05_imbalance", f"""WITH {S.LABELLED}, won AS (SELECT {S.winner('v')} AS category FROM labelled), s AS (SELECT 100 * count(*) FILTER (WHERE category = 'S14')::DOUBLE / count(*) AS percent FROM won)
    SELECT 'S14' AS category, round(percent, 6) AS percent, CASE WHEN percent > 50 THEN 'confirmed' WHEN percent > 25 THEN 'likely' ELSE 'denied' END AS verdict FROM s""")
def _(spark, sf):
    return P.imbalance_verdict(P.category_histogram(I.labelled(spark, sf), "v"), "S14").withColumns(I.six("percent"))


@query("d06_balance_totals", f"""WITH {S.LABELLED}, pools AS (SELECT {S.winner('v')} AS category, count(*) AS n FROM labelled GROUP BY ALL)
    SELECT CAST(sum(n) AS BIGINT) AS before, CAST(count(*) * 40 AS BIGINT) AS after FROM pools""")
def _(spark, sf):
    rows = I.labelled(spark, sf).select("doc_id", F.col("v"))
    from safelabel.functions.vectors import winner

    won = rows.select("doc_id", winner("v").alias("category"))
    summary = balance_summary(won, balance(won, "category", 40, I.SEED, "doc_id"), "category", CATEGORIES)
    return summary.agg(F.sum("before").alias("before"), F.sum("after").alias("after"))


def _cross(rows: str, bad: str, good_name: str, bad_name: str) -> str:
    cols = f"""count(*) FILTER (WHERE NOT ({bad})) AS {good_name}, count(*) FILTER (WHERE {bad}) AS {bad_name}, count(*) AS total,
    round(100 * count(*) FILTER (WHERE NOT ({bad}))::DOUBLE / count(*), 2) AS {good_name}_pct, round(100 * count(*) FILTER (WHERE {bad})::DOUBLE / count(*), 2) AS {bad_name}_pct"""
    return f"SELECT language, {cols} FROM {rows} GROUP BY language UNION ALL SELECT '(all)', {cols} FROM {rows}"


@query("d22_label_by_language", f"WITH {S.BINARY}, flagged AS (SELECT language, harmful = '1' AS bad FROM binary_rows) {_cross('flagged', 'bad', 'safe', 'harmful')}")
def _(spark, sf):
    return P.label_by_language(I.binary_rows(spark, sf))


@query("d23_profanity_by_language", f"WITH {S.DOCS}, flagged AS (SELECT *, {S.profane()} AS profanity FROM docs) {_cross('flagged', 'profanity = 1', 'non_profane', 'profane')}")
def _(spark, sf):
    return P.profanity_by_language(flag_profanity(I.documents(spark, sf), I.LEXICON))


_ASSIGNED = f"{S.LABELLED}, u AS (SELECT unnest(string_split(safety_categories, ' ')) AS category FROM labelled), shares AS (SELECT category, count(*) AS n FROM u GROUP BY category)"


@query("d24_category_share", f"WITH {_ASSIGNED} SELECT category, n, round(n / sum(n) OVER (), 6) AS share FROM shares")
def _(spark, sf):
    return P.category_share(I.labelled(spark, sf)).withColumns(I.six("share"))


@query("d25_top_and_others", f"""WITH {_ASSIGNED}, r AS (SELECT *, row_number() OVER (ORDER BY n DESC, CAST(substr(category, 2) AS INT)) AS rn FROM shares),
    g AS (SELECT CASE WHEN rn <= 6 THEN category ELSE 'Others' END AS category, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY ALL) SELECT *, round(n / sum(n) OVER (), 6) AS share FROM g""")
def _(spark, sf):
    return P.top_n_other(P.category_share(I.labelled(spark, sf)).drop("share")).withColumns(I.six("share"))


@query("d26_correlation", f"""WITH {S.BINARY}, f AS (SELECT {S.profane()} AS profanity, CAST(harmful AS INT) AS harmful FROM binary_rows)
    SELECT 'profanity' AS a, 'profanity' AS b, round(corr(profanity, profanity), 6) AS corr FROM f UNION ALL SELECT 'profanity', 'harmful', round(corr(profanity, harmful), 6) FROM f
    UNION ALL SELECT 'harmful', 'profanity', round(corr(harmful, profanity), 6) FROM f UNION ALL SELECT 'harmful', 'harmful', round(corr(harmful, harmful), 6) FROM f""")
def _(spark, sf):
    rows = flag_profanity(I.binary_rows(spark, sf), I.LEXICON)
    return P.corr_matrix(rows, ["profanity", "harmful"]).withColumns(I.six("corr"))


@query("d27_text_lengths", "SELECT CAST(min(length(text)) AS INT) AS min_chars, CAST(max(length(text)) AS INT) AS max_chars FROM documents")
def _(spark, sf):
    return P.text_stats(I.documents(spark, sf))


@query("d28_language_distribution", f"WITH {S.DOCS} SELECT language, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM docs GROUP BY language")
def _(spark, sf):
    return P.language_distribution(I.documents(spark, sf)).withColumns(I.six("share"))


@query("d29_overview", f"WITH {S.LABELLED}, u AS (SELECT unnest(string_split(safety_categories, ' ')) AS category FROM labelled) "
       "SELECT count(*) AS rows, count(DISTINCT language) AS languages, (SELECT count(DISTINCT category) FROM u) AS categories FROM labelled")
def _(spark, sf):
    return P.overview(I.labelled(spark, sf), "v")


# --- end to end ------------------------------------------------------------------------
@query("l1_weak_labels", f"""WITH {S.DIALOGUE_VECTORS}, spread AS (
    SELECT conv_id, 'bn' AS language, bn AS text, v, c FROM vectors UNION ALL SELECT conv_id, 'kn', kn, v, c FROM vectors
    UNION ALL SELECT conv_id, 'ml', ml, v, c FROM vectors UNION ALL SELECT conv_id, 'or', "or", v, c FROM vectors),
    won AS (SELECT concat(conv_id, '-', language) AS id, {S.winner('v')} AS category FROM spread WHERE text IS NOT NULL AND list_sum(c) > 0),
    pools AS (SELECT category, count(*) AS n FROM won GROUP BY category),
    r AS (SELECT won.*, n, row_number() OVER (PARTITION BY category ORDER BY {S.row_hash(I.SEED, 'id')}, id) AS rn FROM won JOIN pools USING (category)),
    draws AS (SELECT category, 1 + CAST(concat('0x', substr(md5(concat_ws('|', '{I.SEED}', 'draw', category, j)), 1, 15)) AS BIGINT) % n AS rn FROM pools, range(1, 31) AS t(j) WHERE n < 30)
    SELECT id, category FROM r WHERE n >= 30 AND rn <= 30 UNION ALL SELECT id, r.category FROM r JOIN draws USING (category, rn)""")
def _(spark, sf):
    dialogues = I.dialogues(spark, sf).withColumnRenamed("conv_id", "id")
    labelled = with_distribution_text(label_dialogues(dialogues, I.TAXONOMY, source="translated"))
    return balanced_training_table(labelled, 30, I.SEED, id_col="row_id").select(F.col("row_id").alias("id"), "category")


@query("l2_binary_corpus", f"""WITH {S.LABELLED}, sizes AS (SELECT source, language, count(*) AS n FROM labelled GROUP BY ALL),
    ranked AS (SELECT l.*, n, row_number() OVER (PARTITION BY l.source, l.language ORDER BY {HASH}, doc_id) AS rn FROM labelled l JOIN sizes USING (source, language)),
    picked AS (SELECT * FROM ranked WHERE rn <= n // 2), total AS (SELECT count(*) AS n FROM picked),
    placed AS (SELECT doc_id, harmful, row_number() OVER (ORDER BY {HASH}, doc_id) AS rn FROM picked)
    SELECT doc_id, CASE WHEN harmful = '1' THEN 'UNSAFE' ELSE 'SAFE' END AS label,
    CASE WHEN rn <= greatest(1, least(floor(n * 0.9::DOUBLE), n - 1)) THEN 'train' ELSE 'test' END AS split FROM placed, total""")
def _(spark, sf):
    rows = stage_table(binary_table(I.labelled(spark, sf).drop("v"), I.LEXICON), "binary-rows")
    quotas = rows.groupBy("source", "language").agg(F.count(F.lit(1)).alias("n")).select("source", "language", F.expr("n div 2").alias("quota"))
    return sampled_pairs(rows, quotas, I.SEED, id_col="doc_id", harm="harmful", stage=False).select("doc_id", "label", "split")


@query("l3_evaluation", f"""WITH {S.JUDGED}, {S.stats('valid', S.BINARY_LIST, 'language')} {S.report('valid', S.BINARY_LIST, 'language')}""")
def _(spark, sf):
    report = evaluate_binary(I.predictions(spark, sf), by=["language"])["report"]
    return report.withColumns(I.six("precision", "recall", "f1"))


@query("l3_distributions", f"""WITH {S.SCORED}, votes AS (SELECT doc_id, list_max([{VOTES}]) AS best FROM (SELECT doc_id, {TOKENS_LOWER} AS w FROM docs)),
    named AS (SELECT s.*, CASE WHEN best.n > 0 THEN best.k ELSE 'unknown' END AS tag FROM scored s JOIN votes USING (doc_id)),
    m AS (SELECT tag AS language, FALSE AS is_overall, {MULTI} FROM named GROUP BY tag UNION ALL SELECT NULL, TRUE, {MULTI} FROM named) SELECT * FROM m""")
def _(spark, sf):
    table = evaluate_distributions(tagged(I.distributions(spark, sf)))["metrics"]
    return table.withColumns(I.six(*[f.name for f in table.schema.fields if f.dataType.typeName() == "double"]))


@query("l3_report_by_tag", f"""WITH {S.SCORED}, votes AS (SELECT doc_id, list_max([{VOTES}]) AS best FROM (SELECT doc_id, {TOKENS_LOWER} AS w FROM docs)),
    named AS (SELECT t.gold, t.pred, CASE WHEN best.n > 0 THEN best.k ELSE 'unknown' END AS language FROM top1 t JOIN votes USING (doc_id)),
    {S.stats('named', None, 'language')} {S.report('named', None, 'language')}""")
def _(spark, sf):
    report = evaluate_distributions(tagged(I.distributions(spark, sf)))["report_by_language"]
    return report.withColumns(I.six("precision", "recall", "f1"))
