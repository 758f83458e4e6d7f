"""E, F and C4/C6: sampling, balancing, splitting, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqltext as S
from checks.registry import query
from safelabel.functions import vectors as V
from safelabel.operators.confusion import active_classes, classification_report
from safelabel.operators.ranking import score_rows, winners
from safelabel.operators.reports import category_histogram, category_share
from safelabel.operators.sampling import (
    balance, balance_summary, clean_test, quota_coverage, quota_sample, ratio_split, row_hash, sample_n, shuffle, union_picks,
)
from safelabel.catalog import CATEGORIES
from safelabel.session import stage_table

KEYS = ["source", "language"]
HASH = S.row_hash(I.SEED, "doc_id")
RANKED = f"ranked AS (SELECT *, row_number() OVER (PARTITION BY source, language ORDER BY {HASH}, doc_id) AS rn FROM docs)"
SIZES = "sizes AS (SELECT source, language, count(*) AS n FROM docs GROUP BY ALL)"


def _quotas(docs):
    """Half of each bucket, rounded up; nothing from small buckets."""
    n = F.count(F.lit(1))
    return docs.groupBy(*KEYS).agg(F.when(n < 2, 0).otherwise(F.ceil(n / 2)).alias("quota"))


@query("e01_quota_sample", f"""WITH {S.DOCS}, {SIZES}, {RANKED} SELECT doc_id, source, language FROM ranked JOIN sizes USING (source, language)
    WHERE n >= 2 AND rn <= ceil(n / 2)""")
def _(spark, sf):
    docs = I.documents(spark, sf)
    return quota_sample(docs, _quotas(docs), KEYS, I.SEED, "doc_id").select("doc_id", *KEYS)


def _two_picks(docs):
    n = F.count(F.lit(1)).cast("bigint")
    picks = F.array(F.struct(F.lit("a").alias("pick"), F.expr("n div 3").alias("quota")), F.struct(F.lit("b").alias("pick"), F.expr("n div 2").alias("quota")))
    return docs.groupBy("language").agg(n.alias("n")).select("language", F.inline(picks))


@query("e02_disjoint_picks", f"""WITH {S.DOCS}, n AS (SELECT language, count(*) AS n FROM docs GROUP BY language),
    r AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY {HASH}, doc_id) AS rn FROM docs)
    SELECT doc_id, language, CASE WHEN rn <= n // 3 THEN 'a' ELSE 'b' END AS pick FROM r JOIN n USING (language) WHERE rn <= n // 3 + n // 2""")
def _(spark, sf):
    docs = I.documents(spark, sf)
    return quota_sample(docs, _two_picks(docs), ["language"], I.SEED, "doc_id", pick="pick").select("doc_id", "language", "pick")


def _with_winner(spark, sf):
    return stage_table(I.labelled(spark, sf).select("doc_id", V.winner("v").alias("category")), "winners")


N = 40
_WINNERS = f"""{S.LABELLED}, won AS MATERIALIZED (SELECT doc_id, {S.winner('v')} AS category FROM labelled),
    pools AS (SELECT category, count(*) AS n FROM won GROUP BY category),
    r AS (SELECT won.*, n, row_number() OVER (PARTITION BY category ORDER BY {HASH}, doc_id) AS rn FROM won JOIN pools USING (category))"""
_DRAWS = f"""draws AS (SELECT category, 1 + CAST(concat('0x', substr(md5(concat_ws('|', '{I.SEED}', 'draw', category, j)), 1, 15)) AS BIGINT) % n AS rn
    FROM pools, range(1, {N + 1}) AS t(j) WHERE n < {N})"""


@query("e03_undersample", f"WITH {_WINNERS} SELECT doc_id, category FROM r WHERE n >= {N} AND rn <= {N}")
def _(spark, sf):
    rows = _with_winner(spark, sf)
    large = rows.groupBy("category").count().filter(F.col("count") >= N).select("category", F.lit(N).alias("quota"))
    return quota_sample(rows, large, ["category"], I.SEED, "doc_id").select("doc_id", "category")


@query("e04_balance", f"""WITH {_WINNERS}, {_DRAWS} SELECT doc_id, category FROM r WHERE n >= {N} AND rn <= {N}
    UNION ALL SELECT doc_id, r.category FROM r JOIN draws USING (category, rn)""")
def _(spark, sf):
    return balance(_with_winner(spark, sf), "category", N, I.SEED, "doc_id").select("doc_id", "category")


@query("e05_balance_cases", f"""WITH {_WINNERS} SELECT concat('S', i) AS category, CAST(i - 1 AS INT) AS ord, coalesce(n, 0) AS before, CAST(CASE WHEN n IS NULL THEN 0 ELSE {N} END AS BIGINT) AS after,
    CASE WHEN n IS NULL THEN 'skipped' WHEN n > {N} THEN 'undersampled' WHEN n < {N} THEN 'oversampled' ELSE 'kept' END AS action
    FROM range(1, 18) AS t(i) LEFT JOIN pools ON category = concat('S', i)""")
def _(spark, sf):
    rows = _with_winner(spark, sf)
    return balance_summary(rows, balance(rows, "category", N, I.SEED, "doc_id"), "category", CATEGORIES)


@query("e06_shuffle", f"WITH {S.DOCS} SELECT doc_id, {HASH} AS place FROM docs")
def _(spark, sf):
    rows = I.documents(spark, sf).select("doc_id", row_hash(I.SEED, "doc_id").alias("place"))
    return shuffle(rows, I.SEED, "doc_id")


@query("e07_sample_n", f"WITH {S.DOCS} SELECT doc_id, language FROM docs ORDER BY {HASH}, doc_id LIMIT 300")
def _(spark, sf):
    return sample_n(I.documents(spark, sf).select("doc_id", "language"), 300, I.SEED, "doc_id")


@query("e08_ratio_split", f"""WITH {S.DOCS}, n AS (SELECT count(*) AS n FROM docs), r AS (SELECT doc_id, row_number() OVER (ORDER BY {HASH}, doc_id) AS rn FROM docs)
    SELECT doc_id, CASE WHEN rn <= greatest(1, least(floor(n * 0.9::DOUBLE), n - 1)) THEN 'train' ELSE 'test' END AS split FROM r, n""")
def _(spark, sf):
    return ratio_split(I.documents(spark, sf).select("doc_id"), 0.9, I.SEED, "doc_id")


@query("e09_active_classes", f"WITH {S.SCORED}, {S.stats('top1', S.CATEGORY_LIST)} SELECT label, support FROM classes WHERE support > 0")
def _(spark, sf):
    report = classification_report(winners(score_rows(I.distributions(spark, sf))), CATEGORIES, CATEGORIES)
    return active_classes(report.filter(F.col("label").isin(CATEGORIES))).select("label", "support")


@query("e10_histogram_order", f"""WITH {_WINNERS} SELECT category, n, row_number() OVER (ORDER BY n DESC, CAST(substr(category, 2) AS INT)) AS place FROM pools""")
def _(spark, sf):
    from pyspark.sql import Window

    histogram = category_histogram(I.labelled(spark, sf), "v").select("category", "n")
    order = Window.orderBy(F.desc("n"), F.substring("category", 2, 9).cast("int"))
    return histogram.withColumn("place", F.row_number().over(order).cast("bigint"))


@query("e12_share_of_total", f"WITH {S.LABELLED}, u AS (SELECT unnest(string_split(safety_categories, ' ')) AS category FROM labelled) "
       f"SELECT category, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM u GROUP BY category")
def _(spark, sf):
    return category_share(I.labelled(spark, sf)).withColumns(I.six("share"))


@query("c04_quota_join", f"""WITH {S.DOCS}, {SIZES} SELECT source, language, n, CASE WHEN n < 2 THEN 0 ELSE CAST(ceil(n / 2) AS BIGINT) END AS quota FROM sizes""")
def _(spark, sf):
    docs = I.documents(spark, sf)
    return quota_coverage(docs, _quotas(docs), KEYS)


_PARTS = f"parts AS (SELECT doc_id, text, {S.digit('part')} < '3' AS is_test FROM docs)"


@query("c06_clean_test", f"WITH {S.DOCS}, {_PARTS} SELECT doc_id FROM parts WHERE is_test AND text NOT IN (SELECT text FROM parts WHERE NOT is_test)")
def _(spark, sf):
    docs = I.documents(spark, sf).withColumn("is_test", I.digit("part") < "3")
    return clean_test(docs.filter("is_test"), docs.filter("NOT is_test")).select("doc_id")


@query("f01_union_of_picks", f"""WITH {S.DOCS}, {SIZES}, {RANKED} SELECT doc_id, source, language FROM ranked JOIN sizes USING (source, language)
    WHERE rn <= CASE WHEN language = 'en' THEN n // 4 ELSE n // 3 END""")
def _(spark, sf):
    docs = I.documents(spark, sf)
    picks = []
    for is_english, part in ((True, 4), (False, 3)):
        quotas = docs.filter((F.col("language") == "en") == F.lit(is_english)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
        quotas = quotas.select(*KEYS, F.expr(f"n div {part}").alias("quota"))
        picks.append(quota_sample(docs, quotas, KEYS, I.SEED, "doc_id").select("doc_id", *KEYS))
    return union_picks(*picks)


@query("f02_union_of_categories", f"""WITH {_WINNERS}, {_DRAWS}, b AS (SELECT category FROM r WHERE n >= {N} AND rn <= {N}
    UNION ALL SELECT r.category FROM r JOIN draws USING (category, rn)) SELECT category, count(*) AS n FROM b GROUP BY category""")
def _(spark, sf):
    rows = balance(_with_winner(spark, sf), "category", N, I.SEED, "doc_id")
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("f03_label_overlap", f"WITH {S.SCORED} SELECT doc_id, array_to_string(list_sort(list_intersect({S.top_k('p', 3)}, pos)), ',') AS hits FROM scored WHERE t IS NOT NULL AND p IS NOT NULL")
def _(spark, sf):
    rows = score_rows(I.distributions(spark, sf)).filter("parsed")
    hits = F.array_sort(F.array_intersect(V.top_k("pred_vector", 3), V.positives("truth_vector")))
    return rows.select("doc_id", I.ints(hits).alias("hits"))


@query("f04_present_labels", f"WITH {S.SCORED} SELECT language, gold AS label FROM top1 UNION SELECT language, pred FROM top1")
def _(spark, sf):
    top = winners(score_rows(I.distributions(spark, sf)))
    return top.select("language", F.explode(F.array_union(F.array("gold"), F.array("pred"))).alias("label")).distinct()


@query("f05_except_benchmark", "SELECT item_id FROM benchmark WHERE text NOT IN (SELECT text FROM documents)")
def _(spark, sf):
    return clean_test(I.table(spark, sf, "benchmark"), I.table(spark, sf, "documents").select("text")).select("item_id")
