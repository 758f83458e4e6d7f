"""B and C: scalar rules, labelling, prompts, lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import sqltext as S
from checks.registry import query
from safelabel.catalog import (
    BINARY_TEMPLATE, CATEGORIES, CATEGORY_NAMES, CATEGORY_TEMPLATE, EXAMPLE_STOP_WORDS, LANGUAGE_NAMES, few_shot_template,
)
from safelabel.functions import display as D
from safelabel.functions import labels as L
from safelabel.functions import text as T
from safelabel.functions import vectors as V
from safelabel.functions.scripts import tag_language
from safelabel.operators.confusion import misclassified
from safelabel.operators.language import fit_language_profiles, tag_by_profile
from safelabel.operators.labelling import keep_labelled, label_coverage, propagate_labels, with_category_counts, with_dialogue_vector
from safelabel.operators.pairs import pair_predictions, pairing_summary, render_prompt, sft_pairs
from safelabel.operators.profanity import (
    drop_safety_columns, flag_profanity, minimise_lexicon, profanity_rows, term_hits, with_lexicon_terms,
)
from safelabel.operators.scanning import keep_computed
from safelabel.operators.reports import join_dimension, label_dimensions
from safelabel.plans.evaluation import normalised


# --- profanity -----------------------------------------------------------------------
@query("b01_profanity_flag", f"WITH {S.DOCS} SELECT doc_id, language, {S.profane()} AS profanity FROM docs")
def _(spark, sf):
    return flag_profanity(I.documents(spark, sf), I.LEXICON).select("doc_id", "language", "profanity")


@query("b01_profanity_rows", f"""WITH {S.LABELLED} SELECT doc_id, language, source, harmful, {S.profane()} AS profanity FROM labelled""")
def _(spark, sf):
    rows = I.labelled(spark, sf).select("doc_id", "text", "language", "source", "harmful", "safety_categories", "safety_distribution")
    return profanity_rows(rows, I.LEXICON).drop("text")


@query("b02_any_profanity", f"WITH {S.DOCS} SELECT doc_id, {S.any_term('text')} AS profane FROM docs")
def _(spark, sf):
    return I.documents(spark, sf).select("doc_id", I.LEXICON.any_term("text").alias("profane"))


# Words of the texts serve as a lexicon that grows with them.
_WORD_LEXICON = f"""{S.DOCS}, lexicon AS (SELECT DISTINCT language, w AS term FROM
    (SELECT language, unnest(regexp_split_to_array(text, '[ \t-\r]+')) AS w FROM docs) WHERE length(w) > 0)"""


@query("b03_minimise_lexicon", f"""WITH {_WORD_LEXICON},
    posts AS (SELECT language, term, CASE WHEN length(term) < 3 THEN term ELSE substr(term, length(term) // 2, 3) END AS gram FROM lexicon),
    pieces AS (SELECT DISTINCT language, term AS whole, unnest(flatten([[substr(term, i, n) FOR i IN range(1, length(term) - n + 2)] FOR n IN [1, 2, 3]])) AS gram FROM lexicon),
    redundant AS (SELECT DISTINCT p.language, p.whole FROM pieces p JOIN posts o ON o.language = p.language AND o.gram = p.gram
        WHERE o.term <> p.whole AND contains(p.whole, o.term))
    SELECT language, term FROM lexicon l WHERE NOT EXISTS (SELECT 1 FROM redundant r WHERE r.language = l.language AND r.whole = l.term)""")
def _(spark, sf):
    words = I.documents(spark, sf).select("language", F.explode(F.split("text", "[ \t-\r]+")).alias("term"))
    return minimise_lexicon(words.filter(F.length("term") > 0))


@query("b04_drop_columns", f"WITH {S.LABELLED} SELECT doc_id, language, harmful FROM labelled")
def _(spark, sf):
    rows = I.labelled(spark, sf).select("doc_id", "language", "harmful", "safety_categories", "safety_distribution")
    return drop_safety_columns(rows)


# --- labelling -----------------------------------------------------------------------
@query("b05_category_counts", f"WITH {S.VECTORS} SELECT doc_id, array_to_string(c, ',') AS counts FROM counted")
def _(spark, sf):
    rows = with_category_counts(I.documents(spark, sf), I.TAXONOMY)
    return rows.select("doc_id", I.ints(F.col("category_counts")).alias("counts"))


@query("b06_category_vector", f"WITH {S.VECTORS} SELECT doc_id, {S.micro('v')} AS vector FROM vectors")
def _(spark, sf):
    return I.vectors(spark, sf).select("doc_id", I.micro("v").alias("vector"))


@query("b07_nested_extract", f"""WITH {S.DIALOGUES} SELECT conv_id, md5(p) AS prompt, md5(r) AS response, md5(bn) AS bn, md5(kn) AS kn, md5(ml) AS ml FROM dialogues""")
def _(spark, sf):
    return I.dialogues(spark, sf).select(
        "conv_id", F.md5(T.first_prompt("eng_Latn")).alias("prompt"), F.md5(T.first_response("eng_Latn")).alias("response"),
        *[F.md5(T.first_prompt(c)).alias(a) for a, c in (("bn", "ben_Beng"), ("kn", "kan_Kadn"), ("ml", "mal_Mlym"))])


@query("b08_keep_labelled", f"WITH {S.VECTORS} SELECT doc_id FROM counted WHERE list_sum(c) > 0")
def _(spark, sf):
    return keep_labelled(I.vectors(spark, sf), "v").select("doc_id")


@query("b08_label_coverage", f"WITH {S.VECTORS} SELECT count(*) AS total_rows, count(*) FILTER (WHERE list_sum(c) = 0) AS unlabelled_rows FROM counted")
def _(spark, sf):
    return label_coverage(I.vectors(spark, sf), "v")


@query("b09_harm_flag", f"WITH {S.VECTORS} SELECT doc_id, CASE WHEN list_sum(c) > 0 THEN '1' ELSE '0' END AS harmful FROM counted")
def _(spark, sf):
    return I.vectors(spark, sf).select("doc_id", V.harm_flag("v").alias("harmful"))


@query("b10_category_list", f"WITH {S.VECTORS} SELECT doc_id, {S.names_of('v')} AS safety_categories FROM vectors")
def _(spark, sf):
    return I.vectors(spark, sf).select("doc_id", V.category_list("v").alias("safety_categories"))


_MAP_SQL = S.each("v", "concat('S', i, '=', CAST(round(v[i] * 1000000) AS BIGINT))")


@query("b11_vector_map", f"WITH {S.VECTORS} SELECT doc_id, array_to_string({_MAP_SQL}, ',') AS distribution FROM vectors")
def _(spark, sf):
    return I.vectors(spark, sf).select("doc_id", I.map_text(V.vector_to_map("v")).alias("distribution"))


@query("b12_clean_text", f"""WITH {S.DOCS} SELECT doc_id, md5(replace(replace(text, ',', ' '), '"', '''')) AS text_md5 FROM docs""")
def _(spark, sf):
    return I.documents(spark, sf).select("doc_id", F.md5(T.clean_text("text")).alias("text_md5"))


@query("b13_propagate_labels", f"""WITH {S.DIALOGUE_VECTORS}, spread AS (
    SELECT conv_id, 'bn' AS language, bn AS text, v, c FROM vectors UNION ALL SELECT conv_id, 'kn', kn, v, c FROM vectors
    UNION ALL SELECT conv_id, 'ml', ml, v, c FROM vectors UNION ALL SELECT conv_id, 'or', "or", v, c FROM vectors)
    SELECT conv_id, language, md5(replace(replace(text, ',', ' '), '"', '''')) AS text_md5, '1' AS harmful, {S.names_of('v')} AS safety_categories,
    array_to_string({_MAP_SQL}, ',') AS distribution FROM spread WHERE text IS NOT NULL AND list_sum(c) > 0""")
def _(spark, sf):
    rows = keep_labelled(with_dialogue_vector(I.dialogues(spark, sf), I.TAXONOMY, "eng_Latn"))
    columns = {"bn": "ben_Beng", "kn": "kan_Kadn", "ml": "mal_Mlym", "or": "ory_Orya"}
    return propagate_labels(rows, columns, source="translated").select(
        "conv_id", "language", F.md5("text").alias("text_md5"), "harmful", "safety_categories", I.map_text("safety_distribution").alias("distribution"))


@query("b14_format_distribution", f"WITH {S.LABELLED} SELECT doc_id, safety_distribution FROM labelled")
def _(spark, sf):
    return I.labelled(spark, sf).select("doc_id", "safety_distribution")


# --- distributions ---------------------------------------------------------------------
@query("b15_parse_distribution", f"WITH {S.DISTRIBUTIONS} SELECT doc_id, {S.micro(S.parse('truth'))} AS truth, {S.micro(S.parse('pred_raw'))} AS pred FROM distributions")
def _(spark, sf):
    return I.distributions(spark, sf).select(
        "doc_id", I.micro(V.parse_distribution("truth")).alias("truth"), I.micro(V.parse_distribution("pred_raw")).alias("pred"))


def _kv_text(before: str, after: str = "") -> str:
    """Every number of ``truth`` in the form of ``I.map_text``; what no number can be read from is left out."""
    number = lambda i: rf"TRY_CAST(nullif(regexp_extract(truth, concat('{before}S', {i}, '{after}: ([+-]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][+-]?[0-9]+)?)'), 1), '') AS DOUBLE)"
    entries = S.each("", f"CASE WHEN {number('i')} IS NOT NULL THEN concat('S', i, '=', CAST(round({number('i')} * 1000000) AS BIGINT)) END")
    return f"array_to_string(list_filter({entries}, lambda e: e IS NOT NULL), ',')"


@query("b16_all_values", rf"""WITH {S.DISTRIBUTIONS} SELECT doc_id, {_kv_text('(?:^|[{ ])')} AS entries FROM distributions WHERE truth IS NOT NULL""")
def _(spark, sf):
    m = V.parse_kv(F.translate("truth", "{}", ""))
    return I.distributions(spark, sf).filter("truth IS NOT NULL").select("doc_id", I.map_text(m).alias("entries"))


@query("b16_parse_kv", rf"""WITH {S.DISTRIBUTIONS} SELECT doc_id, len(string_split(truth, ',')) AS entries,
    CAST(round(TRY_CAST(regexp_extract(truth, '(^|[{{ ])S3: ([0-9.]*)', 2) AS DOUBLE) * 1000000) AS BIGINT) AS s3 FROM distributions
    WHERE truth IS NOT NULL""")
def _(spark, sf):
    m = V.parse_kv(F.translate("truth", "{}", ""))
    return I.distributions(spark, sf).filter("truth IS NOT NULL").select(
        "doc_id", F.size(m).cast("bigint").alias("entries"), F.round(F.try_element_at(m, F.lit("S3")) * 1_000_000).cast("bigint").alias("s3"))


@query("b17_normalise_map", f"""WITH {S.SCORED} SELECT doc_id, array_to_string({S.each('t', "concat('S', i, '=', CAST(round(CASE WHEN list_sum(t) = 0 THEN 0 ELSE t[i] / list_sum(t) END * 1000000) AS BIGINT))")}, ',') AS distribution
    FROM parsed WHERE t IS NOT NULL""")
def _(spark, sf):
    docs = I.distributions(spark, sf).select("doc_id", V.parse_distribution("truth").alias("t"))
    return docs.filter(F.col("t").isNotNull()).select("doc_id", I.map_text(V.normalise_map(V.vector_to_map("t"))).alias("distribution"))


@query("b18_majority", f"""WITH {S.SCORED} SELECT doc_id, CASE WHEN list_max(t) > 0 THEN {S.winner('t')} ELSE '' END AS category,
    round(list_max(t), 6) AS score FROM parsed WHERE t IS NOT NULL""")
def _(spark, sf):
    docs = I.distributions(spark, sf).select("doc_id", V.parse_distribution("truth").alias("t")).filter("t IS NOT NULL")
    return docs.select("doc_id", V.majority("t").alias("m")).select("doc_id", "m.category", F.round("m.score", 6).alias("score"))


@query("b19_non_zero", f"WITH {S.VECTORS} SELECT doc_id, {S.names_of('v', ',')} AS categories FROM vectors")
def _(spark, sf):
    found = F.array_sort(F.transform(F.map_keys(V.non_zero(V.vector_to_map("v"))), lambda k: F.substring(k, 2, 9).cast("int")))
    return I.vectors(spark, sf).select("doc_id", F.array_join(F.transform(found, lambda n: F.concat(F.lit("S"), n.cast("string"))), ",").alias("categories"))


@query("b20_winner", f"WITH {S.VECTORS} SELECT doc_id, {S.winner('v')} AS category FROM vectors")
def _(spark, sf):
    return I.vectors(spark, sf).select("doc_id", V.winner("v").alias("category"))


@query("b21_display_winner", f"WITH {S.SCORED} SELECT doc_id, {S.winner('p')} AS category FROM parsed WHERE p IS NOT NULL")
def _(spark, sf):
    docs = I.distributions(spark, sf).withColumn("p", V.parse_distribution(F.when(T.not_empty("truth"), F.col("pred_raw"))))
    return docs.filter("p IS NOT NULL").select("doc_id", V.winner(V.map_to_vector(V.vector_to_map("p"))).alias("category"))


@query("b22_response_shape", f"""WITH {S.VECTORS} SELECT doc_id, CASE WHEN safe THEN 'SAFE' WHEN list_sum(c) = 0 THEN '' ELSE {S.winner('v')} END AS category,
    CASE WHEN safe THEN 'SAFE' ELSE 'UNSAFE' END AS safety, CASE WHEN safe THEN 1.0::DOUBLE ELSE round(list_max(v), 6) END AS score,
    CASE WHEN NOT safe THEN array_to_string({_MAP_SQL}, ',') END AS distribution,
    CASE WHEN NOT safe THEN len(list_filter(v, lambda x: x > 0)) END AS non_zero
    FROM (SELECT *, NOT {S.any_term('text')} AS safe FROM vectors)""")
def _(spark, sf):
    result = F.when(I.LEXICON.any_term("text"), "UNSAFE").otherwise("SAFE")
    rows = I.vectors(spark, sf).select("doc_id", V.moderation_response(result, "v").alias("m"))
    return rows.select("doc_id", "m.category", "m.safety", F.round("m.score", 6).alias("score"), I.map_text("m.distribution").alias("distribution"),
                       F.size(F.map_keys("m.nonZero")).cast("bigint").alias("non_zero"))


@query("b43_json_distribution", f"""WITH {S.DISTRIBUTIONS} SELECT doc_id, CASE WHEN {S.digit('kind truth')} = '2' THEN 17 ELSE 0 END AS entries FROM distributions""")
def _(spark, sf):
    m = V.parse_distribution_json("truth")
    return I.distributions(spark, sf).select("doc_id", F.size(m).alias("entries"))


@query("b43_json_values", f"""WITH {S.DISTRIBUTIONS} SELECT doc_id, CASE WHEN {S.digit('kind truth')} = '2' THEN {_kv_text('"', '"')} ELSE '' END AS entries FROM distributions""")
def _(spark, sf):
    m = V.parse_distribution_json("truth")
    return I.distributions(spark, sf).select("doc_id", F.coalesce(I.map_text(m), F.lit("")).alias("entries"))


# --- labels ----------------------------------------------------------------------------
_LABEL_SQL = f"""CASE {S.digit('label')} WHEN '0' THEN ' 1 ' WHEN '1' THEN '1.9' WHEN '2' THEN 'nan' WHEN '3' THEN '' WHEN '4' THEN NULL
    WHEN '5' THEN '2' WHEN '6' THEN 'yes' WHEN '7' THEN '-1' WHEN '8' THEN '1e0' ELSE harmful END"""


@query("b23_label_coercion", f"""WITH {S.BINARY} SELECT doc_id, CASE WHEN x >= 1 AND x < 2 THEN 'UNSAFE' ELSE 'SAFE' END AS label
    FROM (SELECT doc_id, TRY_CAST({_LABEL_SQL} AS DOUBLE) AS x FROM binary_rows)""")
def _(spark, sf):
    d, odd = I.digit("label"), {"0": " 1 ", "1": "1.9", "2": "nan", "3": "", "4": None, "5": "2", "6": "yes", "7": "-1", "8": "1e0"}
    value = F.col("harmful")
    for digit, text in odd.items():
        value = F.when(d == digit, F.lit(text)).otherwise(value)
    return I.binary_rows(spark, sf).select("doc_id", L.safe_label(value).alias("label"))


@query("b24_text_coercion", f"""WITH {S.DOCS} SELECT doc_id, coalesce(x, '') AS plain, coalesce(x, 'None') AS marked
    FROM (SELECT doc_id, CASE WHEN {S.digit('text')} < '4' THEN NULL ELSE source END AS x FROM docs)""")
def _(spark, sf):
    docs = I.documents(spark, sf).select("doc_id", F.when(I.digit("text") >= "4", F.col("source")).alias("x"))
    return docs.select("doc_id", T.coerce_text("x").alias("plain"), T.coerce_text("x", "None").alias("marked"))


@query("b25_gold_labels", f"WITH {S.JUDGED} SELECT doc_id, gold FROM judged")
def _(spark, sf):
    return I.predictions(spark, sf).select("doc_id", L.normalise_gold("gold").alias("gold"))


@query("b26_pred_full", f"WITH {S.JUDGED} SELECT doc_id, pred FROM judged")
def _(spark, sf):
    return I.predictions(spark, sf).select("doc_id", L.normalise_pred("pred_raw").alias("pred"))


@query("b27_pred_default_safe", f"""WITH {S.PREDICTIONS} SELECT doc_id, CASE WHEN upper(coalesce(pred_raw, '')) LIKE '%UNSAFE%' THEN 'UNSAFE' ELSE 'SAFE' END AS pred FROM predictions""")
def _(spark, sf):
    return I.predictions(spark, sf).select("doc_id", L.normalise_pred("pred_raw", "default_safe").alias("pred"))


@query("b28_pred_safe_first", f"""WITH {S.PREDICTIONS} SELECT doc_id, CASE WHEN {S.SHOUT('pred_raw')} LIKE '%SAFE%' THEN 'SAFE' ELSE {S.SHOUT('pred_raw')} END AS pred FROM predictions""")
def _(spark, sf):
    return I.predictions(spark, sf).select("doc_id", L.normalise_pred("pred_raw", "safe_first").alias("pred"))


# --- prompts ---------------------------------------------------------------------------
_SHOTS = few_shot_template([("Good morning to all.", "SAFE"), ("I will hurt {} and {you}.", "UNSAFE")])


def _filled(template: str) -> str:
    head, _, tail = template.partition("{text}")
    return f"concat({S.quoted(head)}, text, {S.quoted(tail)})"


@query("b29_prompts", f"""WITH {S.DOCS} SELECT doc_id, md5({_filled(BINARY_TEMPLATE)}) AS binary_prompt, md5({_filled(CATEGORY_TEMPLATE)}) AS category_prompt,
    md5({_filled(_SHOTS)}) AS few_shot_prompt FROM docs""")
def _(spark, sf):
    rows = render_prompt(I.documents(spark, sf), BINARY_TEMPLATE, out="b")
    rows = render_prompt(render_prompt(rows, CATEGORY_TEMPLATE, out="c"), _SHOTS, out="f")
    return rows.select("doc_id", F.md5("b").alias("binary_prompt"), F.md5("c").alias("category_prompt"), F.md5("f").alias("few_shot_prompt"))


@query("b30_sft_pairs", f"""WITH {S.LABELLED} SELECT doc_id, md5({_filled(CATEGORY_TEMPLATE)}) AS prompt_md5, safety_distribution AS completion FROM labelled""")
def _(spark, sf):
    pairs = sft_pairs(I.labelled(spark, sf), "text", "safety_distribution", CATEGORY_TEMPLATE, "doc_id")
    return pairs.select("doc_id", F.md5("prompt").alias("prompt_md5"), "completion")


_TOKENS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')"


@query("b31_length_cap", f"""WITH {S.DOCS} SELECT doc_id, len({_TOKENS}) AS tokens, md5(array_to_string(list_slice({_TOKENS}, 1, 512), ' ')) AS capped FROM docs""")
def _(spark, sf):
    return I.documents(spark, sf).select("doc_id", T.token_count("text").cast("bigint").alias("tokens"), F.md5(T.truncate_tokens("text", 512)).alias("capped"))


# --- row metrics -----------------------------------------------------------------------
def _pairs(spark, sf):
    rows = I.distributions(spark, sf).filter(F.col("truth") != "")
    both = F.struct(V.parse_distribution("truth").alias("t"), V.parse_distribution("pred_raw").alias("p"))
    rows = keep_computed(rows.select("doc_id", both.alias("b")), "b", F.col("b.t").isNotNull() & F.col("b.p").isNotNull())
    return rows.select("doc_id", "b.t", "b.p")


_BOTH = "FROM scored WHERE t IS NOT NULL AND p IS NOT NULL"


@query("b32_smooth", f"WITH {S.SCORED} SELECT doc_id, {S.micro('sp')} AS smoothed {_BOTH}")
def _(spark, sf):
    return _pairs(spark, sf).select("doc_id", I.micro(V.smooth("p")).alias("smoothed"))


@query("b33_kl", f"WITH {S.SCORED} SELECT doc_id, round(kl, 6) AS kl {_BOTH}")
def _(spark, sf):
    return _pairs(spark, sf).select("doc_id", F.round(V.kl_divergence("t", "p"), 6).alias("kl"))


@query("b34_positives", f"WITH {S.SCORED} SELECT doc_id, array_to_string(pos, ',') AS positions {_BOTH}")
def _(spark, sf):
    return _pairs(spark, sf).select("doc_id", I.ints(V.positives("t")).alias("positions"))


@query("b35_top_k", f"WITH {S.SCORED} SELECT doc_id, array_to_string({S.top_k('p', 1)}, ',') AS top1, array_to_string({S.top_k('p', 3)}, ',') AS top3 {_BOTH}")
def _(spark, sf):
    return _pairs(spark, sf).select("doc_id", I.ints(V.top_k("p", 1)).alias("top1"), I.ints(V.top_k("p", 3)).alias("top3"))


@query("b36_topk_recall", f"WITH {S.SCORED} SELECT doc_id, round(r1, 6) AS top1_recall, round(r3, 6) AS top3_recall {_BOTH}")
def _(spark, sf):
    return _pairs(spark, sf).select("doc_id", F.round(V.topk_recall("t", "p", 1), 6).alias("top1_recall"), F.round(V.topk_recall("t", "p", 3), 6).alias("top3_recall"))


@query("b37_average_precision", f"WITH {S.SCORED} SELECT doc_id, round(ap, 6) AS ap {_BOTH}")
def _(spark, sf):
    return _pairs(spark, sf).select("doc_id", F.round(V.average_precision("t", "p"), 6).alias("ap"))


TOKENS_LOWER = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')"
VOTES = ", ".join(f"{{n: len(list_filter(w, lambda x: x IN ({', '.join(map(S.quoted, words))}))), o: {-i}, k: '{code}'}}"
                   for i, (code, words) in enumerate(sorted(EXAMPLE_STOP_WORDS.items())))


@query("b38_language_tag", f"""WITH {S.DOCS}, words AS (SELECT doc_id, language, {TOKENS_LOWER} AS w FROM docs),
    votes AS (SELECT doc_id, language, list_max([{VOTES}]) AS best FROM words)
    SELECT doc_id, language, CASE WHEN best.n > 0 THEN best.k ELSE 'unknown' END AS tag FROM votes""")
def _(spark, sf):
    return I.documents(spark, sf).select("doc_id", "language", tag_language("text").alias("tag"))


_HELD_OUT = ["0", "1"]
_LANGUAGES = ["en", "fr", "de", "es"]
_PROFILE_SQL = ", ".join(
    f"cast(round(1000 * (ln(({c}_n + 1) / ({c}_d + 2)::DOUBLE) - ln((n - {c}_n + 1) / (d - {c}_d + 2)::DOUBLE))) AS BIGINT) AS {c}" for c in _LANGUAGES)
_RANKED_SQL = "list_sort([" + ", ".join(f"{{'w': sum({c}), 'k': {-k}, 'name': '{c}'}}" for k, c in enumerate(_LANGUAGES)) + "], 'DESC')"


@query("b38_language_profiles", f"""WITH {S.DOCS}, parts AS (SELECT doc_id, language, {S.digit('language')} IN ('0', '1') AS held_out, string_split(lower(text), '') AS c FROM docs),
    held AS (SELECT DISTINCT doc_id, language, held_out, unnest([c[i] || c[i + 1] || c[i + 2] FOR i IN range(1, len(c) - 1)]) AS gram FROM parts),
    totals AS (SELECT count(*) AS d, {', '.join(f"count(*) FILTER (WHERE language = '{c}') AS {c}_d" for c in _LANGUAGES)} FROM parts WHERE NOT held_out),
    counts AS (SELECT gram, count(*) AS n, {', '.join(f"count(*) FILTER (WHERE language = '{c}') AS {c}_n" for c in _LANGUAGES)} FROM held WHERE NOT held_out GROUP BY gram HAVING count(*) >= 5),
    profile AS (SELECT gram, {_PROFILE_SQL} FROM counts, totals),
    told AS (SELECT doc_id, count(*) AS known, {_RANKED_SQL} AS best FROM held JOIN profile USING (gram) WHERE held_out GROUP BY doc_id)
    SELECT p.doc_id, language, CASE WHEN known IS NULL OR best[1].w - best[2].w < 50 * known THEN 'unknown' ELSE best[1].name END AS tag,
    cast(coalesce(best[1].w - best[2].w, 0) AS BIGINT) AS lead, coalesce(known, 0) AS known FROM parts p LEFT JOIN told t ON t.doc_id = p.doc_id WHERE held_out""")
def _(spark, sf):
    """Held-out documents, tagged by profiles of the others."""
    docs = I.documents(spark, sf).select("doc_id", "language", "text")
    held_out = I.digit("language").isin(_HELD_OUT)
    tagged = tag_by_profile(docs.filter(held_out), fit_language_profiles(docs.filter(~held_out), _LANGUAGES), "doc_id")
    return docs.filter(held_out).select("doc_id", "language").join(tagged, "doc_id")


# Words of the scripts that the tables do not hold, planted by a digit of the row.
_PLANTED = {"0": "নৌকা ঘাটে", "1": "ଡଙ୍ଗା ନଦୀ", "2": "ದೋಣಿ ನದಿ", "3": "വള്ളം പുഴ"}
_PLANTED_TAGS = {"0": "bn", "1": "or", "2": "kn", "3": "ml"}


@query("b38_planted_scripts", f"""WITH {S.DOCS}, planted AS (SELECT doc_id, {S.digit('script')} AS d, {TOKENS_LOWER} AS w FROM docs),
    votes AS (SELECT doc_id, d, list_max([{VOTES}]) AS best FROM planted)
    SELECT doc_id, CASE d {' '.join(f"WHEN '{d}' THEN '{t}'" for d, t in _PLANTED_TAGS.items())} ELSE CASE WHEN best.n > 0 THEN best.k ELSE 'unknown' END END AS tag FROM votes""")
def _(spark, sf):
    d = I.digit("script")
    added = F.coalesce(*[F.when(d == k, F.lit(words)) for k, words in _PLANTED.items()], F.lit(""))
    return I.documents(spark, sf).select("doc_id", tag_language(F.concat_ws(" ", "text", added)).alias("tag"))


@query("b39_misclassified", f"WITH {S.JUDGED} SELECT doc_id, gold, pred, gold = pred AS correct FROM judged WHERE gold <> pred")
def _(spark, sf):
    return misclassified(normalised(I.predictions(spark, sf))).select("doc_id", "gold", "pred", "correct")


_CATEGORY_CASE = " ".join(f"WHEN '{c}' THEN {S.quoted(n)}" for c, n in CATEGORY_NAMES.items())


@query("b40_display_names", f"""WITH {S.VECTORS} SELECT doc_id, category, CASE category {_CATEGORY_CASE} END AS category_name,
    language, language AS language_name FROM (SELECT doc_id, language, {S.winner('v')} AS category FROM vectors)""")
def _(spark, sf):
    return label_dimensions(I.vectors(spark, sf).select("doc_id", "language", V.winner("v").alias("category")))


@query("b41_bands", f"""WITH {S.SCORED} SELECT doc_id, CASE WHEN kl > 5 THEN 'severe' WHEN kl > 4 THEN 'high' ELSE 'ok' END AS kl_band,
    CASE WHEN jac < 0.3 THEN 'low' WHEN jac > 0.7 THEN 'high' ELSE 'medium' END AS f1_band, CASE WHEN r3 < 0.5 THEN 'low' ELSE 'ok' END AS accuracy_band,
    CASE WHEN 100 * r3 > 50 THEN 'confirmed' WHEN 100 * r3 > 25 THEN 'likely' ELSE 'denied' END AS imbalance_band {_BOTH}""")
def _(spark, sf):
    recall = V.topk_recall("t", "p", 3)
    return _pairs(spark, sf).select(
        "doc_id", D.kl_band(V.kl_divergence("t", "p")).alias("kl_band"), D.f1_band(V.jaccard("t", "p")).alias("f1_band"),
        D.accuracy_band(recall).alias("accuracy_band"), D.imbalance_band(100 * recall).alias("imbalance_band"))


@query("b42_percent_clamp", f"WITH {S.SCORED} SELECT doc_id, round(r3 * 100, 1) AS recall_pct, round(least(greatest(kl / 4, 0), 1), 6) AS kl_clamped {_BOTH}")
def _(spark, sf):
    return _pairs(spark, sf).select("doc_id", D.pct(V.topk_recall("t", "p", 3), 1).alias("recall_pct"),
                                    F.round(D.clamp(V.kl_divergence("t", "p") / 4), 6).alias("kl_clamped"))


# --- joins -----------------------------------------------------------------------------
@query("c01_lexicon_lookup", f"""WITH {S.DOCS}, {S.LEXICON}, lists AS (SELECT language, array_to_string(list_sort(list(DISTINCT term)), '|') AS terms FROM lexicon GROUP BY language)
    SELECT doc_id, language, terms FROM docs LEFT JOIN lists USING (language)""")
def _(spark, sf):
    docs = I.documents(spark, sf).select("doc_id", "language")
    return with_lexicon_terms(docs, I.lexicon_table(spark)).withColumn("terms", F.array_join("terms", "|"))


@query("c02_display_join", f"""WITH {S.VECTORS}, names AS (SELECT * FROM (VALUES {', '.join(f"('{c}', {S.quoted(n)})" for c, n in CATEGORY_NAMES.items() if c != 'S9')}) AS n(code, name))
    SELECT doc_id, w.category, coalesce(name, w.category) AS name FROM (SELECT doc_id, {S.winner('v')} AS category FROM vectors) w LEFT JOIN names ON code = w.category""")
def _(spark, sf):
    names = spark.createDataFrame([(c, n) for c, n in CATEGORY_NAMES.items() if c != "S9"], "code string, name string")
    return join_dimension(I.vectors(spark, sf).select("doc_id", V.winner("v").alias("category")), names, "category")


@query("c03_pair_predictions", f"WITH {S.PREDICTIONS} SELECT doc_id, raw_gold AS gold, pred_raw FROM predictions")
def _(spark, sf):
    rows = I.predictions(spark, sf)
    return pair_predictions(rows.select("doc_id", "gold"), rows.select("doc_id", "pred_raw"), "doc_id")


_SIDES = f"""g AS (SELECT doc_id FROM docs WHERE {S.digit('gold side')} < 'd' UNION ALL SELECT doc_id FROM docs WHERE {S.digit('gold side')} = '1'),
    p AS (SELECT doc_id FROM docs WHERE {S.digit('pred side')} < 'c' UNION ALL SELECT doc_id FROM docs WHERE {S.digit('pred side')} < '2')"""


def _sides(spark, sf):
    """Gold and predictions that lack some ids and repeat others."""
    docs, g, p = I.documents(spark, sf).select("doc_id"), I.digit("gold side"), I.digit("pred side")
    return (docs.filter(g < "d").unionByName(docs.filter(g == "1")), docs.filter(p < "c").unionByName(docs.filter(p < "2")))


@query("c03_pairs_with_unmatched", f"WITH {S.DOCS}, {_SIDES} SELECT g.doc_id, p.doc_id IS NOT NULL AS answered FROM g LEFT JOIN p USING (doc_id)")
def _(spark, sf):
    gold, predictions = _sides(spark, sf)
    return pair_predictions(gold, predictions.withColumn("answered", F.lit(True)), "doc_id", keep_unmatched=True).select(
        "doc_id", F.coalesce("answered", F.lit(False)).alias("answered"))


@query("c03_pairing_summary", f"""WITH {S.DOCS}, {_SIDES}, gs AS (SELECT doc_id, count(*) AS n FROM g GROUP BY ALL), ps AS (SELECT doc_id, count(*) AS n FROM p GROUP BY ALL)
    SELECT count(*) FILTER (WHERE gs.n > 0 AND ps.n > 0) AS matched, count(*) FILTER (WHERE ps.n IS NULL) AS gold_only, count(*) FILTER (WHERE gs.n IS NULL) AS pred_only,
    count(*) FILTER (WHERE gs.n > 1) AS repeated_gold, count(*) FILTER (WHERE ps.n > 1) AS repeated_pred FROM gs FULL JOIN ps USING (doc_id)""")
def _(spark, sf):
    return pairing_summary(*_sides(spark, sf), "doc_id")


@query("c05_term_hits", f"WITH {S.DOCS}, {S.LEXICON} SELECT DISTINCT doc_id, d.language, term FROM docs d JOIN lexicon l ON d.language = l.language AND contains(text, term)")
def _(spark, sf):
    return term_hits(I.documents(spark, sf), I.lexicon_table(spark)).select("doc_id", "language", "term")


# The corpus' own commonest words as a lexicon, short ones included.
_COMMON_WORDS = 20_000
_COMMON = f"""{S.DOCS}, lexicon AS (SELECT language, term FROM (SELECT language, w AS term, count(*) AS n FROM
    (SELECT language, unnest(regexp_split_to_array(text, '[ \t-\r]+')) AS w FROM docs) WHERE length(w) > 0 GROUP BY ALL)
    QUALIFY row_number() OVER (ORDER BY n DESC, language, term) <= {_COMMON_WORDS})"""


def _common_lexicon(spark, sf):
    words = I.documents(spark, sf).select("language", F.explode(F.split("text", "[ \t-\r]+")).alias("term"))
    counted = words.filter(F.length("term") > 0).groupBy("language", "term").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "language", "term").limit(_COMMON_WORDS).select("language", "term")


@query("c05_common_words", f"""WITH {_COMMON}, words AS (SELECT doc_id, language, text FROM docs),
    found AS (SELECT DISTINCT doc_id, d.language, term, strpos(text, term) - 1 AS place FROM docs d JOIN lexicon l ON l.language = d.language AND contains(text, term))
    SELECT doc_id, language, count(*) AS n_terms, cast(sum(place) AS BIGINT) AS places, md5(string_agg(term, ' ' ORDER BY term)) AS terms FROM found GROUP BY ALL""")
def _(spark, sf):
    hits = term_hits(I.documents(spark, sf), _common_lexicon(spark, sf), gather="hits")
    places = F.aggregate("hits.place", F.lit(0).cast("long"), lambda total, at: total + at)
    rows = hits.select("doc_id", "language", F.size("hits").alias("n"), places.alias("places"), "hits.term")
    sums = rows.groupBy("doc_id", "language").agg(
        F.sum("n").alias("n_terms"), F.sum("places").alias("places"), F.array_sort(F.flatten(F.collect_list("term"))).alias("terms"))
    return sums.withColumn("terms", F.md5(F.array_join("terms", " ")))
