"""SQL for the inputs of ``inputs.py``, written for DuckDB.

Keyword counts run one pattern at a time here.  The engine's patterns know ASCII
letters only, so letters beyond ASCII are first mapped to capitals, which do not
occur in lower-cased text.
"""

from __future__ import annotations

from safelabel.catalog import BINARY_LABELS, CATEGORIES, EXAMPLE_LEXICON, EXAMPLE_TAXONOMY, WIDTH

_MAPPED = str.maketrans("éó", "EO")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def text_list(items) -> str:
    return "[" + ", ".join(quoted(i) for i in items) + "]"


def digit(salt: str, at: int = 1, id_col: str = "doc_id") -> str:
    return f"substr(md5('{salt}|' || {id_col}), {at}, 1)"


def row_hash(seed: int, *cols: str) -> str:
    return f"md5(concat_ws('|', '{seed}', {', '.join(cols)}))"


def _count(category: str) -> str:
    parts = []
    for c, kind, term in EXAMPLE_TAXONOMY:
        if c == category:
            body = {"stem": rf"\b{term}\w*", "word": rf"\b{term}\b", "phrase": term}[kind].translate(_MAPPED)
            parts.append(f"len(regexp_extract_all(t, {quoted(body)}))")
    return " + ".join(parts)


def each(vec: str, body: str) -> str:
    """A list over category positions ``i``, counted from 1."""
    return f"list_transform(range(1, {WIDTH + 1}), lambda i: {body})"


def micro(vec: str) -> str:
    return f"array_to_string(list_transform({vec}, lambda x: CAST(round(x * 1000000) AS BIGINT)), ',')"


def names_of(vec: str, sep: str = " ") -> str:
    named = each(vec, f"CASE WHEN {vec}[i] > 0 THEN concat('S', i) END")
    return f"array_to_string(list_filter({named}, lambda s: s IS NOT NULL), '{sep}')"


def winner(vec: str) -> str:
    return f"concat('S', list_position({vec}, list_max({vec})))"


def format_distribution(vec: str) -> str:
    items = each(vec, f"concat('S', i, ': ', CASE WHEN {vec}[i] = 0 THEN '0' ELSE printf('%.10f', {vec}[i]) END)")
    return f"concat('{{', array_to_string({items}, ', '), '}}')"


def parse(text: str) -> str:
    keyed = rf"regexp_extract_all({text}, 'S\d+:\s*([\d.]+)', 1)"
    bare = rf"regexp_extract_all({text}, '([\d.]+)', 1)"
    tokens = f"CASE WHEN len({keyed}) = {WIDTH} THEN {keyed} WHEN len({bare}) = {WIDTH} THEN {bare} END"
    values = f"list_transform({tokens}, lambda x: TRY_CAST(x AS DOUBLE))"
    return f"CASE WHEN len(list_filter({values}, lambda x: x IS NULL)) = 0 THEN {values} END"


def positives(vec: str) -> str:
    return f"list_filter({each(vec, f'CASE WHEN {vec}[i] > 0 THEN i - 1 END')}, lambda j: j IS NOT NULL)"


def top_k(vec: str, k: int) -> str:
    ranked = f"list_sort({each(vec, f'{{v: {vec}[i], i: i - 1}}')}, 'DESC')"
    return f"list_transform(list_slice({ranked}, 1, {k}), lambda s: s.i)"


def smooth(vec: str) -> str:
    return f"list_transform({vec}, lambda x: (x + 1e-9::DOUBLE) / list_sum(list_transform({vec}, lambda y: y + 1e-9::DOUBLE)))"


DOCS = "docs AS (SELECT doc_id, text, lang AS language, source FROM documents)"
VECTORS = f"""{DOCS},
folded AS MATERIALIZED (SELECT *, regexp_replace(translate(lower(text), 'éó', 'EO'), '[À-ɏ]', 'X', 'g') AS t FROM docs),
counted AS MATERIALIZED (SELECT doc_id, text, language, source, [{', '.join(_count(c) for c in CATEGORIES)}] AS c FROM folded),
vectors AS MATERIALIZED (SELECT *, list_transform(c, lambda x: CASE WHEN list_sum(c) = 0 THEN 0.0::DOUBLE
    ELSE x::DOUBLE / list_sum(c)::DOUBLE END) AS v FROM counted)"""
LABELLED = f"""{VECTORS},
labelled AS MATERIALIZED (SELECT doc_id, text, language, source, v, '1' AS harmful, {names_of('v')} AS safety_categories,
    {format_distribution('v')} AS safety_distribution FROM vectors WHERE list_sum(c) > 0)"""


def any_term(text: str, terms=None) -> str:
    terms = [t for _, t in EXAMPLE_LEXICON] if terms is None else terms
    return "(" + " OR ".join(f"contains({text}, {quoted(t)})" for t in dict.fromkeys(terms)) + ")"


def profane(text: str = "text", language: str = "language") -> str:
    cases = []
    for code in dict.fromkeys(c for c, _ in EXAMPLE_LEXICON):
        cases.append(f"WHEN {language} = '{code}' AND {any_term(text, [t for c, t in EXAMPLE_LEXICON if c == code])} THEN 1")
    return f"CASE {' '.join(cases)} ELSE 0 END"


LEXICON = ("lexicon AS (SELECT * FROM (VALUES "
           + ", ".join(f"({quoted(c)}, {quoted(t)})" for c, t in EXAMPLE_LEXICON) + ") AS l(language, term))")
BINARY = f"""{DOCS},
binary_rows AS MATERIALIZED (SELECT d.*, CAST(l.toxic AS VARCHAR) AS harmful FROM docs d JOIN labels l USING (doc_id))"""
PREDICTIONS = f"""{BINARY},
predictions AS MATERIALIZED (SELECT *,
    CASE WHEN {digit('gold')} = '0' THEN 'n/a'
         WHEN harmful = '1' THEN CASE WHEN {digit('gold')} = '1' THEN ' Unsafe' || chr(10) ELSE 'UNSAFE' END ELSE 'SAFE' END AS raw_gold,
    CASE {digit('pred')} WHEN '0' THEN 'maybe' WHEN '1' THEN ' unsafe. ' WHEN '2' THEN '1' WHEN '3' THEN 'HARMFUL' WHEN '4' THEN NULL
         ELSE CASE WHEN {any_term('text')} THEN 'UNSAFE' ELSE 'SAFE' END END AS pred_raw,
    CASE WHEN {digit('run')} < '8' THEN 'run_a' ELSE 'run_b' END AS run
    FROM binary_rows)"""
SHOUT = lambda c: rf"upper(regexp_replace({c}, '^\s+|\s+$', '', 'g'))"
FULL_POLICY = f"""CASE WHEN pred_raw IS NULL THEN 'UNKNOWN' WHEN {SHOUT('pred_raw')} LIKE '%UNSAFE%' THEN 'UNSAFE'
    WHEN {SHOUT('pred_raw')} LIKE '%SAFE%' THEN 'SAFE' WHEN {SHOUT('pred_raw')} IN ('0', 'HARMFUL', 'DANGEROUS', 'ABUSIVE') THEN 'UNSAFE'
    WHEN {SHOUT('pred_raw')} IN ('1', 'BENIGN', 'OK') THEN 'SAFE' ELSE 'UNKNOWN' END"""
JUDGED = f"""{PREDICTIONS},
judged AS MATERIALIZED (SELECT * REPLACE ({FULL_POLICY} AS pred), CASE WHEN {SHOUT('raw_gold')} IN ('SAFE', 'UNSAFE') THEN {SHOUT('raw_gold')}
    ELSE 'UNKNOWN' END AS gold FROM (SELECT *, '' AS pred FROM predictions)),
valid AS (SELECT * FROM judged WHERE gold IN ('SAFE', 'UNSAFE'))"""


def stats(rows: str, labels: str | None, by: str = "1") -> str:
    """CTEs ``k`` (groups and labels) and ``stats``; ``labels`` None takes those that occur."""
    wanted = (f"SELECT DISTINCT {by} AS g, l AS label FROM {rows}, unnest({labels}) AS u(l)" if labels else
              f"SELECT DISTINCT {by} AS g, gold AS label FROM {rows} UNION SELECT DISTINCT {by}, pred FROM {rows}")
    return f"""k AS ({wanted}),
stats AS (SELECT k.g, k.label, count(*) FILTER (WHERE r.gold = k.label AND r.pred = k.label) AS tp,
    count(*) FILTER (WHERE r.gold = k.label) AS support, count(*) FILTER (WHERE r.pred = k.label) AS predicted
    FROM k JOIN (SELECT {by} AS g, gold, pred FROM {rows}) r ON r.g = k.g GROUP BY ALL),
classes AS (SELECT *, CASE WHEN predicted = 0 THEN 0 ELSE tp::DOUBLE / predicted END AS p,
    CASE WHEN support = 0 THEN 0 ELSE tp::DOUBLE / support END AS r,
    CASE WHEN predicted + support = 0 THEN 0 ELSE 2 * tp::DOUBLE / (predicted + support) END AS f FROM stats)"""


def report(rows: str, labels: str | None, group: str | None = None) -> str:
    """Query for a classification report over the CTEs of ``stats``."""
    lead = f"g AS {group}, " if group else ""
    lines = [f"SELECT {lead}label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM classes"]
    by = group or "1"
    if labels:
        out = f"(SELECT {by} AS g, max(CASE WHEN pred NOT IN (SELECT unnest({labels})) THEN 1 ELSE 0 END) AS o FROM {rows} GROUP BY ALL)"
    else:
        out = f"(SELECT DISTINCT {by} AS g, 0 AS o FROM {rows})"
    lines.append(f"""SELECT {'c.g, ' if group else ''}CASE WHEN max(o) = 1 THEN 'micro avg' ELSE 'accuracy' END,
        round(CASE WHEN sum(predicted) = 0 THEN 0 ELSE sum(tp)::DOUBLE / sum(predicted) END, 6), round(sum(tp)::DOUBLE / sum(support), 6),
        round(2 * sum(tp)::DOUBLE / (sum(predicted) + sum(support)), 6), CAST(sum(support) AS BIGINT)
        FROM classes c JOIN {out} z ON z.g = c.g GROUP BY c.g""")
    for name, agg in (("macro avg", "avg({})"), ("weighted avg", "sum({} * support)::DOUBLE / sum(support)")):
        cols = ", ".join(f"round({agg.format(c)}, 6)" for c in "prf")
        lines.append(f"SELECT {'g, ' if group else ''}'{name}', {cols}, CAST(sum(support) AS BIGINT) FROM classes GROUP BY g")
    return " UNION ALL ".join(lines)


BINARY_LIST = text_list(BINARY_LABELS)
CATEGORY_LIST = text_list(CATEGORIES)


def distribution_text(salt: str) -> str:
    hashed = f"md5('{salt}|' || doc_id)"
    value = f"translate(substr({hashed}, i, 1), '0123456789abcdef', '0000000000123456')"
    number = f"CASE WHEN {value} = '0' THEN '0' ELSE concat('0.', {value}) END"
    items = lambda last: f"array_to_string(list_transform(range(1, {last + 1}), lambda i: concat('S', i, ': ', {number})), ', ')"
    full = items(WIDTH)
    quoted_form = f"""concat('{{"', replace(replace({full}, ': ', '": '), ', ', ', "'), '}}')"""
    return rf"""CASE {digit('kind ' + salt)} WHEN '0' THEN {items(WIDTH - 1)} WHEN '1' THEN concat({full}, '.5.') WHEN '2' THEN {quoted_form}
    WHEN '3' THEN concat('{{', {full}, 'e-05}}') WHEN '4' THEN array_to_string({each('', number)}, ' ') WHEN '5' THEN NULL
    WHEN '6' THEN regexp_replace({full}, '0\.\d', '0', 'g') ELSE concat('{{', {full}, '}}') END"""


DISTRIBUTIONS = f"""{DOCS},
distributions AS MATERIALIZED (SELECT *, {distribution_text('truth')} AS truth, {distribution_text('guess')} AS pred_raw FROM docs)"""
USABLE = "(text <> '' AND truth IS NOT NULL AND truth <> '')"
SCORED = f"""{DISTRIBUTIONS},
parsed AS MATERIALIZED (SELECT *, CASE WHEN {USABLE} THEN {parse('truth')} END AS t, CASE WHEN {USABLE} THEN {parse('pred_raw')} END AS p FROM distributions),
sets AS MATERIALIZED (SELECT *, {positives('t')} AS pos, {positives('p')} AS ppos, {smooth('t')} AS st, {smooth('p')} AS sp FROM parsed),
scored AS MATERIALIZED (SELECT *,
    list_sum(list_transform(range(1, {WIDTH + 1}), lambda i: st[i] * ln(st[i] / sp[i]) - st[i] + sp[i])) AS kl,
    CASE WHEN p IS NOT NULL AND len(pos) > 0 THEN list_sum(list_transform(pos, lambda k:
        len(list_filter(pos, lambda j: p[j + 1] >= p[k + 1]))::DOUBLE / len(list_filter(p, lambda x: x >= p[k + 1])))) / len(pos) END AS ap,
    CASE WHEN p IS NOT NULL AND len(pos) > 0 THEN len(list_intersect({top_k('p', 1)}, pos))::DOUBLE / len(pos) END AS r1,
    CASE WHEN p IS NOT NULL AND len(pos) > 0 THEN len(list_intersect({top_k('p', 3)}, pos))::DOUBLE / len(pos) END AS r3,
    CASE WHEN t IS NOT NULL AND p IS NOT NULL THEN CASE WHEN len(pos) + len(ppos) = 0 THEN 1.0::DOUBLE
        ELSE len(list_intersect(pos, ppos))::DOUBLE / len(list_distinct(list_concat(pos, ppos))) END END AS jac,
    CASE WHEN t IS NOT NULL AND p IS NOT NULL THEN CASE WHEN pos = ppos THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS em,
    CASE WHEN t IS NOT NULL AND p IS NOT NULL THEN CASE WHEN list_position(t, list_max(t)) = list_position(p, list_max(p))
        THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS hit
    FROM sets),
top1 AS (SELECT *, {winner('t')} AS gold, {winner('p')} AS pred FROM scored WHERE t IS NOT NULL AND p IS NOT NULL)"""

_first = lambda role: f"arg_min(text, turn) FILTER (WHERE role = '{role}')"
_nested = lambda tag: f"[[{quoted(tag)} || p, {quoted(tag)} || r]]"
DIALOGUES = f"""pairs AS MATERIALIZED (SELECT conv_id, {_first('user')} AS p, {_first('assistant')} AS r FROM conversations GROUP BY conv_id),
dialogues AS (SELECT conv_id, p, r,
    CASE WHEN {digit('bn', 1, 'conv_id')} < '4' THEN NULL ELSE 'bn: ' || p END AS bn,
    CASE WHEN {digit('kn', 1, 'conv_id')} < '4' THEN NULL ELSE 'kn, "' || p END AS kn,
    CASE WHEN {digit('ml', 1, 'conv_id')} < '4' THEN NULL ELSE 'ml ' || p END AS ml,
    'or ' || p AS "or" FROM pairs)"""
DIALOGUE_VECTORS = f"""{DIALOGUES},
folded AS MATERIALIZED (SELECT *, regexp_replace(translate(lower(coalesce(r, '')), 'éó', 'EO'), '[À-ɏ]', 'X', 'g') AS t FROM dialogues),
counted AS MATERIALIZED (SELECT *, [{', '.join(_count(c) for c in CATEGORIES)}] AS c FROM folded),
vectors AS MATERIALIZED (SELECT *, list_transform(c, lambda x: CASE WHEN list_sum(c) = 0 THEN 0.0::DOUBLE
    ELSE x::DOUBLE / list_sum(c)::DOUBLE END) AS v FROM counted)"""
