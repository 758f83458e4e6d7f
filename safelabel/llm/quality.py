"""Quality rules by distribution divergence, in DataFrame functions alone.

A document is described by two histograms: its characters by class, and the common words of
its language. For each language the reference is the pooled histogram of all documents that
pass the base rules. A document is rejected if the Jensen-Shannon distance (base 2, from 0
to 1) of a histogram from its reference exceeds a limit. A histogram is judged only if the
document is long enough for it: ``MIN_CHARS`` characters, ``MIN_WORDS`` words.

The text is read once and reduced to counts, which are written to the shared folder; the
references are sums over them, combined on the map side, one row for each of the few known
languages (others share one), so they are broadcast.

Repeated words are found by hashes of eight-word windows, made in three pairing steps. Only
documents with a repeated window pay for sorting them.

Null and empty texts have no words and fail the base rules. Repeated rows are judged each.
Null or unknown languages count as ``other``, which has no common words. Extra columns are
kept by ``keep`` and ignored by ``judge``. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.llm.store import fresh_name, written

# Frequent words of each language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "on"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "que", "qui"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del"],
}
SYMBOLS = "#*$%&|<>"
MIN_CHARS, MIN_WORDS = 400, 100
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.22
BASE_MIN_WORDS, BASE_REPEATED = 20, 30
CLASSES = ["n_lower", "n_upper", "n_digit", "n_space", "n_symbols", "n_other_ascii", "n_beyond_ascii"]


def _left(column: Column, pattern: str) -> Column:
    """Code points that stay after removing matches."""
    return F.length(F.regexp_replace(column, pattern, "")).cast("long")


def _paired(hashes: str, step: int) -> Column:
    """Hashes of runs twice as long: each with the one ``step`` words on."""
    rest = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), rest), F.slice(hashes, F.lit(step + 1), rest), lambda a, b: F.xxhash64(a, b))


def _repeated_words(windows: str, width: int = 8) -> Column:
    """Words in windows that occur twice or more: places of such windows in order, each adding what it covers anew."""
    return F.expr(f"""
        case when size({windows}) < 2 or size(array_distinct({windows})) = size({windows}) then 0L else
          aggregate(
            array_sort(transform(filter(
              transform(sequence(0, size({windows}) - 1), i -> struct(i as i, sorted[i].h as h, sorted[i].i as at,
                i > 0 and sorted[i].h = sorted[greatest(i - 1, 0)].h or i < size({windows}) - 1 and sorted[i].h = sorted[least(i + 1, size({windows}) - 1)].h as twice)),
              x -> x.twice), x -> x.at)),
            named_struct('end', 0, 'n', 0L),
            (s, p) -> named_struct('end', p + {width}, 'n', s.n + p + {width} - greatest(p, s.end)),
            s -> s.n) end""")


def _times(word: str) -> Column:
    return F.size(F.filter("common", lambda w: w == word)).cast("long")


def counts(documents: DataFrame) -> DataFrame:
    """One narrow row of counts for each document: doc_id, lang, base counts, classes, common words."""
    text = F.coalesce("text", F.lit(""))
    known = F.when(F.col("lang").isin(list(COMMON)), F.col("lang")).otherwise(F.lit("other"))
    base = documents.select(F.col("doc_id").cast("long"), known.alias("lang"), text.alias("t"))
    split = base.withColumn("words", F.array_remove(F.split(F.translate("t", "\t\n\u000b\u000c\r", "     "), " "), ""))
    lines = F.filter(F.transform(F.split("t", "\n"), lambda x: F.when(x.rlike("[^\\x20\\x09-\\x0D]"), x)), lambda x: x.isNotNull())
    hashed = split.withColumns({"hashes": F.transform("words", lambda w: F.xxhash64(w)), "lines": lines})
    windows = hashed.withColumn("two", _paired("hashes", 1)).withColumn("four", _paired("two", 2)).withColumn("windows", _paired("four", 4))
    ranked = windows.withColumn("sorted", F.expr(
        "case when size(array_distinct(windows)) < size(windows) then sort_array(transform(windows, (h, i) -> struct(h as h, i as i))) end"))
    listed = [w for ws in COMMON.values() for w in ws]
    common = F.filter("words", lambda w: w.isin(sorted(set(listed))))
    counted = ranked.select(
        "doc_id", "lang", F.size("words").cast("long").alias("n_words"), F.length("t").cast("long").alias("n_chars"),
        F.aggregate("words", F.lit(0), lambda s, w: s + F.length(w)).cast("long").alias("word_chars"),
        _left(F.col("t"), "[^#*$%&|<>]++").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words("windows").cast("long").alias("n_repeat_words"),
        _left(F.col("t"), "[^a-z]++").alias("n_lower"), _left(F.col("t"), "[^A-Z]++").alias("n_upper"), _left(F.col("t"), "[^0-9]++").alias("n_digit"),
        _left(F.col("t"), "[\\x00-\\x7F]++").alias("n_beyond_ascii"), common.alias("common"),
    )
    space = F.col("n_chars") - F.col("word_chars")
    of_language = F.lit(None)
    for lang, words in COMMON.items():
        of_language = F.when(F.col("lang") == lang, F.array(*[_times(k) for k in words])).otherwise(of_language)
    rest = F.col("n_chars") - space - sum(F.col(c) for c in CLASSES if c not in ("n_space", "n_other_ascii"))
    classes = F.array(*[{"n_space": space, "n_other_ascii": rest}.get(c, F.col(c)) for c in CLASSES])
    narrow = counted.withColumn("own_words", of_language.cast("array<bigint>"))
    hits = F.aggregate("own_words", F.lit(0).cast("long"), lambda s, x: s + x)
    return narrow.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", classes.alias("classes"),
        F.when(F.col("own_words").isNotNull(), F.concat("own_words", F.array(F.col("n_words") - hits))).alias("common"),
        ((F.col("n_words") < BASE_MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_REPEATED)).alias("base_failed"),
    )


def distance(own: str, reference: str) -> Column:
    """Jensen-Shannon distance of two histograms of counts; 0 if either is empty or missing."""
    return F.expr(f"""
        case when {own} is null or {reference} is null
               or aggregate({own}, 0L, (s, x) -> s + x) = 0 or aggregate({reference}, 0L, (s, x) -> s + x) = 0 then 0D else
        sqrt(greatest(0D, aggregate(zip_with(
          transform({own}, x -> x / aggregate({own}, 0L, (s, y) -> s + y)),
          transform({reference}, x -> x / aggregate({reference}, 0L, (s, y) -> s + y)),
          (p, q) -> (case when p > 0 then p * log2(2 * p / (p + q)) else 0D end + case when q > 0 then q * log2(2 * q / (p + q)) else 0D end) / 2),
          0D, (s, x) -> s + x))) end""")


def references(counted: DataFrame) -> DataFrame:
    """(lang, ref_classes, ref_common): pooled counts of documents that pass the base rules."""
    passed = counted.where("not base_failed")
    size = max(len(w) for w in COMMON.values()) + 1
    sums = passed.groupBy("lang").agg(
        *[F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES))], *[F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(size)])
    return sums.select(
        "lang", F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("ref_classes"),
        F.when(F.col("w0").isNotNull(), F.array(*[f"w{i}" for i in range(size)])).alias("ref_common"))


def judge(documents: DataFrame) -> DataFrame:
    """(doc_id, base counts, base_failed, kept) of every row, and the distances (null where not judged)."""
    counted = written(counts(documents))
    joined = counted.join(F.broadcast(references(counted)), "lang", "left")  # one row for each known language
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda s, x: s + x)
    judged = joined.withColumns({
        "class_distance": F.when(chars >= MIN_CHARS, distance("classes", "ref_classes")),
        "word_distance": F.when((F.col("n_words") >= MIN_WORDS) & F.col("common").isNotNull(), distance("common", "ref_common")),
    })
    far = (F.coalesce("class_distance", F.lit(0.0)) > MAX_CLASS_DISTANCE) | (F.coalesce("word_distance", F.lit(0.0)) > MAX_WORD_DISTANCE)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"),
        F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))


def keep(documents: DataFrame) -> DataFrame:
    """The documents that are kept; columns as they were. A doc_id is kept if all rows of it are."""
    name = fresh_name(documents, "rejected_id")
    rejected = judge(documents).where("not kept").select(F.col("doc_id").alias(name))
    return documents.join(rejected, documents["doc_id"].cast("long").eqNullSafe(F.col(name)), "left_anti")
