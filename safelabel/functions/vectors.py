"""Rules on category vectors: arrays of doubles in category order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from safelabel.catalog import CATEGORIES, SAFE, SMOOTHING, WIDTH
from safelabel.functions.base import SPACE, as_col, let, strip, total

# Decimal digits of the scripts in use, mapped to ASCII.
_DIGIT_ZEROS = [0x0966, 0x09E6, 0x0B66, 0x0CE6, 0x0D66]  # Devanagari, bn, or, kn, ml
_DIGITS = "".join(chr(z + d) for z in _DIGIT_ZEROS for d in range(10))
_ASCII_DIGITS = "0123456789" * len(_DIGIT_ZEROS)


def _names(categories: list[str]) -> Column:
    return F.array(*[F.lit(c) for c in categories])


# --- building -----------------------------------------------------------------------
def shares(counts: Column | str) -> Column:
    """Counts divided by their sum; all zeros when the sum is zero."""
    counts = as_col(counts)
    return let(counts, lambda c: let(
        F.aggregate(c, F.lit(0).cast("bigint"), lambda acc, x: acc + x),
        lambda n: F.transform(c, lambda x: F.when(n == 0, F.lit(0.0)).otherwise(x / n)),
    ))


def harm_flag(vec: Column | str) -> Column:
    """``"1"`` when anything is positive, else ``"0"`` (a string)."""
    return F.when(total(as_col(vec)) > 0, F.lit("1")).otherwise(F.lit("0"))


def category_list(vec: Column | str, categories: list[str] = CATEGORIES) -> Column:
    """Names of the non-zero categories in order, joined by spaces."""
    names = F.transform(F.arrays_zip(as_col(vec).alias("v"), _names(categories).alias("c")),
                        lambda p: F.when(p["v"] > 0, p["c"]))
    return F.array_join(names, " ")


def vector_to_map(vec: Column | str, categories: list[str] = CATEGORIES) -> Column:
    return F.map_from_arrays(_names(categories), as_col(vec))


def map_to_vector(m: Column | str, categories: list[str] = CATEGORIES) -> Column:
    """Values in category order; a missing category is zero."""
    m = as_col(m)
    return F.when(m.isNotNull(), F.array(*[
        F.coalesce(F.try_element_at(m, F.lit(c)), F.lit(0.0)) for c in categories]))


def format_distribution(vec: Column | str, decimals: int = 10, categories: list[str] = CATEGORIES) -> Column:
    """``{S1: 0.4000000000, S2: 0, ...}``: the form that ``parse_distribution`` reads.

    Plain decimals only, as an exponent would be read wrongly.
    """
    items = F.transform(
        F.arrays_zip(as_col(vec).alias("v"), _names(categories).alias("c")),
        lambda p: F.concat(p["c"], F.lit(": "),
                           F.when(p["v"] == 0, F.lit("0")).otherwise(F.format_string(f"%.{decimals}f", p["v"]))))
    return F.when(as_col(vec).isNotNull(), F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}")))


# --- reading ------------------------------------------------------------------------
def parse_distribution(col: Column | str, width: int = WIDTH) -> Column:
    """Vector from ``{S1: 0.4, S2: 0.4, ...}`` or from bare numbers, else null.

    Numbers are taken by position.  Signs and exponents are not read, and one number
    that does not parse spoils the whole string.
    """
    digits = F.translate(as_col(col), _DIGITS, _ASCII_DIGITS)

    def read(text: Column) -> Column:
        keyed = F.regexp_extract_all(text, F.lit(rf"S\d+:{SPACE}*([\d.]+)"), F.lit(1))
        bare = F.regexp_extract_all(text, F.lit(r"([\d.]+)"), F.lit(1))
        return let(keyed, lambda k: F.when(F.size(k) == width, k).otherwise(
            let(bare, lambda b: F.when(F.size(b) == width, b))))

    numbers = F.transform(let(digits, read), lambda t: t.try_cast("double"))
    return let(numbers, lambda v: F.when(~F.exists(v, lambda x: x.isNull()), v))


def parse_kv(col: Column | str) -> Column:
    """Map from ``k: v, k: v``; a value is read as far as it is a number, else null.

    Of several entries with one key the last counts.
    """
    number = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"

    def entry(part: Column) -> Column:
        return let(F.split(part, ":"), lambda kv: F.struct(
            strip(F.get(kv, F.lit(0))).alias("key"),
            F.regexp_extract(strip(F.get(kv, F.lit(1))), number, 0).try_cast("double").alias("value")))

    def last_ones(entries: Column) -> Column:
        return F.filter(entries, lambda e, i: ~F.exists(
            F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))

    return let(F.transform(F.split(as_col(col), ","), entry), lambda es: F.map_from_entries(last_ones(es)))


def parse_distribution_json(col: Column | str) -> Column:
    """Map from a JSON object in a string; empty when it does not parse."""
    parsed = F.from_json(as_col(col), "map<string,double>")
    return F.coalesce(parsed, F.create_map().cast("map<string,double>"))


# --- maps ---------------------------------------------------------------------------
def normalise_map(m: Column | str) -> Column:
    """Values divided by their sum; all zeros when the sum is zero."""
    return let(as_col(m), lambda x: let(
        total(F.map_values(x)),
        lambda n: F.transform_values(x, lambda _, v: F.when(n == 0, F.lit(0.0)).otherwise(v / n))))


def non_zero(m: Column | str) -> Column:
    return F.map_filter(as_col(m), lambda _, v: v > 0)


def majority(vec: Column | str, categories: list[str] = CATEGORIES) -> Column:
    """``struct(category, score)`` of the first largest value; ``("", 0)`` when none is positive."""
    return let(as_col(vec), lambda v: let(F.array_max(v), lambda top: F.struct(
        F.when(top > 0, F.get(_names(categories), F.array_position(v, top) - 1)).otherwise(F.lit("")).alias("category"),
        F.when(top > 0, top).otherwise(F.lit(0.0)).alias("score"))))


def moderation_response(result: Column | str, vec: Column | str, categories: list[str] = CATEGORIES) -> Column:
    """Response of the two-stage moderator from the binary result and the raw vector.

    SAFE texts carry no distribution; for all others the vector is normalised.
    """
    result, vec = as_col(result), as_col(vec)
    safe = F.struct(
        F.lit(None).cast("map<string,double>").alias("distribution"),
        F.lit(None).cast("map<string,double>").alias("nonZero"),
        F.lit(SAFE).alias("category"), F.lit(SAFE).alias("safety"), F.lit(1.0).alias("score"))

    def unsafe(v: Column) -> Column:
        m = vector_to_map(v, categories)
        return let(majority(v, categories), lambda best: F.struct(
            m.alias("distribution"), non_zero(m).alias("nonZero"),
            best["category"].alias("category"), result.alias("safety"), best["score"].alias("score")))

    return F.when(result == SAFE, safe).otherwise(let(normalise_vector(vec), unsafe))


def normalise_vector(vec: Column | str) -> Column:
    """Values divided by their sum; all zeros when the sum is zero."""
    return let(as_col(vec), lambda v: let(total(v), lambda n: F.transform(
        v, lambda x: F.when(n == 0, F.lit(0.0)).otherwise(x / n))))


# --- choosing -----------------------------------------------------------------------
def winner(vec: Column | str, categories: list[str] = CATEGORIES) -> Column:
    """Category of the first largest value; the first category when all are zero."""
    return let(as_col(vec), lambda v: F.get(_names(categories), F.array_position(v, F.array_max(v)) - 1))


def positives(vec: Column | str) -> Column:
    """Zero-based positions of the positive values."""
    return F.filter(F.transform(as_col(vec), lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())


def top_k(vec: Column | str, k: int) -> Column:
    """Zero-based positions of the k largest values; of equal values the later wins."""
    ranked = F.reverse(F.array_sort(F.transform(as_col(vec), lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    return F.transform(F.slice(ranked, 1, k), lambda p: p["i"])


# --- comparing truth and prediction ---------------------------------------------------
def smooth(vec: Column | str, epsilon: float = SMOOTHING) -> Column:
    """``(v + eps) / sum(v + eps)``."""
    return let(F.transform(as_col(vec), lambda x: x + epsilon), lambda v: let(
        total(v), lambda n: F.transform(v, lambda x: x / n)))


def kl_divergence(truth: Column | str, pred: Column | str, epsilon: float = SMOOTHING) -> Column:
    """Sum of ``t ln(t/p) - t + p`` over the smoothed vectors."""
    return let(smooth(truth, epsilon), lambda t: let(smooth(pred, epsilon), lambda p: total(
        F.zip_with(t, p, lambda a, b: a * F.ln(a / b) - a + b))))


def topk_recall(truth: Column | str, pred: Column | str, k: int) -> Column:
    """Share of the positives among the top k; null when nothing is positive."""
    return let(positives(truth), lambda pos: F.when(
        F.size(pos) > 0, F.size(F.array_intersect(top_k(pred, k), pos)) / F.size(pos)))


def average_precision(truth: Column | str, pred: Column | str) -> Column:
    """Mean precision at the scores of the positives; equal scores share a threshold."""
    pred = as_col(pred)

    def mean_precision(pos: Column) -> Column:
        def precision(at: Column) -> Column:
            return let(F.get(pred, at), lambda cut:
                       F.size(F.filter(pos, lambda j: F.get(pred, j) >= cut))
                       / F.size(F.filter(pred, lambda x: x >= cut)))

        return F.when(F.size(pos) > 0, total(F.transform(pos, precision)) / F.size(pos))

    return let(positives(truth), mean_precision)


def jaccard(truth: Column | str, pred: Column | str) -> Column:
    """Overlap of the two sets of positives; 1 when both are empty."""
    return let(positives(truth), lambda t: let(positives(pred), lambda p: let(
        F.size(F.array_union(t, p)),
        lambda n: F.when(n == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(t, p)) / n))))


def exact_match(truth: Column | str, pred: Column | str) -> Column:
    """1.0 when both sets of positives are the same, else 0.0."""
    return (positives(truth) == positives(pred)).cast("double")
