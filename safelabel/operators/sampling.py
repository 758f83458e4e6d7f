"""Exact, reproducible sampling without sorting or moving the texts.

Rows are ordered by a hash of the seed and the row id.  A sample of k rows is the
rows up to the k-th in that order.  The k-th row is found from counts per leading
hash digits (a small aggregate with map-side combine), taking further digits while the
range it lies in is still large, and at last by ranking that one small range.  Then
every row is compared with the cut-off where it lies.  So no key, however large, is
ever gathered in one task, and the wide rows are not shuffled at all.

Row ids, one column or a list of them, must be unique: where a repeated id would change a
size or an order, the sampler raises.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safelabel.catalog import CATEGORIES
from safelabel.session import broadcast_if, pin, pin_if_small, small_side, stage_table

# Hex digits of the hash that split a range further: 16**3 parts, few enough for a task
# to combine most of its rows before the shuffle.
RANGE_DIGITS = 3
# A range is ranked in one task (ids and hashes only) when it has no more rows.
RANK_ROWS = 2_000_000


def row_hash(seed: int, *cols: Column | str) -> Column:
    """md5 of the seed and the columns, as hex."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c for c in cols]))


def id_columns(id_col: str | list[str]) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def _id(id_col: str | list[str]) -> Column:
    return F.col(id_col) if isinstance(id_col, str) else F.struct(*id_col)


def _hashed(df: DataFrame, keys: list[str], seed: int, id_col: str | list[str], digits: int) -> DataFrame:
    return df.select(*keys, row_hash(seed, *id_columns(id_col)).alias("_hash"), _id(id_col).alias("_id")) \
        .withColumn("_range", F.substring("_hash", 1, digits))


def _ranked(hashed: DataFrame, keys: list[str]) -> DataFrame:
    """Add the position ``_nth`` within the keys and the place ``_last`` of a row; ids that repeat raise."""
    order = Window.partitionBy(*keys).orderBy("_hash", "_id")
    place = F.struct("_hash", "_id")
    return (hashed.withColumn("_nth", F.row_number().over(order)).withColumn("_next", F.lead(place).over(order))
            .withColumn("_last", F.when(F.col("_next") == place, F.raise_error(F.lit("row ids repeat; samples need unique ones"))).otherwise(place))
            .drop("_next"))


def _cumulated(counts: DataFrame, parent: list[str]) -> DataFrame:
    """Add the rows of the parent before each range, and in all."""
    within = Window.partitionBy(*parent)
    upto = within.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    return (counts.withColumn("_before", F.sum("_rows").over(upto) - F.col("_rows"))
            .withColumn("_total", F.sum("_rows").over(within)))


def hash_ranges(df: DataFrame, keys: list[str], seed: int, id_col: str | list[str]) -> DataFrame:
    """Rows per key and hash range, with the rows of the key before it and in all."""
    hashed = _hashed(df, keys, seed, id_col, RANGE_DIGITS)
    return _cumulated(hashed.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_rows")), keys)


def _boundaries(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The range in which position ``_nth`` lies, and the position within it."""
    inside = (F.col("_before") < F.col("_nth")) & (F.col("_nth") <= F.col("_before") + F.col("_rows"))
    return ranges.filter(inside).select(*keys, "_cut", "_range", (F.col("_nth") - F.col("_before")).alias("_nth"), "_rows")


def last_rows(df: DataFrame, ranges: DataFrame, keys: list[str], seed: int, id_col: str | list[str], few: bool,
              check: Callable[[DataFrame], None] = lambda bounds: None) -> DataFrame:
    """Hash and id of the row at position ``_cut`` of each key, for every ``_cut`` given.

    ``ranges`` is the output of ``hash_ranges`` with a column ``_cut`` added.  ``few``
    says that the number of cuts is known to be small: then they are kept with the plan,
    else in a staged table.  A cut past the end of its key has no row; ``check`` sees the keys and cuts
    that have one.
    """
    settle = pin if few else (lambda frame: stage_table(frame, "cuts"))
    digits, bounds = RANGE_DIGITS, settle(_boundaries(ranges.withColumn("_nth", F.col("_cut")), keys))
    check(bounds)

    def rows_inside() -> DataFrame:
        wanted = bounds.select(*keys, "_range").distinct()
        return _hashed(df, keys, seed, id_col, digits).join(broadcast_if(few, wanted), [*keys, "_range"], "left_semi")

    while digits < 32 and (bounds.agg(F.max("_rows")).first()[0] or 0) > RANK_ROWS:
        deeper = min(digits + RANGE_DIGITS, 32)
        counts = (rows_inside().groupBy(*keys, F.col("_range").alias("_parent"), F.substring("_hash", 1, deeper).alias("_range"))
                  .agg(F.count(F.lit(1)).alias("_rows")))
        positions = bounds.select(*keys, F.col("_range").alias("_parent"), "_cut", "_nth")
        parts = _cumulated(counts, [*keys, "_parent"]).join(broadcast_if(few, positions), [*keys, "_parent"])
        digits, bounds = deeper, settle(_boundaries(parts, keys))

    ranked = _ranked(rows_inside(), [*keys, "_range"])
    positions = bounds.select(*keys, "_range", "_cut", "_nth")
    return settle(ranked.join(broadcast_if(few, positions), [*keys, "_range", "_nth"])
                  .select(*keys, "_cut", "_last"))


def _place(seed: int, id_col: str | list[str]) -> Column:
    return F.struct(row_hash(seed, *id_columns(id_col)).alias("_hash"), _id(id_col).alias("_id"))


# --- quota sampling -------------------------------------------------------------------
class ShortPool(RuntimeError):
    """A quota asks for more rows than there are."""


def quota_picks(quotas: DataFrame, keys: list[str], pick: str | None = None) -> DataFrame:
    """Quotas as consecutive ranges ``(_low, _cut]`` of positions per key.

    Several quotas on one key take successive rows, in the order of ``pick``.
    """
    order = F.col(pick) if pick else F.lit(1)
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    positive = F.greatest(F.col("quota"), F.lit(0)).cast("bigint")
    return (quotas.withColumn("_want", positive)
            .withColumn("_cut", F.sum("_want").over(upto)).withColumn("_low", F.col("_cut") - F.col("_want"))
            .filter("_want > 0"))


def quota_coverage(df: DataFrame, quotas: DataFrame, keys: list[str]) -> DataFrame:
    """Size and quota of every bucket; the quota is null where none is given."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(small_side(quotas.select(*keys, "quota")), keys, "left")


def quota_sample(df: DataFrame, quotas: DataFrame, keys: list[str], seed: int = 42, id_col: str | list[str] = "id",
                 pick: str | None = None, on_short: str = "error") -> DataFrame:
    """Exactly ``quota`` random rows for each row of ``quotas``, without replacement.

    ``quotas`` holds the key columns and ``quota``; with ``pick`` it also names each
    draw, the names are attached to the rows, and draws on one key are disjoint.
    Quotas of zero or less draw nothing.  A pool smaller than its quota raises, or
    with ``on_short="all"`` is taken whole.
    """
    quotas, few = pin_if_small(quotas)  # there is at most one cut, and one last row, per quota
    picks = quota_picks(quotas, keys, pick).select(*keys, "_cut", "_low", *([pick] if pick else []))

    def complain_if_short(bounds: DataFrame) -> None:
        """A pool that is large enough has a row at each of its cuts."""
        short = picks.join(broadcast_if(few, bounds), [*keys, "_cut"], "left_anti").limit(1).collect()
        if short:
            key = [short[0][k] for k in keys]
            have = df.filter(reduce(lambda a, b: a & b, [F.col(k) == v for k, v in zip(keys, key)])).count()
            raise ShortPool(f"need {short[0]['_cut']} rows for {key} but have {have}")

    ranges = hash_ranges(df, keys, seed, id_col).join(broadcast_if(few, picks.select(*keys, "_cut")), keys)
    lasts = last_rows(df, ranges, keys, seed, id_col, few, *([complain_if_short] if on_short == "error" else []))
    # Per key the draws in order; a draw past the end of its pool has no last row.
    draws = picks.join(broadcast_if(few, lasts), [*keys, "_cut"], "left").groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct("_cut", F.col(pick) if pick else F.lit(None).cast("string").alias("_pick"), "_last"))).alias("_draws"))
    name = pick or "_pick"
    place = _place(seed, id_col)
    # The first draw whose last row is not before this one owns it.
    owner = F.get(F.filter("_draws", lambda d: d["_last"].isNull() | (place <= d["_last"])), F.lit(0))
    picked = df.join(broadcast_if(few, draws), keys).withColumn("_owner", owner).filter(F.col("_owner").isNotNull())
    if pick:
        picked = picked.withColumn(pick, F.col("_owner")[name])
    return picked.drop("_draws", "_owner")


# --- whole-table draws ----------------------------------------------------------------
def _below_cut(df: DataFrame, cut: Column, seed: int, id_col: str | list[str], out: str) -> tuple[DataFrame, bool]:
    """Add ``out``: whether a row is among the first ``cut`` rows in hash order.

    ``cut`` is computed from ``_total``, the number of rows.  Also tells whether there
    is such a row at all.
    """
    keyed = df.withColumn("_all", F.lit(1))
    ranges = hash_ranges(keyed, ["_all"], seed, id_col).withColumn("_cut", cut)
    last = last_rows(keyed, ranges, ["_all"], seed, id_col, few=True).select("_all", "_last")
    marked = (keyed.join(F.broadcast(last), "_all", "left")
              .withColumn(out, F.coalesce(_place(seed, id_col) <= F.col("_last"), F.lit(False)))
              .drop("_all", "_last"))
    return marked, not last.isEmpty()


def sample_n(df: DataFrame, n: int | None, seed: int = 42, id_col: str | list[str] = "id") -> DataFrame:
    """``n`` random rows without replacement; all rows when ``n`` is None or too large."""
    if n is None:
        return df
    cut = F.least(F.lit(n).cast("bigint"), F.col("_total"))
    marked, _ = _below_cut(df, cut, seed, id_col, "_in")
    return marked.filter("_in").drop("_in")


def ratio_split(df: DataFrame, ratio: float, seed: int = 42, id_col: str | list[str] = "id", out: str = "split") -> DataFrame:
    """Mark a random ``ratio`` of the rows as train and the rest as test, exactly.

    Neither side is empty when there are two rows or more; a single row is train, and
    no rows raise.
    """
    cut = F.greatest(F.lit(1), F.least(F.floor(F.col("_total") * F.lit(float(ratio))), F.col("_total") - 1))
    marked, any_row = _below_cut(df, cut, seed, id_col, "_in")
    if not any_row:
        raise ValueError("nothing to split")
    return marked.withColumn(out, F.when(F.col("_in"), "train").otherwise("test")).drop("_in")


def shuffle(df: DataFrame, seed: int = 42, *id_cols: str) -> DataFrame:
    """All rows in a random, reproducible order.

    ``id_cols`` (``id`` by default) name a row; for drawn rows they include ``draw``,
    so that copies are spread and not kept together.
    """
    id_cols = id_cols or ("id",)
    return df.orderBy(row_hash(seed, *id_cols), *id_cols)


# --- class balancing ------------------------------------------------------------------
# Draws are laid out in blocks of this many, so that they spread over tasks.
DRAW_BLOCK = 100_000


def _draw_counts(short: DataFrame, category: str, n: int, seed: int) -> DataFrame:
    """How often a block of the ``n`` draws with replacement takes each position of a short pool."""
    last_block = (n - 1) // DRAW_BLOCK
    blocks = short.select(category, "_total", F.explode(F.sequence(F.lit(0), F.lit(last_block))).alias("_block"))
    if last_block:
        blocks = blocks.repartition(category, "_block")
    first = F.col("_block").cast("bigint") * DRAW_BLOCK + 1
    draws = blocks.select(category, "_total", "_block", F.explode(F.sequence(first, F.least(first + DRAW_BLOCK - 1, F.lit(n)))).alias("_draw"))
    number = F.conv(F.substring(row_hash(seed, F.lit("draw"), category, "_draw"), 1, 15), 16, 10).cast("bigint")
    return draws.groupBy(category, (number % F.col("_total") + 1).alias("_nth"), "_block").agg(F.count(F.lit(1)).alias("_times"))


def balance(df: DataFrame, category: str, n: int, seed: int = 42, id_col: str | list[str] = "id",
            categories: list[str] = CATEGORIES) -> DataFrame:
    """Exactly ``n`` rows of every one of the ``categories`` that has any.

    Larger pools are cut to ``n`` rows, equal ones stay, and smaller ones are drawn
    ``n`` times with replacement, so that rows may repeat and others may be missing.
    Adds ``draw``, which tells copies of one row apart.
    """
    df = df.filter(F.col(category).isin(categories))  # also bounds the broadcasts below
    ranges = hash_ranges(df, [category], seed, id_col).withColumn("_cut", F.lit(n).cast("bigint"))
    lasts = last_rows(df, ranges, [category], seed, id_col, few=True).select(category, "_last")
    large = (df.join(F.broadcast(lasts), category)
             .filter(_place(seed, id_col) <= F.col("_last")).drop("_last").withColumn("draw", F.lit(1).cast("bigint")))

    # A short pool has fewer than n rows, so ranking its ids in one task is bounded; the copies
    # of its rows are made by block of draws, in many tasks however small the pool.
    short = pin(df.groupBy(category).agg(F.count(F.lit(1)).alias("_total")).filter(F.col("_total") < n))
    pools = df.join(F.broadcast(short.select(category)), category, "left_semi")
    ranked = _ranked(_hashed(pools, [category], seed, id_col, RANGE_DIGITS), [category])
    taken = ranked.join(_draw_counts(short, category, n, seed), [category, "_nth"]).select(category, "_last", "_block", "_times")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = F.col("_block").cast("bigint") * DRAW_BLOCK
    drawn = (pools.withColumn("_last", _place(seed, id_col)).join(taken, [category, "_last"])
             .repartition(tasks, category, "_last", "_block")
             .withColumn("draw", F.explode(F.sequence(before + 1, before + F.col("_times")))))
    return large.unionByName(drawn.select(*large.columns))


def balance_summary(df: DataFrame, balanced: DataFrame, category: str, categories: list[str]) -> DataFrame:
    """Rows of every category in the pool and in the balanced table, both counted, and what was done."""
    size = lambda frame, name: frame.groupBy(category).agg(F.count(F.lit(1)).alias(name))
    names = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in categories])).alias("ord", category))
    before, after = (F.coalesce(c, F.lit(0).cast("bigint")) for c in ("before", "after"))
    action = F.when(before == 0, "skipped").when(before > after, "undersampled").when(before < after, "oversampled").otherwise("kept")
    return names.join(size(df, "before"), category, "left").join(size(balanced, "after"), category, "left").select(
        category, "ord", before.alias("before"), after.alias("after"), action.alias("action"))


# --- clean test set -------------------------------------------------------------------
def clean_test(test: DataFrame, train: DataFrame, text: str = "text") -> DataFrame:
    """Test rows whose text does not occur in train.

    The texts that occur in both are found between distinct hashes, where a text that
    fills much of a table is one row.  There are normally few of them, and then the test
    rows stay where they are; otherwise the join is shuffled, and AQE splits a hot text,
    as it may on the left of an anti join.
    """
    hashes = lambda df: df.select(F.sha2(text, 256).alias("_text_hash")).distinct()
    leaked, few = pin_if_small(hashes(test).join(hashes(train), "_text_hash", "left_semi"))
    hashed = test.withColumn("_text_hash", F.sha2(text, 256))
    return hashed.join(broadcast_if(few, leaked), "_text_hash", "left_anti").drop("_text_hash")


def union_picks(*frames: DataFrame) -> DataFrame:
    """All rows of several samples with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)
