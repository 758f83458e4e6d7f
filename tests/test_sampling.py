import pytest
from pyspark.sql import functions as F

from safelabel.operators import sampling as S


def pool(spark, sizes: dict, parts=4):
    rows = [(f"{k}-{i}", k) for k, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "id string, k string").repartition(parts)


def quotas(spark, rows):
    return spark.createDataFrame(rows, "k string, pick string, quota int")


def counts(df, *cols):
    return {tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]]: r["count"] for r in df.groupBy(*cols).count().collect()}


def test_quota_sample_sizes(spark):
    df = pool(spark, {"a": 50, "b": 10, "c": 5})
    out = S.quota_sample(df, quotas(spark, [("a", "x", 20), ("b", "x", 10), ("c", "x", 0)]), ["k"])
    assert counts(out, "k") == {"a": 20, "b": 10}
    assert out.select("id").distinct().count() == 30


def test_quota_short_pool(spark):
    df = pool(spark, {"a": 5})
    for rows in ([("a", "x", 6)], [("missing", "x", 1)], [("a", "x", 3), ("a", "y", 3)]):
        with pytest.raises(S.ShortPool):
            S.quota_sample(df, quotas(spark, rows), ["k"], pick="pick")
    out = S.quota_sample(df, quotas(spark, [("a", "x", 3), ("a", "y", 3)]), ["k"], pick="pick", on_short="all")
    assert counts(out, "pick") == {"x": 3, "y": 2}


def test_many_quotas_take_the_same_rows(spark, monkeypatch):
    """Past the broadcast limit the quotas stay a table, with the same result."""
    df, q = pool(spark, {"a": 60, "b": 20}), quotas(spark, [("a", "x", 7), ("a", "y", 9), ("b", "x", 20)])
    draw = lambda: sorted((r.id, r.pick) for r in S.quota_sample(df, q, ["k"], pick="pick").collect())
    pinned = draw()
    monkeypatch.setattr(S, "pin_if_small", lambda frame: (frame, False))
    assert draw() == pinned
    with pytest.raises(S.ShortPool):
        S.quota_sample(df, quotas(spark, [("b", "x", 21)]), ["k"])


def test_two_quotas_on_one_key_are_disjoint(spark):
    df = pool(spark, {"a": 40})
    out = S.quota_sample(df, quotas(spark, [("a", "x", 7), ("a", "y", 9), ("a", "z", -1)]), ["k"], pick="pick")
    assert counts(out, "pick") == {"x": 7, "y": 9}
    assert out.select("id").distinct().count() == 16


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_same_seed_same_rows_whatever_the_partitions(spark):
    q = quotas(spark, [("a", "x", 30), ("b", "x", 7)])
    pools = [pool(spark, {"a": 100, "b": 20}, parts) for parts in (1, 8)]
    runs = [ids(S.quota_sample(p, q, ["k"], 5)) for p in pools]
    assert runs[0] == runs[1] != ids(S.quota_sample(pools[0], q, ["k"], 6))
    assert ids(S.sample_n(pools[0], 11)) == ids(S.sample_n(pools[1], 11))


@pytest.mark.parametrize("n,train", [(1, 1), (2, 1), (3, 2), (10, 9), (101, 90)])
def test_ratio_split(spark, n, train):
    out = S.ratio_split(pool(spark, {"a": n}), 0.9)
    assert counts(out, "split") == {k: v for k, v in (("train", train), ("test", n - train)) if v}
    assert out.select("id").distinct().count() == n


def test_ratio_split_of_nothing(spark):
    with pytest.raises(ValueError):
        S.ratio_split(pool(spark, {"a": 1}).filter("false"), 0.9)


@pytest.mark.parametrize("n,kept", [(None, 10), (0, 0), (4, 4), (10, 10), (99, 10)])
def test_sample_n(spark, n, kept):
    assert S.sample_n(pool(spark, {"a": 10}), n).count() == kept


def test_cuts_do_not_depend_on_the_ranges(spark, monkeypatch):
    df, q = pool(spark, {"a": 900, "b": 300}), quotas(spark, [("a", "x", 401), ("a", "y", 77), ("b", "x", 300)])
    draw = lambda: sorted((r.id, r.pick) for r in S.quota_sample(df, q, ["k"], 3, pick="pick").collect())
    plain = draw()
    assert len(plain) == 778
    monkeypatch.setattr(S, "RANGE_DIGITS", 1)  # ranges of dozens of rows
    assert draw() == plain
    monkeypatch.setattr(S, "RANK_ROWS", 2)  # split further before ranking
    assert draw() == plain


def test_balance(spark):
    df = pool(spark, {"S1": 30, "S2": 8, "S3": 3, "S4": 1, "other": 50})
    out = S.balance(df, "k", 8)
    assert counts(out, "k") == {"S1": 8, "S2": 8, "S3": 8, "S4": 8}
    assert out.filter("k IN ('S1', 'S2')").select("id").distinct().count() == 16
    assert out.groupBy("id", "draw").count().filter("count > 1").count() == 0
    again = S.balance(df.repartition(1), "k", 8)
    assert ids(out) == ids(again)


def test_oversampling_in_blocks_is_the_same(spark, monkeypatch):
    df = pool(spark, {"S1": 3, "S2": 5})
    one = ids(S.balance(df, "k", 50))
    monkeypatch.setattr(S, "DRAW_BLOCK", 7)
    assert ids(S.balance(df, "k", 50)) == one


def test_clean_test(spark, monkeypatch):
    train = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "text string")
    test = spark.createDataFrame([(1, "a"), (2, "c"), (3, "c"), (4, None)], "id int, text string")
    assert sorted(r.id for r in S.clean_test(test, train).collect()) == [2, 3, 4]
    monkeypatch.setattr(S, "pin_if_small", lambda df: (df, False))
    assert sorted(r.id for r in S.clean_test(test, train).collect()) == [2, 3, 4]


def test_shuffle_orders_by_hash(spark):
    rows = [r.id for r in S.shuffle(pool(spark, {"a": 50}), 3).collect()]
    assert rows != sorted(rows)
    copies = spark.range(10).selectExpr("id", "explode(sequence(1, 30)) AS draw")
    order = [r.id for r in S.shuffle(copies, 3, "id", "draw").collect()]
    assert sum(a == b for a, b in zip(order, order[1:])) < 100  # copies are not kept together
    assert rows == [r.id for r in S.shuffle(pool(spark, {"a": 50}, 1), 3).collect()]


def test_one_hot_key_is_never_gathered(spark):
    """Ranking happens within one hash range of a key only."""
    df = pool(spark, {"hot": 5000, "b": 10})
    q = quotas(spark, [("hot", "x", 1234)])
    out = S.quota_sample(df, q, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1234 and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    largest = S.hash_ranges(df, ["k"], 42, "id").agg(F.max("_rows")).first()[0]
    assert largest <= 12


def test_repeated_ids_raise_where_they_matter(spark):
    twice = pool(spark, {"a": 30}).select(F.lit("same").alias("id"), "k")
    with pytest.raises(Exception, match="row ids repeat"):
        S.quota_sample(twice, quotas(spark, [("a", "x", 7)]), ["k"]).collect()
    with pytest.raises(Exception, match="row ids repeat"):
        S.balance(twice, "k", 50, categories=["a"]).collect()


def test_ids_of_several_columns(spark):
    rows = spark.createDataFrame([(i, lang, "a") for i in range(20) for lang in ("bn", "kn", "ml")], "id int, lang string, k string")
    for n in (10, 30, 90):
        out = S.balance(rows, "k", n, id_col=["id", "lang"], categories=["a"])
        assert out.count() == n and out.select("id", "lang", "draw").distinct().count() == n
    assert S.sample_n(rows, 31, id_col=["id", "lang"]).count() == 31


def test_copies_of_one_row_are_made_in_many_tasks(spark):
    out = S.balance(pool(spark, {"a": 1}), "k", 1_000_000, categories=["a"])
    tasks = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in tasks) == 1_000_000 and len(tasks) > 1
    assert out.select("draw").distinct().count() == 1_000_000
