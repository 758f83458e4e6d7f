"""Lexicons by rarest grams against plain comparison of all terms, and language profiles."""

import random

from pyspark.sql import functions as F

from safelabel.functions import trie
from safelabel.functions.lexicon import grams
from safelabel.operators import profanity
from safelabel.operators.language import fit_language_profiles, tag_by_profile
from tests.helpers import column, physical


def terms_of(rng):
    letters = "abé𝒳 "
    terms = {(rng.choice(["en", "fr"]), "".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 12])))) for _ in range(150)}
    return sorted(terms | {("en", "x" * 10_000), ("en", "x" * 9_999 + "y"), ("de", "xy")})


def test_grams_are_linear_runs_of_code_points(spark):
    got = column(spark, ["ab𝒳é", "a", "", None], lambda x: F.array_join(grams(x, 1, 2), "|"))
    assert got == ["a|b|𝒳|é|ab|b𝒳|𝒳é", "a", "", ""]


def test_minimised_terms_equal_plain_search(spark):
    terms = terms_of(random.Random(3))
    frame = spark.createDataFrame(terms + terms[:20] + [("fr", None)], "language string, term string")
    want = {(lang, t) for lang, t in terms if not any(o == lang and u != t and u in t for o, u in terms)}
    got = [tuple(r) for r in profanity.minimise_lexicon(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    with_empty = spark.createDataFrame([("en", ""), ("en", "a"), ("fr", "ab")], "language string, term string")
    assert {tuple(r) for r in profanity.minimise_lexicon(with_empty).collect()} == {("en", ""), ("fr", "ab")}
    assert profanity.minimise_lexicon(spark.createDataFrame([], "language string, term string")).count() == 0


def test_short_terms_strike_out_before_long_ones_are_cut(spark, monkeypatch):
    rng = random.Random(8)
    terms = {("en", "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 12)))) for _ in range(400)} | {("en", "a"), ("en", "bc"), ("en", "efg"), ("fr", "b")}
    posted, given = profanity.term_postings, []

    def recorded(some):
        given.extend(tuple(r) for r in some.select("language", "term").collect())
        return posted(some)

    monkeypatch.setattr(profanity, "term_postings", recorded)
    got = {tuple(r) for r in profanity.minimise_lexicon(spark.createDataFrame(sorted(terms), "language string, term string")).collect()}
    assert got == {(lang, t) for lang, t in terms if not any(o == lang and u != t and u in t for o, u in terms)}
    assert sorted(given) == sorted((lang, t) for lang, t in terms if len(t) > 3 and not any(o == lang and u in t for o, u in [("en", "a"), ("en", "bc"), ("en", "efg")]))


def test_term_hits_equal_plain_search(spark):
    rng = random.Random(4)
    terms = terms_of(rng)
    rows = [(i, rng.choice(["en", "fr", "de", None]), "".join(rng.choice("abé𝒳 x") for _ in range(rng.randrange(60)))) for i in range(80)]
    rows += [(90, "en", None), (91, "en", ""), (92, "en", "y" + "x" * 10_000)]
    texts = spark.createDataFrame(rows, "id int, language string, text string")
    lexicon = spark.createDataFrame(terms + [("en", "")], "language string, term string")
    hits = profanity.term_hits(texts, lexicon, place="place")
    got = sorted((r.id, r.term, r.place) for r in hits.collect())
    assert got == sorted((i, t, text.index(t)) for i, lang, text in rows if text for o, t in terms if o == lang and t in text)
    assert "SortMergeJoin" not in physical(hits)
    assert profanity.term_hits(texts, lexicon.limit(0)).count() == 0


def test_a_lexicon_too_large_for_broadcast_gives_the_same(spark, monkeypatch):
    terms = terms_of(random.Random(5))
    texts = spark.createDataFrame([(i, "en", "ab aé𝒳b " * i) for i in range(9)], "id int, language string, text string")
    lexicon = spark.createDataFrame(terms, "language string, term string")
    want = sorted(tuple(r) for r in profanity.term_hits(texts, lexicon).collect())
    monkeypatch.setattr(profanity, "pin_if_small", lambda df: (df, False))
    assert sorted(tuple(r) for r in profanity.term_hits(texts, lexicon).collect()) == want


def test_language_profiles_tag_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", F.col("lang").alias("language"))
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "", "en"), (-3, "漢字漢字", "en")], "doc_id long, text string, language string")
    held_out = F.col("doc_id") % 3 == 0
    profiles = fit_language_profiles(docs.filter(~held_out).union(odd), ["en", "fr", "de", "es"])
    rows = docs.filter(held_out).union(odd).join(tag_by_profile(docs.filter(held_out).union(odd), profiles, "doc_id"), "doc_id").collect()
    told = [r for r in rows if r.doc_id >= 0]
    assert sum(r.tag == r.language for r in told) >= 0.95 * len(told)
    assert {r.tag for r in rows if r.doc_id < 0} == {"unknown"} and all(r.known == 0 for r in rows if r.doc_id < 0)
    assert fit_language_profiles(docs.limit(0), ["en"]).count() == 0


def test_gathered_hits_equal_plain_search_without_grams_on_rows(spark, monkeypatch):
    rng = random.Random(6)
    terms = terms_of(rng) + [("fr", t) for t in ("\t", "a b", "x\ny", "漢字", "漢")] + [(None, "a")]
    rows = [(i, rng.choice(["en", "fr", None]), "".join(rng.choice("abé𝒳 x\t\n漢字") for _ in range(rng.randrange(90)))) for i in range(300)]
    rows += [rows[3], (None, "fr", "a b"), (-1, "fr", None), (-2, "fr", ""), (-3, "zz", "ab"), (-4, "en", "é" * 300_000 + "x" * 10_000)]
    texts = spark.createDataFrame(rows, "id int, language string, text string")
    lexicon = spark.createDataFrame(terms + terms[:9] + [("en", None)], "language string, term string")
    own = lambda lang: {t for o, t in terms if o == lang and t and lang}
    want = sorted((str(i), lang, len(text), sorted((t, text.index(t)) for t in own(lang) if t in text)) for i, lang, text in rows if text)
    want = [w for w in want if w[3]]

    def gathered():
        hits = profanity.term_hits(texts, lexicon, gather="hits")
        assert hits.columns == ["id", "language", "text", "hits"]
        return hits, sorted((str(r.id), r.language, len(r.text), sorted(map(tuple, r.hits))) for r in hits.collect())

    hits, got = gathered()
    assert got == want and "explode" not in physical(hits) and "Exchange" not in physical(hits)
    assert sorted((str(r.id), r.term) for r in profanity.term_hits(texts, lexicon).collect()) == sorted((w[0], t) for w in want for t, _ in w[3])
    monkeypatch.setattr(profanity, "pin_if_small", lambda df: (df, False))
    texts, want = texts.filter("id > -4 or id is null"), [w for w in want if w[0] != "-4"]
    assert gathered()[1] == want


def test_first_places_of_long_texts_and_colliding_keys(monkeypatch):
    monkeypatch.setattr(trie, "WALKERS", 7)
    rng = random.Random(7)
    for letters in ("ab", "aé漢𝒳"):
        terms = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(60)})
        texts = ["".join(rng.choice(letters + " ") for _ in range(rng.randrange(40))) for _ in range(30)]
        text, term, place = trie.TermTrie(terms).first_places([t.encode() for t in texts])
        got = {(int(i), terms[t], int(p)) for i, t, p in zip(text, term, place)}
        assert len(got) == len(text) and got == {(i, t, x.index(t)) for i, x in enumerate(texts) for t in terms if t in x}
