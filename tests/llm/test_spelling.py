"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

pytest.importorskip("safelabel.llm")

from safelabel.llm import spelling  # noqa: E402

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_words(rows, least=5, count=3, every=97):
    total = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += len(run) >= least
    return {w: n for w, n in total.items() if n >= count}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, every=97):
    words = plain_words(rows, every=every)
    close = defaultdict(list)
    for a in words:
        for b in words:
            if abs(len(a) - len(b)) <= 1 and near(a, b):
                close[a].append(b)
    form = {}
    for w in words:
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w] or "", root(w), n, len(close[w]), words[form[w]] if form[w] else -1) for w, n in words.items())


def rows_of(got):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in got.collect())


def typed(rng, words, n):
    letters = "abcé"
    out = []
    for _ in range(n):
        w = rng.choice(words)
        i = rng.randrange(len(w) + 1)
        out.append(rng.choice([w, w, w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    return out


@pytest.mark.parametrize("every", [97, 3])
def test_variants_equal_brute_force(spark, every):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcÉ") for _ in range(rng.choice([4, 5, 6, 7, 8, 9, 12, 13, 38, 39, 40, 41, 42, 90]))) for _ in range(60)]
    rows = [(i, " ".join(typed(rng, base, 60)).replace("a", rng.choice("aA"))) for i in range(40)]
    rows += [(900, None), (901, ""), (None, "bbbbb bbbbb bbbbb bbbb bbbbbb"), (903, "x" * 3000 + " " + ("x" * 1500 + "y" + "x" * 1499 + " ") * 3), (904, ("x" * 3000 + ".") * 3),
             (905, "aaaaa1aaaaaa×aaaaaa÷Àaaaa àaaaa " * 3), rows[0]]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("node", F.lit(1))
    assert rows_of(spelling.variants(frame, every=every)) == plain_variants(rows, every)


def test_chains_of_forms_and_ties(spark):
    # Counts 3, 6, 12, 24 along one-letter changes; two forms of equal count.
    chain = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "zzzzz": 3, "zzzzy": 7, "zzzzx": 7}
    rows = [(None, f"{w} " * n) for w, n in chain.items()]
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), every=1 << 40).collect()}
    assert got["aaaaa"].root == got["aaaab"].root == "aabbb" and got["aaaaa"].form == "aaaab" and got["aabbb"].form is None
    assert got["zzzzz"].form == "zzzzx" and got["zzzzx"].form is None and got["zzzzx"].n_near == 2


def test_blocks_end_between_words(monkeypatch):
    text = "Ab cd-EFé " * 50
    whole = spelling.runs_of(text)
    monkeypatch.setattr(spelling, "BLOCK", 7)
    assert spelling.runs_of(text) == whole == Counter({"ab": 50, "cd": 50, "efé": 50})


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")).count() == 0


def test_whole_table(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(spelling.variants(documents)) == plain_variants(rows)
