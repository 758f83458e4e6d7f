"""Collocations against a plain count of all phrases, and the trie against a dictionary."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

pytest.importorskip("safelabel.llm")

from safelabel.llm import collocations as co  # noqa: E402

SPEC = "doc_id long, text string, lang string"


def plain(rows, least, longest, cover, top):
    counts = defaultdict(Counter)
    totals = Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            w = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {}
        for p, a in cands.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    covered[p[i : i + size]] = max(covered.get(p[i : i + size], 0), a)
        kept = []
        for p, a in cands.items():
            if 100 * covered.get(p, 0) < cover * a:
                score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((" ".join(p), a, left, right, totals[lang], score))
        kept.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        out += [(lang, i + 1, *x) for i, x in enumerate(kept[:top])]
    return sorted(out)


def rows_of(frame):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


def corpus(rng):
    words = ["a", "The", "the", "é", "ü x", "x\x00", "x", "b\x1fc", "w" * 70, "W" * 70, "v" * 65, "￿y", co.CODE + "0" * 32, "of", "wine", "red"]
    gaps = [" ", "  ", "\t", " \t ", ".", ", ", "\n", "\r\n", "\x0b", "; "]
    rows = []
    for i in range(60):
        text = rng.choice(["", " ", ". "])
        for _ in range(rng.randrange(120)):
            text += rng.choice([rng.choice(words), "red wine of", "The x"]) + rng.choice([" "] * 8 + gaps)
        rows.append((i, text, rng.choice(["en", "en", "en", None, "und", "é x"])))
    return rows + [(70, None, "en"), (71, "", None), (72, "alone here", "zz"), rows[0], rows[0]]


@pytest.mark.parametrize("settings", [{}, {"GROUP_BYTES": 200, "TRIE_BYTES": 60, "FLUSH_WORDS": 5, "FLUSH_HASHES": 9, "FAN": 2, "RANK_GROUP": 7, "FILTER_BITS": 1 << 16}])
def test_collocations_equal_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(co, name, value)
    cloudpickle.register_pickle_by_value(co)
    try:
        rows = corpus(random.Random(9))
        frame = spark.createDataFrame(rows, SPEC).withColumn("phrase", F.lit("clash")).withColumn("n", F.lit(1)).repartition(9)
        assert rows_of(co.collocations(frame, least=3, longest=4 if settings else 3, top=25)) == plain(rows, 3, 4 if settings else 3, 50, 25)
    finally:
        cloudpickle.unregister_pickle_by_value(co)


def test_products_beyond_64_bits(spark):
    levels = [spark.createDataFrame([("en", "x", 3 * 10**11), ("en", "y", 10**12)], "lang string, phrase string, n long"),
              spark.createDataFrame([("en", "x y", 2 * 10**11)], "lang string, phrase string, n long")]
    assert co.scored(levels).first().score == 10**6 * (2 * 10**11) ** 2 // (3 * 10**11 * 10**12)


def test_no_rows(spark):
    assert co.collocations(spark.createDataFrame([], SPEC)).count() == 0
    assert co.collocations(spark.createDataFrame([(1, None, None), (2, "a b c", "en")], SPEC)).count() == 0


def test_double_array_holds_exactly_its_phrases():
    rng = random.Random(1)
    phrases = sorted({bytes(rng.choice(b"abc\x00\xc3\xff") for _ in range(rng.randrange(1, 9))) + b" " + bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 6))) for _ in range(3_000)})
    trie = co.DoubleArray.of(phrases)

    def find(text):
        state = 0
        for c in text:
            follow = int(trie.base[state]) + c
            if trie.check[follow] != state:
                return None
            state = follow
        return int(trie.accept[state])

    assert [find(p) for p in phrases] == list(range(len(phrases)))
    known = set(phrases)
    assert all(find(p[:-1]) in (None, -1) for p in phrases if p[:-1] not in known)
    assert all(find(p + b"z") is None for p in phrases)
    one = co.DoubleArray.of([b"only one"])
    assert len(one.accept) and one.accept.max() == 0


def test_blocks_end_between_pieces(monkeypatch):
    monkeypatch.setattr(co, "GROUP_BYTES", 30)
    texts = ["one two three. four five six seven eight nine ten, eleven " * 3, "x"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "text": texts})
    blocks = [b for _, b in co.streams([batch])]
    assert len(blocks) > 3 and sum((b.words() for b in blocks), []) == [w.strip(".,").encode() for t in texts for w in t.split()]
