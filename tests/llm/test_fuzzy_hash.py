"""Fingerprints and the neighbour report against plain versions, byte by byte."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("safelabel.llm")

from safelabel.llm import fuzzy_hash as fh  # noqa: E402
from safelabel.llm.hashing import mix  # noqa: E402

M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def plain_fingerprint(data):
    roll, shift, piece = fh._ROLL.tolist(), fh._SHIFT.tolist(), fh._PIECE.tolist()

    def ends(size):
        out = []
        for i in range(len(data)):
            v = 0
            for k in range(7):
                if i >= k:
                    v = (v + roll[data[i - k]] * shift[k]) & M32
            v ^= v >> 15
            v = v * 0x2C1B3C6D & M32
            v ^= v >> 12
            if v % size == size - 1:
                out.append(i + 1)
        return out

    def signature(cuts):
        if data and (not cuts or cuts[-1] < len(data)):
            cuts = [*cuts, len(data)]
        text = ""
        for a, b in zip([0, *cuts], cuts):
            h = sum(piece[data[i]] * pow(fh._RADIX, i - a, 1 << 64) for i in range(a, b)) & M64
            text += fh.SYMBOLS[int(mix(np.array([(h + b - a) & M64], np.uint64))[0]) >> 58]
        return text

    size = 3
    while len(ends(size)) >= 64:
        size *= 2
    return f"{size}:{signature(ends(size))}:{signature(ends(2 * size))}" if data else "3::"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_likeness(f, g):
    if f == g:
        return 1.0
    a, b = ({int(x[0]): x[1], 2 * int(x[0]): x[2]} for x in (f.split(":"), g.split(":")))
    common = sorted(set(a) & set(b))
    if not common:
        return 0.0
    x, y = a[common[0]], b[common[0]]
    width = min(5, (min(len(x), len(y)) + 1) // 2)
    if not width or not {x[i : i + width] for i in range(len(x) - width + 1)} & {y[i : i + width] for i in range(len(y) - width + 1)}:
        return 0.0
    return 1 - plain_distance(x, y) / max(len(x), len(y))


def texts(rng):
    letters = "abcdefghij é ß\n"
    out = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 9, 60, 300, 1500]))) for _ in range(30)]
    return out + [None, "", "x" * 2000, "ab" * 700, out[3], out[3], out[5] + " and more"]


def test_fingerprint_equals_plain_version():
    for text in texts(random.Random(1)):
        data = (text or "").encode()
        assert fh.fingerprint(data) == plain_fingerprint(data)


def test_blocks_do_not_matter(monkeypatch):
    rng = random.Random(2)
    data = bytes(rng.randrange(256) for _ in range(30_000))
    whole = fh.fingerprint(data)
    monkeypatch.setattr(fh, "BLOCK", 1_000)
    monkeypatch.setattr(fh, "_powers", None)
    assert fh.fingerprint(data) == whole and len(whole.split(":")[1]) in range(20, 65)


def test_distances_and_likeness_equal_plain_versions():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice(fh.SYMBOLS[: rng.choice([2, 64])]) for _ in range(n))
    pairs = [(word(rng.randrange(65)), word(rng.randrange(65))) for _ in range(300)] + [("", ""), ("A", "A"), (word(64), word(64))]
    pairs += [(a, a[:10] + a[12:]) for a, _ in pairs]
    assert fh.edit_distances(pairs).tolist() == [plain_distance(a, b) for a, b in pairs]
    prints = [fh.fingerprint((t or "").encode()) for t in texts(rng)]
    left, right = prints, prints[1:] + prints[:1]
    assert fh.likeness(left, right) == [plain_likeness(a, b) for a, b in zip(left, right)]


def plain_report(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        own, other, next_ = (plain_fingerprint(x.encode()) for x in (text, edited, following))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, other, plain_likeness(own, other), plain_likeness(own, next_)))
    return out


@pytest.mark.parametrize("range_bytes", [100, 1_000, 1 << 22])
def test_report_equals_plain_version(spark, range_bytes):
    rows = list(zip([50, -4, *range(100, 130), None, 7, 7, 7, 1 << 40], texts(random.Random(4)), strict=False))
    rows.append(rows[3])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumn("range", F.lit("clash")).withColumn("extra", F.lit(1))
    got = [tuple(r) for r in fh.neighbour_report(frame, range_bytes).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(plain_report(rows), key=key)


def test_odd_tables(spark):
    spec = "doc_id long, text string"
    assert fh.neighbour_report(spark.createDataFrame([], spec)).count() == 0
    one = fh.neighbour_report(spark.createDataFrame([(None, "alone in the table")], spec)).collect()
    assert one[0].doc_id is None and one[0].near_next == 1.0
    kept = fh.with_fingerprints(spark.createDataFrame([(1, "a b c", 9)], "doc_id long, text string, fingerprint int"))
    assert kept.columns == ["doc_id", "text", "fingerprint"] and kept.first().fingerprint == fh.fingerprint(b"a b c")


def test_likeness_tells_edits_from_other_texts(spark, sf):
    got = fh.neighbour_report(spark.read.parquet(f"{sf}/documents.parquet")).where("n_chars > 300").agg(
        F.avg("near_edited").alias("edited"), F.avg("near_next").alias("following"), F.min("near_edited").alias("least")).first()
    assert got.edited > 0.6 and got.following < 0.2
