"""Operators of safelabel.llm against brute force, round trips and held-out rows, with the odd rows of each."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

pytest.importorskip("safelabel.llm")

from safelabel.llm import chat, decontamination, graph, html_text, jaccard_join, licenses, packing, quality, sharding, suffix_dedup, toxicity  # noqa: E402
from safelabel.llm.hashing import shingle_sets, word_hashes  # noqa: E402
from safelabel.llm.queries import QUERIES, _tokenizer_path  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "ONE  two"), (905, "x" * 300_000), (906, "é ü ß word " * 3000), (None, "no id here")]


@pytest.fixture
def set_in_tasks(monkeypatch):
    """Sets a module's constants here and in the tasks, which else import the module anew."""
    sent = []

    def put(module, **values):
        for name, value in values.items():
            monkeypatch.setattr(module, name, value)
        cloudpickle.register_pickle_by_value(module)
        sent.append(module)

    yield put
    for module in sent:
        cloudpickle.unregister_pickle_by_value(module)


def docs(spark, rows, spec="doc_id long, text string"):
    return spark.createDataFrame([(i, t) for i, t in rows], spec)


def shingle_set(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    name = {i: i for i in sets}

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and (both := len(sets[a] & sets[b])) and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                name[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited(rng, sizes, copies):
    rows = []
    for size in sizes:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size + 4)]
        for c in range(copies):
            own = list(base)
            for _ in range(c % 7):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own[: max(1, int(len(own) * rng.choice([1, 1, 0.76, 0.75]))) ])))
    return rows


def test_words_and_shingles_are_exact():
    texts = ["A b\tC", None, "", "a b c", "ABC abc", "é É"]
    words, offsets = word_hashes(texts)
    assert np.diff(offsets).tolist() == [len(WORD.findall(t or "")) for t in texts]
    assert words[offsets[4]] == words[offsets[4] + 1] and words[offsets[5]] != words[offsets[5] + 1]
    long = " ".join(str(i % 977) for i in range(400_000))
    values, at = shingle_sets([long, "a b", "A  B"])
    assert at[1] == 977 and (values[at[1] : at[2]] == values[at[2] : at[3]]).all()


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (5, 5), (8, 7), (2, 1)] + [(100, k) for k in range(101, 400)] + [(k, k + 1) for k in range(1000, 1040)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert {got[k] for k in (1, 2, 3)} == {1} and {got[k] for k in (7, 8, 9)} == {7} and 5 not in got
    assert {got[k] for k in range(101, 400)} == {100} and {got[k] for k in range(1000, 1041)} == {1000}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_jaccard_join_equals_brute_force(spark):
    rng = random.Random(4)
    rows = edited(rng, [1, 2, 3, 4, 5, 7, 8, 9, 12, 15, 16, 24, 33, 50, 63, 64, 70, 130, 300], 12) + ODD[:5]
    # One passage in many texts, and one large group of near copies.
    passage = " ".join(f"p{k}" for k in range(40))
    rows += [(2000 + k, f"{passage} " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(30))) for k in range(90)]
    rows += [(3000 + k, " ".join(f"n{j if rng.random() > 0.05 else rng.randrange(10**6)}" for j in range(60))) for k in range(90)]
    rows.append(rows[0])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_copies(docs(spark, rows + ODD[5:])).collect()}
    want = brute_components(rows)
    assert {k: got[k] for k in want} == want and None not in got
    assert jaccard_join.near_copies(docs(spark, [])).count() == 0


@pytest.mark.parametrize("long", [2_048, 30])
def test_jaccard_join_with_split_groups(spark, set_in_tasks, long):
    set_in_tasks(jaccard_join, HEAVY=3, PAIRS_UP_TO=2, BLOCK_MEMBERS=4, FLUSH_TOKENS=2_000, LONG=long)
    rows = edited(random.Random(8), [5, 9, 20, 40, 90], 25)
    frame = docs(spark, rows).withColumn("component", F.lit("clash")).withColumn("g", F.lit(1))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_copies(frame).collect()} == brute_components(rows)
    kept = jaccard_join.keep_one(frame)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {c for _, c in brute_components(rows).values()}


def brute_removal(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[k : k + length] for _, d in data for k in range(len(d) - length + 1))
    out = []
    for i, d in data:
        mark = np.zeros(len(d), bool)
        for k in range(len(d) - length + 1):
            if seen[d[k : k + length]] > 1:
                mark[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], mark.view(np.int8)])) == 1).sum())
        out.append((i, len(d), int(mark.sum()), runs, hashlib.sha256(np.frombuffer(d, np.uint8)[~mark].tobytes()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("settings", [{}, {"PIECE": 70}, {"HOT_BYTES": 100}, {"BUCKET_BYTES": 300}])
def test_suffix_dedup_equals_brute_force(spark, set_in_tasks, settings):
    set_in_tasks(suffix_dedup, **settings)
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, whole = text(120), text(300)
    rows = [(i, text(rng.randrange(150)) + (passage[rng.randrange(60) :] if i % 3 else "") + text(rng.randrange(40))) for i in range(40)]
    rows += [(50, whole), (51, whole), (51, whole), (52, whole[:100] + "X" + whole[101:]), (53, "y" * 200), (54, "ab" * 90), (55, None), (56, ""), (57, "z" * 50)]
    got = suffix_dedup.removal_report(docs(spark, rows), 50)
    assert sorted(tuple(r) for r in got.collect()) == brute_removal(rows, 50)


@pytest.mark.parametrize("settings", [{}, {"PIECE": 70}, {"HOT_BYTES": 100}])
def test_suffix_dedup_reports_shorter_passages(spark, set_in_tasks, settings):
    set_in_tasks(suffix_dedup, **settings)
    rng = random.Random(7)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [text(n) for n in (36, 48, 52, 61, 90)]
    rows = [(i, text(rng.randrange(60)) + passages[i % 5] + text(rng.randrange(40)) + passages[i % 3]) for i in range(30)]
    rows += [(40, "ab" * 60), (41, text(80)), (42, rows[3][1]), (43, None), (44, passages[2])]
    got = sorted(tuple(r) for r in suffix_dedup.removal_report(docs(spark, rows), 60, 40).collect())
    assert [r[:5] for r in got] == brute_removal(rows, 60)
    assert [r[5] for r in got] == [r[2] for r in brute_removal(rows, 40)] != [r[2] for r in got]


def test_suffix_dedup_keeps_columns_and_odd_rows(spark):
    rows = [(1, "é" * 300, "x"), (2, "a" + "é" * 300, "x"), (3, None, "x"), (None, "é" * 300, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string").withColumn("n_chars", F.length("text").cast("long"))
    out = suffix_dedup.remove_repeats(frame)
    assert out.columns == frame.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(1, "", 0), (2, "a", 1), (3, None, None), (None, "", 0)}
    assert suffix_dedup.removal_report(docs(spark, [])).count() == 0


def test_suffix_dedup_tells_rows_of_one_id_apart(spark):
    rows = [(7, "x" + "ab" * 300), (7, "sixteen bytes ok"), (8, "ab" * 300), (None, "only here " * 3)]
    frame = docs(spark, rows).withColumn("_spans", F.lit("clash")).withColumn("SPANS", F.lit(1)).withColumn("spans_row", F.lit(2)).withColumn("n_chars", F.lit(0).cast("long"))
    got = sorted((r.n_bytes, r.n_removed) for r in suffix_dedup.removal_report(frame).collect())
    assert got == [(16, 0), (30, 0), (600, 600), (601, 600)]
    out = suffix_dedup.remove_repeats(frame)
    assert out.columns == frame.columns and sorted(r.text for r in out.collect()) == ["", "only here " * 3, "sixteen bytes ok", "x"]


def test_filters_keep_clashing_columns_and_odd_rows(spark):
    long = " ".join(f"w{k}" for k in range(40))
    rows = [(1, long, "en", "s", 3), (2, long, "en", "s", 3), (None, long, None, None, None), (3, None, "en", "s", 3), (4, "", "en", "s", 3)]
    frame = spark.createDataFrame(rows, DOCS).withColumn("rejected_id", F.lit(1)).withColumn("kept_id", F.lit(1))
    kept = jaccard_join.keep_one(frame)
    assert kept.columns == frame.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    judged = quality.keep(frame)
    assert judged.columns == frame.columns and {r.doc_id for r in judged.collect()} <= {1, 2, None}


def test_run_index_marks_equal_plain_search():
    rng = random.Random(2)
    for _ in range(20):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 60))) for _ in range(6)] + [b"a" * 30]
        index = suffix_dedup.RunIndex(parts)
        assert int(index.runs.sum()) == index.n
        low, high = index.long_matches(5)
        got = {p for a, b in zip(low, high) for p in range(a, b)}
        seen = Counter(p[k : k + 5] for p in parts for k in range(len(p) - 4))
        assert got == {s + k for s, p in zip(index.starts.tolist(), parts) for k in range(len(p) - 4) if seen[p[k : k + 5]] > 1}


def test_run_index_leaves_out_short_matches():
    parts = [b"abcdefgh" * 4, b"xyabcdefgh", b"abcdefghabcdefghz", b""]
    whole, cut = suffix_dedup.RunIndex(parts), suffix_dedup.RunIndex(parts, 9)
    assert [x.tolist() for x in cut.long_matches(9)] == [x.tolist() for x in whole.long_matches(9)]
    assert min(c for c in (*cut.before[1], *cut.after[1]) if c) >= 9 > min(c for c in whole.before[1] if c)


def test_short_phrases_do_not_share_anchors():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    phrases = [text(60) for _ in range(5)]
    data = [" ".join(text(80) + rng.choice(phrases) for _ in range(30)).encode() for _ in range(20)]
    got = suffix_dedup.segments(np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(d) for d in data]), 400)
    assert got["anchor"].is_unique  # no 400 bytes recur, so nothing is left to index


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(3)
    items = [(k, " ".join(f"w{rng.randrange(9999)}" for _ in range(n))) for k, n in enumerate([1, 4, 5, 6, 9, 20, 36, 60, 130, 300])] + [(20, None), (21, ""), (5, "same id again here now")]
    noise = lambda n: " ".join(f"z{rng.randrange(9999)}" for _ in range(n))
    rows = []
    for k, text in items[:10]:
        words = text.split()
        rows += [(100 + 10 * k, text), (101 + 10 * k, f"{noise(3000)} {text.upper()}\n{noise(50)}"), (102 + 10 * k, f"{noise(40)} {' '.join(words[: int(len(words) * 0.85)])} {noise(9)}"),
                 (103 + 10 * k, f"{noise(40)} {' '.join(words[: len(words) // 2])} {noise(9)}")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.n_shared) for r in decontamination.leaks(docs(spark, rows + ODD), benchmark).collect()}
    want = set()
    for i, t in rows + ODD[:7]:
        own = shingle_set(t)
        for k, text in items:
            if (item := shingle_set(text)) and 100 * len(item & own) >= 75 * len(item):
                want.add((i, k, len(item & own)))
    assert got == want
    left = decontamination.clean(docs(spark, rows + ODD), benchmark)
    assert left.count() == len(rows + ODD) - len({i for i, *_ in want})
    assert decontamination.leaks(docs(spark, rows), benchmark.limit(0)).count() == 0


def test_decontamination_in_blocks_of_items(spark, monkeypatch, sf):
    documents, benchmark = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    whole = {tuple(r) for r in decontamination.leaks(documents, benchmark).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_ITEMS", 7)
    assert {tuple(r) for r in decontamination.leaks(documents, benchmark).collect()} == whole and whole


def test_packing_is_exact_and_tight(spark, sf):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(_tokenizer_path())
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ODD + [(907, "<|endoftext|> 's \n\n x"), (903, "one two")]
    out = packing.packed_sequences(docs(spark, rows), _tokenizer_path()).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for r in by_sequence.values():
        places = sorted((x.offset, x.length) for x in r)
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist() and sum(n for _, n in places) <= 1024
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted((x.start, x.length, x.piece, x.ids_crc32) for x in by_doc[doc])
        pieces = packing.cut(len(ids), 1024)
        want = [(s, n, k, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(pieces)]
        assert own == sorted(want * (2 if doc == 903 else 1))
    total = sum(r.length for r in out)
    assert len(by_sequence) <= 1.01 * total / 1024 + 3
    assert packing.packed_sequences(docs(spark, []), _tokenizer_path()).count() == 0


def test_best_two_fit_replaces_the_smallest():
    assert packing.best_two_fit(np.array([60, 30, 19, 21]), 100) == [[60, 19, 21], [30]]
    assert packing.best_two_fit(np.array([1024 // 2] * 4), 1024) == [[512, 512], [512, 512]]


def test_quality_counts_and_verdicts(spark):
    words = "the of and to in a is that for on".split()
    rng = random.Random(1)
    plain = lambda n: " ".join(rng.choice(words + [f"word{rng.randrange(99)}s", "Lower,"]) for _ in range(n))
    rows = [(k, plain(300), "en") for k in range(30)]
    rows += [(40, " ".join("#$%&*" for _ in range(300)), "en"), (41, plain(300).upper(), "en"), (42, "a b c d e f g h " * 20, "en"), (43, plain(5), "en"),
             (44, None, "en"), (45, "", None), (46, "x\ny\nx\n \n \nx", "xx"), (47, "w" * 200_000, "de")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.judge(frame).collect()}
    for i, text, _ in rows:
        w = WORD.findall(text or "")
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        twice = {p for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(twice)), i
        assert got[i].base_failed == (len(w) < 20 or 100 * len(twice) > 30 * len(w))
    assert all(got[k].kept for k in range(30)) and not any(got[k].kept for k in range(40, 48))
    assert {r.doc_id for r in quality.keep(frame).collect()} == set(range(30))
    assert quality.judge(frame.limit(0)).count() == 0


def test_licenses():
    assert [m[0] for m in licenses.recognise("Some text.\nReleased under the MIT License.\nMore text follows.")] == ["MIT"]
    assert [m[:3] for m in licenses.recognise("\n".join(licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "mit-warranty")))] == [("MIT", "mit-full", 3)]
    # Out of order, the full rule does not match.
    assert [m[1] for m in licenses.recognise("\n".join(licenses.SENTENCES[k][0] for k in ("bsd-binary", "bsd-source", "bsd-grant")))] == []
    assert licenses.recognise("A driving licence is a permission to drive.") == licenses.recognise(None) == licenses.recognise("") == []
    text = "Öl. " * 3 + "Licensed  under the APACHE License, version 2.0.\n\nThis work is licensed under the GNU General Public License, version 3."
    assert [(m[0], text[m[3] : m[4]].split()[0]) for m in licenses.recognise(text)] == [("Apache-2.0", "Licensed"), ("GPL-3.0", "This")]


def test_license_scan_of_odd_rows(spark):
    rows = ODD + [(1, "Licensed under CC BY-NC 4.0."), (1, "Licensed under CC BY-NC 4.0."), (None, "All rights reserved.")]
    assert sorted((r.doc_id or 0, r.license) for r in licenses.scan(docs(spark, rows)).collect()) == [(0, "proprietary"), (1, "CC-BY-NC-4.0"), (1, "CC-BY-NC-4.0")]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x = "</p><p>no";</script></head><body class="has-sidebar">
<header><p>Site name</p></header><nav><ul><li><a href="/">Home</a></ul></nav><div id="cookie-notice">We use cookies, a lot of them.</div>
<div class="main-7"><div class="ad">Buy this.</div><{tag} class="story-{n}"><h1>Head &amp; line</h1><p>First <b>bold</b>
  part<br>goes on.<p>Second &lt;p&gt; 1 < 2.<ul><li>One<li>Two</ul>{more}<form><p>Your mail</p></form></{tag}>
<aside>Read also</aside><section class="comments"><article class="comment"><p>{talk}</p></article></section></div><footer>&copy; all</footer></body></html>"""
TEXT = "Head & line\nFirst bold part goes on.\nSecond <p> 1 < 2.\nOne\nTwo"


def test_html_main_text(spark):
    talk = "I think that this is wrong. " * 30
    rows = [(k, f"https://a.example.org/{k}", PAGE.format(tag="div", n=k, more=f"<p>Own {k}</p>" * 9, talk=talk)) for k in range(6)]
    rows += [(10, "https://b.example.org", PAGE.format(tag="article", n=1, more="", talk="x")), (11, None, "<p>Loose <i>text"), (12, "u", None), (13, "u", ""),
             (14, "u", "<!-- open <p>no</p>"), (15, "https://a.example.org/x", "<body><article>Other shape</article>"), (None, "u", "a < b"), (10, "https://b.example.org", PAGE.format(tag="article", n=1, more="", talk="x"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("winner", F.lit("clash"))
    got = {r.page_id: r for r in html_text.main_texts(frame).collect()}
    for k in range(6):
        assert got[k].text == "\n".join([TEXT, *[f"Own {k}"] * 9])
    assert got[10].text == TEXT and got[10].n_chars == len(TEXT) and got[11].text == "Loose text"
    assert got[12].text == got[13].text == got[14].text == "" and got[15].text == "Other shape" and got[None].text == "a < b"
    assert html_text.main_texts(frame).count() == len(rows) and html_text.main_texts(frame.limit(0)).count() == 0


def test_shards(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ODD + [(5, "same")] * 40
    out = sharding.balanced_shards(docs(spark, rows), 6).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    by_shard, by_group = defaultdict(list), defaultdict(set)
    for r in out:
        by_shard[r.shard].append(r)
        by_group[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(x.slot for x in own) == list(range(len(own))) for own in by_shard.values()) and all(len(g) == 1 for g in by_group.values())
    largest = max(r.size for r in out)
    assert sorted(sum(x.size for x in own) for own in by_shard.values())[-1] <= max(largest * 1.01, sum(r.size for r in out) / 6 * 1.05)
    assert sharding.balanced_shards(docs(spark, []), 6).count() == 0


def test_differencing_balances_bytes():
    rng = random.Random(9)
    sizes = [rng.randrange(1, 10_000) for _ in range(3000)]
    sums = np.bincount(sharding.difference(sizes, 24), sizes, 24)
    assert sums.sum() == sum(sizes) and sums.max() - sums.min() <= 10
    assert sharding.difference([], 3) == [] and sorted(sharding.difference([5, 5], 3)) == [0, 1]


def test_chat_round_trip(spark):
    strings = ["", "plain", "<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|x", "<\\\\|", "a\\<|", "<<||>", "é \r\n", "\\n"]
    rng = random.Random(5)
    for _ in range(300):
        turns = [(rng.choice(["user", "assistant", "system", "", "odd\nrole\\n", "<|im_end|>"]), "".join(rng.choice(strings) for _ in range(3))) for _ in range(4)]
        formatted, spans = chat.render(turns)
        assert chat.parse(formatted) == turns
        assert chat.learned(formatted, spans) == "".join(t for r, t in turns if r == "assistant")
        assert formatted.count("<|im_start|>") == len(turns)
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", None), (3, 0, None, "x"), (3, None, "assistant", "y"), (4, 0, "assistant", "t"), (4, 0, "assistant", "t"), (None, 0, "user", "z")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("record", F.lit("clash"))
    got = {r.conv_id: r for r in chat.read_back(chat.format_records(chat.as_records(frame))).collect()}
    want = {1: [("user", "a"), ("assistant", "b")], 2: [("user", "")], 3: [("assistant", "y"), ("", "x")], 4: [("assistant", "t")] * 2, None: [("user", "z")]}
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_records(chat.as_records(frame.limit(0)))).count() == 0


def test_layouts_are_told_apart():
    known = chat.registry()
    turns = [("user", "q"), ("assistant", "a")]
    for record in ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, {"prompt": "q", "response": "a"},
                   {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"completion": "a", "prompt": "q"}, {"instruction": "q", "input": "", "output": "a"}):
        assert chat.canonical(json.loads(json.dumps(record)), known) == turns
    with pytest.raises(ValueError, match="dialog"):
        chat.canonical({"dialog": ["q"]}, known)


def test_toxicity_chain_on_held_out_rows(spark):
    rng = random.Random(7)
    plain = [f"w{k}" for k in range(400)]
    rows, labels = [], []
    for i in range(1500):
        rude, toxic = rng.random() < 0.3, rng.random() < 0.2
        words = [rng.choice(plain) for _ in range(80)] + ["Blast,"] * rude + [rng.choice(["Nitwit!", "numskulls", "numskully"])] * toxic
        rng.shuffle(words)
        rows.append((10_000 + i, " ".join(words)))
        labels.append((10_000 + i, int(rude), int(toxic)))
    frame = spark.createDataFrame(labels[:900], "doc_id long, rude int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs(spark, rows + ODD), frame, ("rude", "toxic")).collect()}
    held = [(got[i], x, y) for i, x, y in labels[900:]]
    assert np.mean([r.toxic == bool(y) for r, _, y in held]) > 0.97 and np.mean([(r.p_rude > 0.5) == bool(x) for r, x, _ in held]) > 0.97
    assert len(got) == len(rows) + len(ODD) and not got[900].toxic
    none = toxicity.score(docs(spark, rows[:5]), frame.limit(0), ("rude", "toxic"))
    assert {(r.p_toxic < 1e-6, r.toxic) for r in none.collect()} == {(True, False)} and toxicity.score(docs(spark, []), frame, ("rude", "toxic")).count() == 0


def test_chain_uses_earlier_categories_out_of_fold():
    sample = pd.DataFrame({"doc_id": range(90), "text": ["alpha" if i % 3 == 0 else "beta" for i in range(90)], "a": [int(i % 3 == 0) for i in range(90)]})
    sample["b"] = sample["a"]
    first, second = toxicity.fit_chain(sample, ("a", "b"))
    assert len(first.chained) == 0 and len(second.chained) == 1
    assert (toxicity.predict_chain([first, second], ["alpha", "beta", None])[:, 1] > 0.5).tolist() == [True, False, False]


def test_every_query_runs(spark, sf):
    for name, query in QUERIES.items():
        assert query(spark, sf).count() > 0, name


def test_pipeline_equals_its_parts_by_brute_force(spark, sf):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    verdict = {r.doc_id: r.kept for r in quality.judge(documents).collect()}
    rows = [(r.doc_id, r.text) for r in documents.collect() if verdict[r.doc_id]]
    groups = brute_components(rows)
    rows = [(i, t) for i, t in rows if groups[i][1] == i]
    size = corpus_pipeline.REPEAT_BYTES
    seen = Counter(d[k : k + size] for _, t in rows for d in [t.encode()] for k in range(len(d) - size + 1))
    cut = []
    for i, t in rows:
        d = np.frombuffer(t.encode(), np.uint8)
        mark = np.zeros(len(d), bool)
        for k in range(len(d) - size + 1):
            if seen[d[k : k + size].tobytes()] > 1:
                mark[k : k + size] = True
        cut.append((i, d[~mark].tobytes().decode("utf-8", "ignore")))
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    left = [(i, t) for i, t in cut for own in [shingle_set(t)] if not any(x and 100 * len(x & own) >= 75 * len(x) for x in items)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(_tokenizer_path())
    want = set()
    for i, t in left:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        want |= {(i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 1024))}
    got = corpus_pipeline.run(spark, sf)
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got.collect()} == want
