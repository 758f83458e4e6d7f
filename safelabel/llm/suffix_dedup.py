"""Removal of long byte strings that occur again, by run-compressed suffix indexes.

A byte goes if some string of ``length`` bytes that covers it also starts at another place
of the corpus, in the same document or another. Occurrences overlap freely and are judged
on the input. Matches never cross documents.

Steps:
1. Every window of ``length`` bytes has an anchor: the leftmost smallest hash among its
   grams of a quarter of ``length`` bytes, 32 at least. Windows with one anchor form a segment;
   equal windows have equal anchors. Shorter grams would share anchors where no window recurs.
2. Anchors are counted by a combined aggregate. Equal segments are one segment with a count;
   an anchor that occurs once has no repeated window and is done.
3. Distinct segments of an anchor meet in one bucket of bounded size. There a run index is
   built over them: a Burrows-Wheeler transform kept as runs, with the text position and
   the common prefix with the suffix before (after) sampled at run ends. Streaming along the
   text, the longest match of any position elsewhere is that of the last sample less the
   distance from it: matching statistics of the text against all of the rest. Matches of
   ``length`` bytes or more are marked.
4. An anchor with more than ``HOT_BYTES`` of distinct segments is split by window content:
   each of its windows is counted by hash, by a combined aggregate. Nothing is capped.
5. Marks return to all copies of a segment, and the marked bytes are cut out.

Several lengths go through one index: anchors and segments are those of the shortest, and a
segment reaches on as far as the longest, if its text does, so longer matches show as well.

Null and empty texts have no bytes. Each row is a document, whatever its doc_id: rows are told
apart by a 64-bit hash of doc_id and text, and equal rows have equal spans. Extra columns are
kept, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.llm.hashing import batches, encoded, mix, stream
from safelabel.llm.store import broadcast_if_small, fresh_name, named, unnamed, written

_U = np.uint64
GRAM = 32
PIECE = 4 << 20
#: Passages of over 50 words of some five letters, reported beside the bytes removed.
PASSAGE_BYTES = 50 * 6
BUCKET_BYTES = 1 << 20
HOT_BYTES = 2 << 20
BROADCAST_IDS = 200_000
_BYTE = stream(101, 256)
_RADIX = 0xA24BAED4963EE407
_INVERSE = pow(_RADIX, -1, 1 << 64)
_PLACE = _U((1 << 30) - 1)


def _powers(radix: int, n: int) -> np.ndarray:
    out = np.full(n, radix, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


class Prefixes:
    """Hashes of any substring of ``data``, by sums of powers."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(_BYTE[data] * _powers(_RADIX, max(n, 1))[:n], out=self.sums[1:])
        self.inverse = _powers(_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    padded = np.append(x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)).reshape(-1, width)
    left = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(padded, axis=1).ravel()
    return np.minimum(left[:n], right[width - 1 : width - 1 + n])


def segments(data: np.ndarray, ends: np.ndarray, length: int, reach: int = 0) -> pd.DataFrame:
    """Segments of concatenated documents ending at ``ends``: document, first and last window start, size, anchor, print.

    Only the first ``PIECE`` windows of a document count. A segment goes on to ``reach`` bytes from its last window start.
    """
    empty = pd.DataFrame({"d": [], "first": [], "last": [], "size": [], "anchor": [], "print": []}).astype("int64")
    if len(data) < length:
        return empty
    prefixes = Prefixes(data)
    gram = min(max(GRAM, length // 4), length)
    grams = np.arange(len(data) - gram + 1)
    value = prefixes.of(grams, grams + gram)
    low = _sliding_min((value & ~_PLACE) | grams.astype(_U), length - gram + 1) & _PLACE
    place = low.astype(np.int64)
    document = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))[: len(place)]
    origin = np.concatenate([[0], ends[:-1]])
    inside = (np.arange(len(place)) + length <= ends[document]) & (np.arange(len(place)) < origin[document] + PIECE)
    fresh = np.concatenate([[True], (place[1:] != place[:-1]) | ~inside[:-1]]) & inside
    first = np.flatnonzero(fresh)
    if not len(first):
        return empty
    stop = np.flatnonzero(inside & np.concatenate([fresh[1:] | ~inside[1:], [True]]))
    begin = origin[document[first]]
    end = np.minimum(stop + max(length, reach), ends[document[first]])
    return pd.DataFrame({
        "d": document[first], "first": first - begin, "last": stop - begin, "size": end - first,
        "anchor": value[place[first]].astype(np.int64), "print": (prefixes.of(first, end) + mix((stop - first).astype(_U))).astype(np.int64),
    })


def _segment_rows(frames: Iterator[pd.DataFrame], length: int, reach: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts, rows = frame["text"].tolist(), frame["row"].to_numpy()
        for a, b in batches(texts):
            parts = [encoded(t) for t in texts[a:b]]
            # A very long text is taken in pieces; a window lies in the piece that it starts in.
            pieces = [(a + i, at, p[at : at + PIECE + reach - 1]) for i, p in enumerate(parts) for at in range(0, max(len(p), 1), PIECE)]
            for i in range(0, len(pieces), len(pieces) if sum(map(len, parts)) <= PIECE else 1):
                own = pieces[i:] if sum(map(len, parts)) <= PIECE else pieces[i : i + 1]
                got = segments(np.frombuffer(b"".join(p for *_, p in own), np.uint8), np.cumsum([len(p) for *_, p in own]), length, reach)
                if len(got):
                    at = got["d"].to_numpy()
                    shift = np.array([p[1] for p in own])[at]
                    yield pd.DataFrame({
                        "row": rows[np.array([p[0] for p in own])[at]], "first": got["first"] + shift, "last": got["last"] + shift,
                        "size": got["size"], "anchor": got["anchor"], "print": got["print"]})


class RunIndex:
    """Burrows-Wheeler transform of a collection as runs, sampled at run ends.

    ``before`` holds, for the first row of each run, its text position and the common prefix
    with the suffix one row up; ``after`` the same for last rows and the suffix one row down.
    A common prefix of fewer than ``least`` bytes counts as none. Every text ends in a symbol
    of its own, so no match crosses texts.
    """

    def __init__(self, parts: list[bytes], least: int = 1):
        ends = np.cumsum([len(p) + 1 for p in parts])
        data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
        self.starts = np.concatenate([[0], ends[:-1]])
        n = len(data)
        remains = np.repeat(ends, np.diff(np.concatenate([[0], ends]))) - np.arange(n) - 1
        order = self._suffixes(data, remains)
        code = data.astype(np.int64) + len(parts)
        code[ends - 1] = np.arange(len(parts))  # each end is a symbol of its own
        symbol = code[order - 1]  # of the first suffix: the last symbol
        head = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
        tail = np.append(head[1:], n) - 1
        self.runs, self.symbols = np.diff(np.append(head, n)), symbol[head]
        pairs = Prefixes(data)
        up = head[head > 0]
        down = tail[tail < n - 1]
        self.before = self._sampled(order[up], self._common(pairs, remains, order[up], order[up - 1], least), order[:1])
        self.after = self._sampled(order[down], self._common(pairs, remains, order[down], order[down + 1], least), order[-1:])
        self.n = n

    @staticmethod
    def _suffixes(data: np.ndarray, remains: np.ndarray) -> np.ndarray:
        """Suffix order by doubling; places whose order is settled drop out. Ends come first, in text order."""
        n = len(data)
        at = np.arange(n)
        used = np.bincount(data, minlength=256) > 0
        rank = np.where(remains > 0, np.cumsum(used)[data], 0)
        h, base, most = 1, int(used.sum()) + 1, int(used.sum()) + 1
        while most ** 2 < 1 << 62 and h < 8:  # several symbols in one key before the first sort
            moved = np.append(rank[h:], np.zeros(min(h, n), np.int64))[:n]
            rank = rank * most + np.where(remains >= h, moved, 0)
            most, h = most ** 2, 2 * h
        order = np.argsort(rank, kind="stable")
        key, own, rows = rank[order], order, at
        rank = np.empty(n, np.int64)
        over = remains[own] < h  # the end is among the symbols compared: text order settles the rest
        while True:
            fresh = np.concatenate([[True], key[1:] != key[:-1]]) | over
            rank[own] = np.maximum.accumulate(np.where(fresh, rows, 0))
            rest = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
            if not len(rest):
                return order
            rows, own = rows[rest], own[rest]
            key = rank[own] * n + rank[own + h]
            again = np.argsort(key)
            key, own = key[again], own[again]
            order[rows] = own
            over, h = False, 2 * h

    @staticmethod
    def _common(pairs: Prefixes, remains: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
        """Longest common prefixes of suffixes, by halving over hashes; 0 if under ``least``."""
        out = np.zeros(len(a), np.int64)
        far = np.flatnonzero(np.minimum(remains[a], remains[b]) >= least)
        far = far[pairs.of(a[far], a[far] + least) == pairs.of(b[far], b[far] + least)]
        a, b = a[far], b[far]
        low, high = np.full(len(far), least), np.minimum(remains[a], remains[b])
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                out[far] = low
                return out
            half = (low[open_] + high[open_] + 1) // 2
            x, y = a[open_], b[open_]
            same = pairs.of(x, x + half) == pairs.of(y, y + half)
            low[open_] = np.where(same, half, low[open_])
            high[open_] = np.where(same, high[open_], half - 1)

    @staticmethod
    def _sampled(places: np.ndarray, common: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Samples in text order; the outermost suffix has no neighbour, so a match of 0."""
        places, common = np.append(places, edge), np.append(common, np.zeros(len(edge), np.int64))
        order = np.argsort(places)
        return places[order], common[order]

    def long_matches(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs of text positions [from, to) where ``length`` bytes or more match elsewhere."""
        out = []
        for places, common in (self.before, self.after):
            reach = np.minimum(places + common - length + 1, np.append(places[1:], self.n))
            far = reach > places
            out.append(np.stack([places[far], reach[far]]))
        return tuple(np.concatenate(out, axis=1))


def repeated_windows(frame: pd.DataFrame, lengths: tuple[int, ...]) -> pd.DataFrame:
    """Window starts of a bucket's distinct segments that occur twice or more: runs of starts, per length."""
    # Segments of one document overlap by design; merged, no byte is indexed twice.
    frame = frame.sort_values(["row", "first", "last"], kind="stable").reset_index(drop=True)
    row, first, last = (frame[c].to_numpy() for c in ("row", "first", "last"))
    data, begin = frame["bytes"].tolist(), first.tolist()
    end = first + np.array([len(x) for x in data])
    fresh = np.ones(len(frame), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (first[1:] > end[:-1])
    base = np.flatnonzero(fresh)
    group = np.cumsum(fresh) - 1
    parts = []
    for a, b in zip(base.tolist(), np.append(base[1:], len(frame)).tolist(), strict=True):
        text = bytearray(data[a])
        for i in range(a + 1, b):
            text += data[i][begin[a] + len(text) - begin[i] :]
        parts.append(bytes(text))
    index = RunIndex(parts, min(lengths))
    start = index.starts[group] + first - first[base[group]]
    stop = start + last - first
    out = []
    for length in lengths:
        low, high = index.long_matches(length)
        hit = np.zeros(index.n + 1, np.int64)
        np.add.at(hit, low, 1)
        np.add.at(hit, high, -1)
        hit = np.cumsum(hit)[:-1] > 0
        # Every segment meets each run of marked starts that reaches into it.
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
        low, high = edge[::2], edge[1::2] - 1
        from_, to = np.searchsorted(high, start), np.searchsorted(low, stop, "right")
        met = np.maximum(to - from_, 0)
        own = np.repeat(np.arange(len(frame)), met)
        run = np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met) + from_[own]
        out.append(pd.DataFrame({
            "anchor": frame["anchor"].to_numpy()[own], "print": frame["print"].to_numpy()[own], "length": length,
            "low": np.maximum(low[run], start[own]) - start[own], "high": np.minimum(high[run], stop[own]) - start[own]}))
    return pd.concat(out)


def _cut_segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for text, wanted in zip(frame["text"], frame["wanted"], strict=True):
            data = encoded(text)
            out += [(w["row"], w["first"], w["last"], w["size"], w["anchor"], w["print"], data[w["first"] : w["first"] + w["size"]]) for w in wanted]
        yield pd.DataFrame(out, columns=["row", "first", "last", "size", "anchor", "print", "bytes"])


def _window_prints(frames: Iterator[pd.DataFrame], lengths: tuple[int, ...]) -> Iterator[pd.DataFrame]:
    """Every window of hot segments: anchor, print, length, offset in the segment, hash of the window."""
    for frame in frames:
        for anchor, print_, last, data in zip(frame["anchor"], frame["print"], frame["last"] - frame["first"], frame["bytes"], strict=True):
            prefixes = Prefixes(np.frombuffer(data, np.uint8))
            for length in lengths:
                at = np.arange(min(last, len(data) - length) + 1)
                yield pd.DataFrame({"anchor": anchor, "print": print_, "length": length, "at": at, "window": prefixes.of(at, at + length).astype(np.int64)})


def marks(rows: DataFrame, *lengths: int) -> DataFrame:
    """(row, length, low, high): runs of repeated window starts of each row (row, text); see the module."""
    least, reach = min(lengths), max(lengths)
    spec = "row long, first int, last int, size int, anchor long, print long"
    found = written(rows.where(F.octet_length("text") >= least).mapInPandas(lambda fs: _segment_rows(fs, least, reach), spec))
    kinds = found.groupBy("anchor", "print").agg(F.count("*").alias("n"), F.min(F.struct("row", "first", "last", "size")).alias("at"))
    kinds = written(kinds.withColumn("size", F.col("at.size")))
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("n").alias("all"), F.sum("size").alias("bytes"))
    shared = written(kinds.join(anchors.where("all > 1"), "anchor"))
    each = F.explode(F.array(*map(F.lit, lengths))).alias("length")
    whole = shared.where("n > 1").select("anchor", "print", each, F.lit(0).alias("low"), (F.col("at.last") - F.col("at.first")).alias("last"), "size")
    whole = whole.select("anchor", "print", "length", "low", F.least("last", F.col("size") - F.col("length")).alias("high")).where("high >= 0")

    wanted = shared.where("kinds > 1")
    total = wanted.agg(F.sum("size")).first()[0] or 0
    per_row = wanted.select("at.row", F.struct("at.*", "anchor", "print").alias("w")).groupBy("row").agg(F.collect_list("w").alias("wanted"))
    bytes_spec = spec + ", bytes binary"
    if total:
        per_row = written(per_row)
        ids = per_row.select("row")
        held = rows.join(broadcast_if_small(ids, ids.count(), BROADCAST_IDS), "row", "left_semi")
        chosen = held.join(per_row, "row").select("text", "wanted")
        cut = written(chosen.mapInPandas(_cut_segments, bytes_spec))
        hot = anchors.where(F.col("bytes") > HOT_BYTES).select("anchor")
        calm = anchors.where(F.col("bytes") <= HOT_BYTES).select("anchor")
        buckets = max(12, total // BUCKET_BYTES)
        indexed = (
            cut.join(calm, "anchor", "left_semi").groupBy(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"))
            .applyInPandas(lambda frame: repeated_windows(frame, lengths), "anchor long, print long, length int, low int, high int")
        )
        windows = cut.join(hot, "anchor", "left_semi").select("anchor", "print", "first", "last", "bytes").mapInPandas(
            lambda fs: _window_prints(fs, lengths), "anchor long, print long, length int, at int, window long")
        windows = written(windows)
        twice = windows.groupBy("anchor", "length", "window").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "length", "window")
        counted = windows.join(twice, ["anchor", "length", "window"]).select("anchor", "print", "length", F.col("at").alias("low"), F.col("at").alias("high"))
        whole = whole.union(indexed).union(counted)
    runs = written(whole)
    return found.join(runs, ["anchor", "print"]).select("row", "length", (F.col("first") + F.col("low")).alias("low"), (F.col("first") + F.col("high")).alias("high"))


def _kept(data: bytes, spans: list | None, length: int) -> tuple[list[bytes], int, int]:
    """(kept pieces, bytes removed, maximal removed runs)."""
    kept, removed, count, at = [], 0, 0, 0
    for low, high in sorted((s["low"], s["high"] + length) for s in spans if s["length"] == length) if spans is not None else ():
        if count and low <= at:
            removed += max(0, high - at)
            at = max(at, high)
            continue
        kept.append(data[at:low])
        removed += high - low
        count, at = count + 1, high
    kept.append(data[at:])
    return kept, removed, count


def with_spans(documents: DataFrame, out: str, *lengths: int) -> DataFrame:
    """The documents with runs of window starts whose ``lengths`` bytes occur again in a new column; null if none."""
    key = F.xxhash64(named("doc_id"), F.coalesce("text", F.lit("")))
    row = fresh_name(documents, out + "_row")
    spans = marks(documents.select(key.alias("row"), "text"), *lengths).groupBy("row").agg(F.collect_set(F.struct("length", "low", "high")).alias(out))
    return documents.withColumn(row, key).join(spans.withColumnRenamed("row", row), row, "left").drop(row)


def _digest(frames: Iterator[pd.DataFrame], length: int, passage: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for doc, text, spans in zip(frame["doc_id"], frame["text"], frame["_spans"], strict=True):
            data = encoded(text)
            kept, removed, count = _kept(data, spans, length)
            digest = hashlib.sha256()
            for piece in kept:
                digest.update(piece)
            out.append((doc, len(data), removed, count, digest.hexdigest(), _kept(data, spans, passage)[1]))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_bytes"])


def removal_report(documents: DataFrame, length: int = 400, passage: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document.

    With ``passage``, also n_passage_bytes: the bytes covered by a string of that many bytes that
    starts anywhere else too. They are reported only; what is removed goes by ``length``.
    """
    lengths = [length] if passage in (None, length) else [passage, length]
    joined = with_spans(documents.select("doc_id", "text"), "_spans", *lengths)
    spec = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_bytes long"
    report = unnamed(joined.withColumn("doc_id", named("doc_id")).mapInPandas(lambda fs: _digest(fs, length, passage or length), spec), "doc_id")
    return report if passage else report.drop("n_passage_bytes")


def _without(frames: Iterator[pd.DataFrame], length: int, spans: str) -> Iterator[pd.DataFrame]:
    for frame in frames:
        kept = [b"".join(_kept(encoded(t), s, length)[0]).decode("utf-8", "ignore") for t, s in zip(frame["text"], frame[spans], strict=True)]
        yield frame.drop(columns=spans).assign(text=kept, n_chars=[len(t) for t in kept])


def remove_repeats(documents: DataFrame, length: int = 400) -> DataFrame:
    """The documents without the repeated bytes, ``n_chars`` counted anew; other columns and all rows stay.

    A character of which only some bytes are removed goes with them.
    """
    spans = fresh_name(documents, "spans")
    joined = with_spans(documents, spans, length)
    touched = joined.where(F.col(spans).isNotNull()).mapInPandas(lambda fs: _without(fs, length, spans), documents.schema)
    return joined.where(F.col(spans).isNull()).select(documents.columns).union(touched.select(documents.columns))
