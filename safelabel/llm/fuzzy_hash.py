"""Document fingerprints by context-triggered piecewise hashing, and their likeness.

A hash rolls over the last seven bytes of a text. Where it meets a block size, a piece ends,
so the cuts follow the content and an edit moves only the cuts beside it. Each piece becomes
one of 64 symbols. A fingerprint is ``block size:signature:signature at twice that size``.
Block sizes are 3 * 2^k; a text takes the smallest that gives 64 symbols or fewer, counted
over the whole text, so nothing is cut off and long texts are no special case.

Two fingerprints are compared at a block size that both have: the same, or one twice the
other. The likeness is 1 less the edit distance over the longer length. It is 0 without a
common size, or without a common run of five symbols (of half the shorter signature, where
that is less), which chance seldom gives. Edit distances of many pairs are taken at once,
bit-parallel: a signature is one 64-bit word.

``neighbour_report`` needs the next text of every text. Documents are dealt into ranges of
doc_id with explicit bounds, sorted downwards within a range and streamed, so that a task
holds one text more than its batch. The bounds are ids of documents; these few rows travel
twice, once to the range before. That is the only shuffle of texts.

Null texts count as empty; an empty text has the fingerprint ``3::``, which is like itself
(1) and like nothing else (0). Null doc_ids come before all others. Rows of equal doc_id
follow each other by text, equal rows in any order (their results are equal). A single row
is its own next. Very long texts are hashed in blocks. Extra columns are ignored, but by
``with_fingerprints``, which keeps them and replaces a column of the name it is given. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from safelabel.llm.hashing import encoded, mix, stream
from safelabel.llm.store import named, unnamed

BLOCK = 1 << 20
WINDOW = 7
SIGNATURE = 64
COMMON_RUN = 5
SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
RANGE_BYTES = 4 << 20
WEIGHT_BYTES = 64 << 10
REPORT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

_U = np.uint64
_ROLL = (stream(41, 256) >> _U(32)).astype(np.uint32)
_SHIFT = (stream(43, WINDOW) >> _U(32)).astype(np.uint32) | np.uint32(1)
_PIECE = stream(47, 256)
_RADIX = 0x9E6C63D0A5A1B6E5
_INVERSE = pow(_RADIX, -1, 1 << 64)
_ALL = (1 << 64) - 1
_powers: np.ndarray | None = None


def _radix_powers() -> np.ndarray:
    global _powers
    if _powers is None:
        _powers = np.full(BLOCK, _RADIX, _U)
        _powers[0] = 1
        np.multiply.accumulate(_powers, out=_powers)
    return _powers


def triggers(data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Level of each byte of a block: a piece of block size 3 * 2^k ends there if the level is k or more; -1 if never.

    ``before``: the rolled values of the six bytes before the block, zeros at the start of a text.
    """
    rolled = np.concatenate([before, _ROLL[data]])
    n = len(data)
    value = rolled[WINDOW - 1 :] * _SHIFT[0]
    for k in range(1, WINDOW):
        value += rolled[WINDOW - 1 - k : WINDOW - 1 - k + n] * _SHIFT[k]
    value ^= value >> np.uint32(15)
    value *= np.uint32(0x2C1B3C6D)
    value ^= value >> np.uint32(12)
    level = np.full(n, -1, np.int8)
    at = np.flatnonzero(value % np.uint32(3) == 2)
    reached = value[at].astype(_U) + _U(1)
    lowest = reached & (~reached + _U(1))
    level[at] = np.log2(lowest.astype(np.float64)).astype(np.int8)
    return level


def fingerprint(data: bytes) -> str:
    """The fingerprint of a byte string; see the module."""
    whole = np.frombuffer(data, np.uint8)
    before = np.zeros(WINDOW - 1, np.uint32)
    ends, levels, sums = np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, _U)
    counts = np.zeros(40, np.int64)
    total, k = _U(0), 0
    for at in range(0, len(whole), BLOCK):
        own = whole[at : at + BLOCK]
        level = triggers(own, before)
        running = np.cumsum(_PIECE[own] * (_radix_powers()[: len(own)] * _U(pow(_RADIX, at, 1 << 64)))) + total
        total = running[-1]
        hit = np.flatnonzero(level >= k)
        counts += np.bincount(level[hit], minlength=40)
        while counts[k:].sum() >= SIGNATURE:
            k += 1
        ends, levels, sums = (np.concatenate([x, y]) for x, y in ((ends, hit + at + 1), (levels, level[hit]), (sums, running[hit])))
        keep = levels >= k
        ends, levels, sums = ends[keep], levels[keep], sums[keep]
        before = np.concatenate([before, _ROLL[own[-WINDOW + 1 :]]])[-WINDOW + 1 :]

    def signature(size: int) -> str:
        keep = levels >= size
        stop, reached = ends[keep], sums[keep]
        if len(whole) and (not len(stop) or stop[-1] < len(whole)):
            stop, reached = np.append(stop, len(whole)), np.append(reached, total)
        start = np.concatenate([[0], stop[:-1]])
        piece = (reached - np.concatenate([np.zeros(1, _U), reached[:-1]])) * np.array([pow(_INVERSE, int(s), 1 << 64) for s in start], _U)
        return "".join(SYMBOLS[x] for x in (mix(piece + (stop - start).astype(_U)) >> _U(58)).tolist())

    return f"{3 << k}:{signature(k)}:{signature(k + 1)}" if len(whole) else "3::"


def edit_distances(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Levenshtein distance of each pair of strings of up to 64 symbols; a column of the table is one word."""
    out = np.array([max(len(a), len(b)) for a, b in pairs], np.int64)
    code = np.zeros(128, np.int64)
    code[[ord(c) for c in SYMBOLS]] = np.arange(64)
    rows = np.array([i for i, (a, b) in enumerate(pairs) if a and b], np.int64)
    for low in range(0, len(rows), 4_096):
        own = rows[low : low + 4_096]
        m, n = (np.array([len(pairs[i][side]) for i in own]) for side in (0, 1))
        match = np.zeros((len(own), 64), _U)
        for r, i in enumerate(own):
            symbols = code[np.frombuffer(pairs[i][0].encode(), np.uint8)]
            np.bitwise_or.at(match[r], symbols, _U(1) << np.arange(m[r], dtype=_U))
        other = np.zeros((len(own), int(n.max())), np.int64)
        for r, i in enumerate(own):
            other[r, : n[r]] = code[np.frombuffer(pairs[i][1].encode(), np.uint8)]
        plus, minus, score = np.full(len(own), _ALL, _U), np.zeros(len(own), _U), m.copy()
        last = (m - 1).astype(_U)
        for j in range(other.shape[1]):
            equal = match[np.arange(len(own)), other[:, j]]
            vertical = equal | minus
            cross = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(cross | plus)
            down = plus & cross
            score += np.where(j < n, ((up >> last) & _U(1)).astype(np.int64) - ((down >> last) & _U(1)).astype(np.int64), 0)
            up = (up << _U(1)) | _U(1)
            down = down << _U(1)
            plus, minus = down | ~(vertical | up), up & vertical
        out[own] = score
    return out


def _comparable(a: str, b: str) -> tuple[str, str] | None:
    """The signatures of two fingerprints at the finest block size that both have."""
    (x, *left), (y, *right) = a.split(":"), b.split(":")
    x, y = int(x), int(y)
    return (left[0], right[0]) if x == y else (left[0], right[1]) if x == 2 * y else (left[1], right[0]) if 2 * x == y else None


def _share_run(a: str, b: str) -> bool:
    width = min(COMMON_RUN, -(-min(len(a), len(b)) // 2))
    return width > 0 and any(b[i : i + width] in a for i in range(len(b) - width + 1))


def likeness(left: list[str], right: list[str]) -> list[float]:
    """Likeness of fingerprints, pair by pair: 0 to 1."""
    out, at, pairs = [float(a == b) for a, b in zip(left, right, strict=True)], [], []
    for i, (a, b) in enumerate(zip(left, right, strict=True)):
        if a != b and (both := _comparable(a, b)) and _share_run(*both):
            at.append(i)
            pairs.append(both)
    for i, (a, b), d in zip(at, pairs, edit_distances(pairs).tolist(), strict=True):
        out[i] = 1 - d / max(len(a), len(b))
    return out


def with_fingerprints(documents: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """The documents with the fingerprint of a text column."""
    kept = [f for f in documents.schema if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(encoded(t)) for t in batch.column(text).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [prints], [*(f.name for f in kept), out])

    return documents.mapInArrow(add, schema)


def id_bounds(rows: DataFrame, range_bytes: int) -> tuple[list[int], int, int]:
    """(ids that begin a range of about ``range_bytes``, smallest id, bytes of all texts) of rows (doc_id, text)."""
    sizes = rows.select("doc_id", F.octet_length("text").cast("long").alias("bytes"))
    least, total = sizes.agg(F.min("doc_id"), F.sum("bytes")).first()
    ranges = int((total or 0) // range_bytes)
    if ranges < 1:
        return [], least, total or 0
    weighted = sizes.select("doc_id", F.explode(F.sequence(F.lit(0), (F.col("bytes") / WEIGHT_BYTES).cast("int"))))
    shares = [(k + 1) / (ranges + 1) for k in range(ranges)]
    bounds = weighted.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * ranges))).first()[0]
    return sorted(set(bounds)), least, total


def _deal(batches: Iterator[pa.RecordBatch], bounds: list[int], least: int) -> Iterator[pa.RecordBatch]:
    """Rows with their range; a bound goes to the range before as well, the smallest id after the last of all."""
    edges = np.array(bounds, np.int64)
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        own = np.searchsorted(edges, ids, "right").astype(np.int32)
        early = np.flatnonzero(np.isin(ids, edges))
        wrap = np.flatnonzero(ids == least)
        at = np.concatenate([np.arange(len(ids)), early, wrap])
        taken = batch.take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([own, own[early] - 1, np.full(len(wrap), len(edges))]).astype(np.int32)),
             pa.array((np.arange(len(at)) >= len(ids)).astype(np.int8) + (np.arange(len(at)) >= len(ids) + len(early))),
             taken.column("doc_id"), taken.column("text")],
            ["range", "extra", "doc_id", "text"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The report of rows that come range by range, each range downwards; extra rows only serve the row after them."""
    at, text, print_ = None, "", ""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "text")), strict=True)
        out = []
        for place, extra, doc, own in rows:
            now = fingerprint(encoded(own))
            if not extra:
                if place != at:
                    raise RuntimeError("a range lacks the text that follows it")
                cut = len(own) // 4
                edited = encoded(own[: len(own) - cut] + text[:cut])
                out.append((doc, len(own), hashlib.sha256(edited).hexdigest(), now, fingerprint(edited), print_))
            at, text, print_ = place, own, now
        if out:
            doc, chars, digest, prints, edited, following = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(chars, pa.int64()), pa.array(digest), pa.array(prints), pa.array(edited),
                 pa.array(likeness(prints, edited), pa.float64()), pa.array(likeness(prints, following), pa.float64())],
                [x.split()[0] for x in REPORT.split(", ")])


def neighbour_report(documents: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to it and to the next text.

    The edited text ends in the start of the next document, by ascending doc_id, in place of its
    last quarter; after the last document comes the first.
    """
    rows = documents.select(named("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    bounds, least, total = id_bounds(rows, range_bytes)
    if least is None:
        return documents.sparkSession.createDataFrame([], REPORT)
    dealt = rows.mapInArrow(lambda batches: _deal(batches, bounds, least), "range int, extra byte, doc_id long, text string")
    order = ["range", F.desc("extra"), F.desc("doc_id"), F.desc("text")]
    sorted_ = dealt.repartition(max(12, total // (8 * range_bytes)), "range").sortWithinPartitions(*order)
    return unnamed(sorted_.mapInArrow(_compare, REPORT), "doc_id")
