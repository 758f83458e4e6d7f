"""Collocations per language: phrases whose words occur together far more often than apart.

Method: broadcast double-array tries of Apriori-safe candidates. A phrase can occur ``least``
times only if each part of it does. Level by level (1, 2, 3 words):
1. Words are counted by a combined aggregate.
2. Candidates of k words are found in two scans. The first takes the phrases whose first and
   last k-1 words are frequent, by a bit filter, and sums counts of their hashes, cut off at
   ``least`` in each task. The second takes the phrases whose hash reached ``least``, by a bit
   filter again. Filters have a bounded size and only let too much through, and sums of hashes
   are never too small, so no frequent phrase is lost; rare ones never travel as text.
3. Candidates are range-partitioned and built into double-array tries of bounded size over
   their bytes. Each is broadcast; a task walks its text through one after the other: the
   states of all word starts of a block move on together, one byte a step, with numpy.
   Accepting states are counted by ``bincount``, one vector a task and trie; vectors are
   summed in groups of about ``FAN``, and the sums again, until there is one for each trie.
   The same scan hashes the phrases of one word more.
4. Scores are exact decimals. Phrases inside a longer candidate that is at least half as
   common are dropped; the best of each language are ranked, first in salted groups.

A text becomes a stream of bytes first: A-Z lower, one space between the words of a piece, a
line feed between pieces. A word of more than ``LONG_WORD`` bytes, or with U+FFFF in it,
stands there as U+FFFF and its MD5, so a trie has bounded depth; results have the word again.

Null texts are empty; a null language counts as ``und``, together with rows that say so.
Repeated rows count each. Texts are streamed in blocks of about ``GROUP_BYTES`` that end
between pieces. Phrase hashes have 64 bits. Equal scores are ordered by count, then phrase.
Extra columns are ignored. An empty table, or one without candidates, gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safelabel.llm.hashing import encoded, mix, stream
from safelabel.llm.store import written

GROUP_BYTES = 2 << 20
LONG_WORD = 64
TRIE_BYTES = 1 << 20
FILTER_BITS = 1 << 27
FLUSH_WORDS = 300_000
FLUSH_HASHES = 1_000_000
FAN = 64
ROWS = 256
RANK_GROUP = 200_000
CODE = "￿"
_U = np.uint64
_SPACE, _BREAK = 32, 10
_BREAKS = re.compile(r"[.,;:!?\n-\r]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = _BREAK
_FOLD[[32, 9]] = _SPACE
_BYTE = stream(61, 256)
_RADIX = 0xB5297A4D3F84D5B5
_INVERSE = pow(_RADIX, -1, 1 << 64)
_cache: dict[int, np.ndarray] = {}


def _powers(radix: int, n: int) -> np.ndarray:
    if radix not in _cache or len(_cache[radix]) < n:
        out = np.full(n, radix, _U)
        out[0] = 1
        _cache[radix] = np.multiply.accumulate(out)
    return _cache[radix][:n]


class Stream:
    """Texts as one run of bytes; word i is bytes [start[i], end[i]), ``last[i]`` if a piece ends there."""

    def __init__(self, texts: list[str], coded: bool = False):
        """``coded``: long words stand coded already."""
        data = _FOLD[np.frombuffer(encoded("\n".join(texts) + "\n"), np.uint8)]
        gap = (data == _SPACE) | (data == _BREAK)
        first = gap.copy()
        first[1:] &= ~gap[:-1]
        gaps = data[gap]
        lead = np.flatnonzero(first[gap])
        data[first] = np.minimum.reduceat(gaps, lead)  # a break anywhere in a gap makes it one
        first[0] = False  # no word before
        self.data = data[~gap | first]
        self._words()
        far = np.flatnonzero(self.end - self.start > LONG_WORD)
        self.coded: dict[bytes, str] = {}
        raw = self.data.tobytes()
        if not coded and (len(far) or CODE.encode() in raw):
            parts, at = [], 0
            for s, e in zip(self.start.tolist(), self.end.tolist(), strict=True):
                if e - s > LONG_WORD or CODE.encode() in raw[s:e]:
                    word = raw[s:e].decode("utf-8", "surrogatepass")
                    code = (CODE + hashlib.md5(raw[s:e]).hexdigest()).encode()
                    self.coded[code] = word
                    parts += [raw[at:s], code]
                    at = e
            self.data = np.frombuffer(b"".join([*parts, raw[at:]]), np.uint8)
            self._words()

    def _words(self) -> None:
        self.end = np.flatnonzero((self.data == _SPACE) | (self.data == _BREAK))
        self.start = np.append(0, self.end + 1)[: len(self.end)]
        self.last = self.data[self.end] == _BREAK

    def words(self) -> list[bytes]:
        return self.data.tobytes().split()

    def phrases(self, k: int) -> np.ndarray:
        """First words of the runs of ``k`` words within a piece."""
        n = len(self.start) - k + 1
        ok = np.ones(max(n, 0), bool)
        for j in range(k - 1):
            ok &= ~self.last[j : j + len(ok)]
        return np.flatnonzero(ok)

    def hashes(self, k: int, language: str) -> np.ndarray:
        """Hash of the bytes from each word to the end of the k-th from there."""
        n = max(0, len(self.start) - k + 1)
        size = len(self.data)
        sums = np.zeros(size + 1, _U)
        np.cumsum(_BYTE[self.data] * _powers(_RADIX, max(size, 1))[:size], out=sums[1:])
        start, end = self.start[:n], self.end[k - 1 : k - 1 + n]
        own = (sums[end] - sums[start]) * _powers(_INVERSE, size + 1)[start]
        return mix(own + (end - start).astype(_U) + _salt(language))

    def strings(self, start: np.ndarray, end: np.ndarray) -> pa.Array:
        """Byte ranges as an Arrow array of strings."""
        size = end - start
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])
        return pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.data[at]))


def _salt(language: str) -> np.uint64:
    return _U(int.from_bytes(hashlib.md5(encoded(language)).digest()[:8], "little"))


def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Stream]]:
    """(language, stream) of rows (lang, text), in blocks of about ``GROUP_BYTES`` that end between pieces."""
    held: dict[str, list[str]] = {}
    size: Counter = Counter()
    rows = (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS))
    for few in rows:
        for language, text in zip(few.column("lang").to_pylist(), few.column("text").to_pylist(), strict=True):
            at = 0
            while at < len(text):
                cut = _BREAKS.search(text, at + GROUP_BYTES) if len(text) - at > GROUP_BYTES else None
                stop = cut.end() if cut else len(text)
                held.setdefault(language, []).append(text[at:stop])
                size[language] += stop - at
                at = stop
                if size[language] >= GROUP_BYTES:
                    yield language, Stream(held.pop(language))
                    del size[language]
            if size.total() > 2 * GROUP_BYTES:  # many languages, none of them large
                largest = max(size, key=size.get)
                yield largest, Stream(held.pop(largest))
                del size[largest]
    while held:
        language = next(iter(held))
        yield language, Stream(held.pop(language))


def _rows(language: str, *columns: pa.Array, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([language] * len(columns[0]), pa.string()), *columns], ["lang", *names])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, full, n): words of each block, with the full word of those that stand coded."""
    total: dict[str, Counter] = {}
    full: dict[bytes, str] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for language, words in total.items():
            yield _rows(language, pa.array(list(words), pa.binary()).cast(pa.string()), pa.array([full.get(w) for w in words], pa.string()), pa.array(list(words.values()), pa.int64()), names=["word", "full", "n"])
        total.clear()
        full.clear()

    for language, block in streams(batches):
        total.setdefault(language, Counter()).update(block.words())
        full.update(block.coded)
        if sum(map(len, total.values())) > FLUSH_WORDS:
            yield from flush()
    yield from flush()


def _phrase_hashes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by: dict[str, list[str]] = {}
        for language, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
            by.setdefault(language, []).append(phrase)
        for language, phrases in by.items():
            block = Stream(phrases, coded=True)
            yield pa.RecordBatch.from_arrays([pa.array(block.hashes(k, language)[block.phrases(k)].view(np.int64))], ["h"])


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """Bits of a written table of hashes (h), at most ``FILTER_BITS``; Spark unites them."""
    count, bits = hashes.count(), 1 << 16
    while bits < min(32 * count, FILTER_BITS):
        bits *= 2
    place = F.col("h").bitwiseAND(bits - 1)
    rows = hashes.select(F.shiftright(place, 6).alias("slot"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    found = rows.groupBy("slot").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(bits >> 6, np.int64)
    out[found["slot"].to_numpy()] = found["bit"].to_numpy()
    return out.view(_U)


def _passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & _U((len(filter_) << 6) - 1)
    return (filter_[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) > 0


class HashCounts:
    """Counts of the hashes of phrases of ``k`` words whose first and last k-1 words pass a filter."""

    def __init__(self, k: int, filter_: np.ndarray, least: int):
        self.k, self.filter, self.least = k, filter_, least
        self.hashes, self.counts, self.fresh = np.zeros(0, _U), np.zeros(0, np.int64), []

    def add(self, language: str, block: Stream) -> None:
        ok = _passes(self.filter, block.hashes(self.k - 1, language))
        at = block.phrases(self.k)
        self.fresh.append(block.hashes(self.k, language)[at[ok[at] & ok[at + 1]]])
        if sum(map(len, self.fresh)) > FLUSH_HASHES:
            self._merge()

    def _merge(self) -> None:
        new, n = np.unique(np.concatenate(self.fresh), return_counts=True)
        place = np.searchsorted(self.hashes, new)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == new[known]
        self.counts[place[known]] += n[known]
        joined = np.concatenate([self.hashes, new[~known]])
        order = np.argsort(joined, kind="stable")
        self.hashes, self.counts, self.fresh = joined[order], np.concatenate([self.counts, n[~known]])[order], []

    def full(self) -> bool:
        return len(self.hashes) > FLUSH_HASHES

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and their counts, cut off at ``least``; they are forgotten here."""
        if self.fresh:
            self._merge()
        out = self.hashes.view(np.int64), np.minimum(self.counts, self.least)
        self.hashes, self.counts = np.zeros(0, _U), np.zeros(0, np.int64)
        return out


def _hash_counts(batches: Iterator[pa.RecordBatch], k: int, sent, least: int) -> Iterator[pa.RecordBatch]:
    found = HashCounts(k, sent.value, least)
    for language, block in streams(batches):
        found.add(language, block)
        if found.full():
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.taken()], ["h", "n"])
    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found.taken()], ["h", "n"])


def _seen(batches: Iterator[pa.RecordBatch], k: int, sent, least: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n): phrases of ``k`` words of each block whose hash passes the filter; n is at most ``least``."""
    for language, block in streams(batches):
        hashes, at = block.hashes(k, language), block.phrases(k)
        at = at[_passes(sent.value, hashes[at])]
        _, first, count = np.unique(hashes[at], return_index=True, return_counts=True)
        phrases = block.strings(block.start[at[first]], block.end[at[first] + k - 1])
        yield _rows(language, phrases, pa.array(np.minimum(count, least).astype(np.int64)), names=["phrase", "n"])


class DoubleArray:
    """A trie over the bytes of sorted distinct phrases, as two arrays: from a state, byte c leads to
    ``base[state] + c`` if ``check`` there names the state. ``accept`` has the phrase's number, or -1."""

    def __init__(self, base: np.ndarray, check: np.ndarray, accept: np.ndarray):
        self.base, self.check, self.accept = base, check, accept

    @classmethod
    def of(cls, phrases: list[bytes]) -> DoubleArray:
        parent, symbol, ends = cls._nodes(phrases)
        nodes = len(parent) + 1
        degree = np.bincount(parent, minlength=nodes)
        first = np.concatenate([[0], np.cumsum(degree)])
        used = np.zeros(nodes + nodes // 2 + 1024, bool)
        used[0] = True  # the root
        base = np.zeros(nodes, np.int64)
        random = np.random.default_rng(1)
        many = np.flatnonzero(degree > 1)
        many = many[np.argsort(-degree[many], kind="stable")]
        for low in range(0, len(many), 1 << 14):
            wait, tries = many[low : low + (1 << 14)], 0
            while len(wait):
                if tries and tries % 16 == 0:
                    used = np.append(used, np.zeros(len(used) // 4, bool))
                tries += 1
                try_ = random.integers(1, len(used) - 256, len(wait))
                owner = np.repeat(np.arange(len(wait)), degree[wait])
                child = np.repeat(first[wait] - np.concatenate([[0], np.cumsum(degree[wait])[:-1]]), degree[wait]) + np.arange(len(owner))
                slot = try_[owner] + symbol[child]
                taken = used[slot]
                once = np.zeros(len(slot), bool)
                once[np.unique(slot, return_index=True)[1]] = True
                clash = np.bincount(owner[taken | ~once], minlength=len(wait)) > 0
                used[slot[~clash[owner]]] = True
                base[wait[~clash]] = try_[~clash]
                wait = wait[clash]
        lone = np.flatnonzero(degree == 1)
        free = np.flatnonzero(~used[256:])[: len(lone)] + 256  # so that no base is negative
        if len(free) < len(lone):
            free = np.append(free, np.arange(len(used), len(used) + len(lone) - len(free)))
        base[lone] = free - symbol[first[lone]]
        place = np.zeros(nodes, np.int64)
        place[1:] = base[parent] + symbol
        size = int(max(place.max(), base.max())) + 257
        out = cls(np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32))
        out.base[place] = base
        out.check[place[1:]] = place[parent]
        out.accept[place[ends]] = np.arange(len(phrases))
        return out

    @staticmethod
    def _nodes(phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(parent, byte) of every node but the root, level by level, and the node where each phrase ends."""
        size = np.array([len(p) for p in phrases])
        table = np.full((len(phrases), int(size.max())), -1, np.int16)
        table[np.arange(table.shape[1]) < size[:, None]] = np.frombuffer(b"".join(phrases), np.uint8)
        same = np.concatenate([np.zeros((1, table.shape[1]), bool), table[1:] == table[:-1]])
        common = np.where(same.all(axis=1), table.shape[1], same.argmin(axis=1))
        now = np.zeros(len(phrases), np.int64)
        parents, symbols, nodes = [], [], 1
        for depth in range(table.shape[1]):
            fresh = (common <= depth) & (size > depth)
            parents.append(now[fresh])
            symbols.append(table[fresh, depth].astype(np.int64))
            own = nodes - 1 + np.cumsum(fresh)
            now = np.where(size > depth, own, now)
            nodes += int(fresh.sum())
        return np.concatenate(parents), np.concatenate(symbols), now

    def count(self, block: Stream, starts: np.ndarray, n: int) -> np.ndarray:
        """How often each of ``n`` phrases starts at one of the places and ends with a word there."""
        hits = []
        place, state = starts, np.zeros(len(starts), np.int32)
        while len(place):
            byte = block.data[place]
            at_end = (byte == _SPACE) | (byte == _BREAK)
            hits.append(self.accept[state[at_end]])
            follow = self.base[state] + byte
            on = self.check[follow] == state
            place, state = place[on] + 1, follow[on]
        hits = np.concatenate(hits) if hits else np.zeros(0, np.int32)
        return np.bincount(hits[hits >= 0], minlength=n)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tries (name, lang, phrases, base, check, accept) of sorted rows (lang, phrase); each holds about ``TRIE_BYTES`` of phrases."""
    language, held, size = None, [], 0

    def built() -> pa.RecordBatch:
        trie = DoubleArray.of([p.encode("utf-8", "surrogatepass") for p in held])
        return pa.RecordBatch.from_pydict({"name": [f"{language}\n{held[0]}"], "lang": [language], "phrases": ["\n".join(held)], "base": [trie.base.tobytes()], "check": [trie.check.tobytes()], "accept": [trie.accept.tobytes()]})

    for batch in batches:
        for own, phrase in zip(batch.column("lang").to_pylist(), batch.column("phrase").to_pylist(), strict=True):
            if held and (own != language or size >= TRIE_BYTES):
                yield built()
                held, size = [], 0
            language = own
            held.append(phrase)
            size += len(phrase) + 1
    if held:
        yield built()


def tries(candidates: DataFrame, size: int) -> DataFrame:
    """Double-array tries of candidates (lang, phrase) of about ``size`` bytes in all."""
    ranged = candidates.select("lang", "phrase").repartitionByRange(max(4, size // TRIE_BYTES), "lang", "phrase").sortWithinPartitions("lang", "phrase")
    return ranged.mapInArrow(_build, "name string, lang string, phrases string, base binary, check binary, accept binary")


def _value(sent) -> dict:
    """A broadcast value, read from the worker's disk whenever it is needed: kept ones would add up."""
    value = sent.value
    vars(sent).pop("_value", None)
    return value


def _count_and_look(batches: Iterator[pa.RecordBatch], k: int, sent: list, look, least: int) -> Iterator[pa.RecordBatch]:
    """(h, n, name, part, counts): vectors of the counts of the tries' phrases of ``k`` words; if a filter is given, rows of hashes of one word more."""
    totals: dict[int, np.ndarray] = {}
    ahead = HashCounts(k + 1, look.value, least) if look else None

    def hashed() -> pa.RecordBatch:
        h, n = ahead.taken()
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(n), pa.nulls(len(h), pa.string()), pa.nulls(len(h), pa.int32()), pa.nulls(len(h), pa.binary())], ["h", "n", "name", "part", "counts"])

    for language, block in streams(batches):
        starts = block.start[block.phrases(k)]
        for i, (own, _) in enumerate(sent):
            if own == language:
                trie = _value(sent[i][1])
                arrays = DoubleArray(*(np.frombuffer(trie[c], np.int32) for c in ("base", "check", "accept")))
                counts = arrays.count(block, starts, trie["phrases"].count("\n") + 1)
                totals[i] = totals[i] + counts if i in totals else counts
        if ahead:
            ahead.add(language, block)
            if ahead.full():
                yield hashed()
    if ahead:
        yield hashed()
    for i, counts in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([_value(sent[i][1])["name"]]), pa.array([TaskContext.get().partitionId()], pa.int32()),
             pa.array([counts.astype(np.int64).tobytes()])], ["h", "n", "name", "part", "counts"])


def _sum_vectors(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(frame["counts"].iat[0], np.int64).copy()
    for counts in frame["counts"].iloc[1:]:
        total += np.frombuffer(counts, np.int64)
    return pd.DataFrame({"name": [frame["name"].iat[0]], "part": [frame["part"].iat[0]], "counts": [total.tobytes()]})


def summed(vectors: DataFrame) -> DataFrame:
    """One vector (name, part, counts) for each name, from any number of them; parts tell the vectors of a name apart."""
    groups = -(-(vectors.groupBy("name").count().agg(F.max("count")).first()[0] or 0) // FAN)
    while True:
        dealt = vectors.withColumn("part", F.col("part") % max(1, groups))
        vectors = dealt.groupBy("name", "part").applyInPandas(lambda frame: _sum_vectors(frame), "name string, part int, counts binary")
        if groups <= 1:
            return vectors
        vectors, groups = written(vectors), -(-groups // FAN)


def _named_counts(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for language, phrases, counts in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrases", "counts")), strict=True):
            n = np.frombuffer(counts, np.int64)
            some = np.flatnonzero(n >= least)
            yield _rows(language, pa.array(phrases.split("\n")).take(pa.array(some)), pa.array(n[some]), names=["phrase", "n"])


def counted(texts: DataFrame, candidates: DataFrame, k: int, look: np.ndarray | None, least: int) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, n) among candidates of ``k`` words, and rows (h, n) of hashes of ``k`` + 1 words."""
    context = texts.sparkSession.sparkContext
    size = candidates.agg(F.sum(F.octet_length("phrase") + 1)).first()[0] or 0
    built = written(tries(candidates, size))
    sent = [(row["lang"], context.broadcast(row.asDict())) for row in built.toLocalIterator()]
    filter_ = None if look is None else context.broadcast(look)
    found = written(texts.mapInArrow(lambda batches: _count_and_look(batches, k, sent, filter_, least), "h long, n long, name string, part int, counts binary"))
    for one in [x for _, x in sent] + ([filter_] if filter_ else []):
        one.destroy()
    vectors = summed(found.where("h is null").select("name", "part", "counts"))
    named = vectors.join(built.select("name", "lang", "phrases"), "name").select("lang", "phrases", "counts")
    phrases = written(named.mapInArrow(lambda batches: _named_counts(batches, least), "lang string, phrase string, n long"))
    return phrases, found.where("h is not null").select("h", "n")


def candidates_of(texts: DataFrame, hashed: DataFrame, k: int, least: int) -> DataFrame:
    """Phrases (lang, phrase, n) of ``k`` words that may be frequent, from rows (h, n) of counted hashes."""
    heavy = written(hashed.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h"))
    filter_ = texts.sparkSession.sparkContext.broadcast(bit_filter(heavy))
    out = _reaching(texts.mapInArrow(lambda batches: _seen(batches, k, filter_, least), "lang string, phrase string, n long"), least)
    filter_.destroy()
    return out


def _filter_of(phrases: DataFrame, k: int) -> np.ndarray:
    return bit_filter(written(phrases.select("lang", "phrase").mapInArrow(lambda batches: _phrase_hashes(batches, k), "h long")))


def _reaching(rows: DataFrame, least: int) -> DataFrame:
    return written(rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def frequent_phrases(documents: DataFrame, least: int, longest: int) -> tuple[DataFrame, list[DataFrame]]:
    """All words (lang, word, full, n), and for 1, 2, ... words the frequent phrases (lang, phrase, n)."""
    texts = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(_words, "lang string, word string, full string, n long")
    words = written(rows.groupBy("lang", "word", "full").agg(F.sum("n").alias("n")))
    levels = [words.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), "n")]
    filter_ = texts.sparkSession.sparkContext.broadcast(_filter_of(levels[0], 1))
    candidates = candidates_of(texts, texts.mapInArrow(lambda batches: _hash_counts(batches, 2, filter_, least), "h long, n long"), 2, least)
    filter_.destroy()
    for k in range(2, longest + 1):
        phrases, hashed = counted(texts, candidates, k, _filter_of(candidates, k) if k < longest else None, least)
        levels.append(phrases)
        if k < longest:
            candidates = candidates_of(texts, hashed, k + 1, least)
    return words, levels


def _part(first: int, last: int) -> Column:
    return F.array_join(F.slice("w", first, last - first + 1), " ")


def scored(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the frequent phrases of two or more words, by their lowest-scoring cut."""
    every = None
    for k in range(2, len(levels) + 1):
        rows = levels[k - 1].select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
        for cut in range(1, k):
            left = levels[cut - 1].select("lang", F.col("phrase").alias("left"), F.col("n").alias(f"l{cut}"))
            right = levels[k - cut - 1].select("lang", F.col("phrase").alias("right"), F.col("n").alias(f"r{cut}"))
            rows = rows.withColumns({"left": _part(1, cut), "right": _part(cut + 1, k)}).join(left, ["lang", "left"]).join(right, ["lang", "right"])
        wide = "decimal(19, 0)"
        cuts = [F.struct(
            F.expr(f"cast(a as {wide}) * cast(a as {wide}) * cast(1000000 as decimal(7, 0)) div (cast(l{c} as {wide}) * cast(r{c} as {wide}))").alias("score"),
            F.lit(c).alias("cut"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")) for c in range(1, k)]
        lowest = F.array_min(F.array(*cuts))
        own = rows.select("lang", "phrase", "a", lowest.alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
        every = own if every is None else every.union(own)
    return every


def uncovered(scores: DataFrame, levels: list[DataFrame], cover: int) -> DataFrame:
    """Candidates but for those inside a longer one that has at least ``cover`` percent of their count."""
    parts = None
    for k in range(3, len(levels) + 1):
        w = levels[k - 1].select("lang", "n", F.split("phrase", " ").alias("w"))
        inner = F.array(*[_part(first, first + size - 1) for size in range(2, k) for first in range(1, k - size + 2)])
        own = w.select("lang", "n", F.explode(inner).alias("phrase"))
        parts = own if parts is None else parts.union(own)
    if parts is None:
        return scores
    most = parts.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    return scores.join(most, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {cover} * a")).drop("longer")


def collocations(documents: DataFrame, least: int = 10, longest: int = 3, cover: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of each language; see the module."""
    words, levels = frequent_phrases(documents, least, longest)
    kept = uncovered(scored(levels), levels, cover)
    names = words.where(F.col("full").isNotNull() & (F.col("n") >= least)).select("lang", F.col("word").alias("code"), "full")
    plain, coded = kept.where(~F.contains("phrase", F.lit(CODE))), kept.where(F.contains("phrase", F.lit(CODE)))
    spelled = coded.select("*", F.posexplode(F.split("phrase", " ")).alias("at", "code")).join(names, ["lang", "code"], "left")
    others = ["lang", "a", "l", "r", "score"]
    joined = spelled.groupBy("phrase", *others).agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("full", "code").alias("word")))).alias("w"))
    kept = written(plain.select("phrase", *others).union(joined.select(F.array_join("w.word", " ").alias("phrase"), *others)))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    groups = max(1, kept.count() // RANK_GROUP)
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(groups)))
    near_top = salted.withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("place") <= top)
    ranked = near_top.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
