"""Token sequences of fixed capacity, filled by best-two-fit.

Each text becomes token ids and an end id. Only a document longer than the capacity is cut:
its last pieces are full and the first holds what is left. A full piece is a sequence of its
own. The others are dealt by hash into parts of bounded size, and each part is packed by
length counts: a bin is filled greedily with the longest pieces that fit; then its smallest
piece is taken out and replaced by two unpacked pieces if they fit the expanded gap more
tightly. A part wastes about one bin, whatever the size of the corpus.

Packing depends only on the lengths and names in a part, so a task that runs again gives the
same sequences. Token ids stay in the task that made them.

Null texts count as empty and are the end id alone. Rows that repeat a doc_id are packed
each; a null doc_id stays null. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.llm.store import named, unnamed, written

CAPACITY = 1024
PART_PIECES = 2_500
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def cut(count: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``count`` tokens; only the first may be short."""
    first = count % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, count, capacity)]


#: Fixed value: how byte-level BPE of this kind splits a text before it merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_RUN = 20_000


class Coder:
    """Token ids by a byte-level BPE file of ``tokenizers``.

    The same vocabulary is given to ``tiktoken``, which makes the same ids in a third of the
    time. Texts with very long runs without a break are left to ``tokenizers``, whose time
    does not grow with their square, and so are texts that hold the string of an added token:
    it becomes that token's id.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        byte = _bytes_of_symbols()
        ranks = {bytes(byte[c] for c in t): i for t, i in self.tokenizer.get_vocab().items() if t not in special}
        self.fast = Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if any(token in text for token in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        if len(text) > LONG_RUN and max(map(len, re.findall(r"\S+|\s+", text))) > LONG_RUN:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def _bytes_of_symbols() -> dict[str, int]:
    """The byte that each printable symbol of a byte-level vocabulary stands for."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _pieces(frames: Iterator[pd.DataFrame], path: str, end: int, capacity: int) -> Iterator[pd.DataFrame]:
    coder = Coder(path)
    for frame in frames:
        texts, ids = [t or "" for t in frame["text"].tolist()], frame["doc_id"].tolist()
        out = []
        for doc, text in zip(ids, texts, strict=True):
            tokens = np.array([*coder.encode(text), end], "<u4")
            for k, (start, length) in enumerate(cut(len(tokens), capacity)):
                out.append((doc, k, start, length, zlib.crc32(tokens[start : start + length].tobytes())))
        yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(documents: DataFrame, tokenizer: str, end: int = 2, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with the checksum of their ids; a missing doc_id is ``store.NO_ID`` here."""
    rows = documents.select(named("doc_id"), "text")
    return rows.mapInPandas(lambda frames: _pieces(frames, tokenizer, end, capacity), PIECES)


class Lengths:
    """How many pieces of each length are unpacked, with the lengths in order."""

    def __init__(self, lengths: np.ndarray):
        kinds, counts = np.unique(lengths, return_counts=True)
        self.kinds, self.count = kinds.tolist(), dict(zip(kinds.tolist(), counts.tolist(), strict=True))

    def best(self, room: int) -> int:
        """The longest unpacked length that fits, or 0."""
        at = bisect_right(self.kinds, room)
        return self.kinds[at - 1] if at else 0

    def take(self, length: int) -> None:
        self.count[length] -= 1
        if not self.count[length]:
            del self.count[length]
            self.kinds.remove(length)

    def put(self, length: int) -> None:
        if length not in self.count:
            self.kinds.insert(bisect_right(self.kinds, length), length)
        self.count[length] = self.count.get(length, 0) + 1

    def best_two(self, room: int, more_than: int) -> tuple[int, int] | None:
        """Two unpacked lengths of the largest sum within ``room``, if it exceeds ``more_than``."""
        low, high, most, pair = 0, bisect_right(self.kinds, room) - 1, more_than, None
        while low <= high:
            a, b = self.kinds[low], self.kinds[high]
            total = a + b
            if total > room or (low == high and self.count[a] < 2):
                high -= 1
                continue
            if total > most:
                most, pair = total, (a, b)
                if total == room:
                    break
            low += 1
        return pair


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of lengths: greedy filling, then the smallest piece gives way to two that fit more tightly."""
    left = Lengths(lengths)
    bins = []
    while left.kinds:
        own, room = [], capacity
        while (length := left.best(room)):
            left.take(length)
            own.append(length)
            room -= length
        if room and left.kinds:
            small = own[-1]
            pair = left.best_two(small + room, small)
            if pair:
                own.pop()
                left.put(small)
                for length in pair:
                    left.take(length)
                own += pair
        bins.append(own)
    return bins


def _pack(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """One part: sequences numbered by the part and the bin."""
    frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32"], ignore_index=True)
    length = frame["length"].to_numpy()
    part = int(frame["part"].iloc[0])
    full = length == capacity
    bins = best_two_fit(length[~full], capacity)
    # The k-th piece of each length, in order, goes to the k-th place of that length.
    sequence = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    placed = np.array([x for b in bins for x in b], np.int64)
    offset = np.concatenate([np.cumsum([0, *b[:-1]]) for b in bins]) if bins else np.zeros(0, np.int64)
    order = np.argsort(placed, kind="stable")
    frame["sequence_id"], frame["offset"] = np.int64(0), np.int64(0)
    frame.loc[~full, "sequence_id"] = sequence[order]
    frame.loc[~full, "offset"] = offset[order]
    frame.loc[full, "sequence_id"] = len(bins) + np.arange(int(full.sum()))
    frame["sequence_id"] += part << 32
    return frame.drop(columns="part")


def pack(rows: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES) -> DataFrame:
    """Pieces with sequence_id and offset; ``rows`` is as ``pieces`` gives them."""
    held = written(rows)
    parts = max(1, -(-held.count() // part_pieces))
    dealt = held.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(parts)))
    return unnamed(dealt.groupBy("part").applyInPandas(lambda frame: _pack(frame, capacity), PACKED), "doc_id")


def packed_sequences(documents: DataFrame, tokenizer: str, end: int = 2, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(documents, tokenizer, end, capacity), capacity)
