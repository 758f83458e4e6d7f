"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

Items are partitioned by the size of their shingle set: partition p holds sizes in
(2^(p-1), 2^p]. For each partition that has items, a document is read as windows of 2^(p+1)
shingles, 2^p apart, so that any passage of item length lies inside one window and the
Jaccard similarity of an item and the window that holds it is bounded below, however long
the document is. Windows and items are compared by ``PERMUTATIONS`` MinHash values, a match
of one value making a candidate (bands of one row: an equal value is an equal shingle, so
false candidates are few). Window minima of larger partitions are minima of smaller ones.

A candidate is verified in the same task: its item's five-word shingles are looked up in the
shingle set of the whole document, and at least ``threshold`` of them must be there. With a
containment of 0.75 in a window, the search misses an item with odds below 1 in 400 where
the window is the largest possible; contiguous copies have far better odds.

Only item signatures are sent to the tasks, ``BLOCK_ITEMS`` items at a time, so what is
broadcast has a fixed bound; documents are read once for each block of items and never
shuffled. The result grows with the number of leaks.

Null and empty documents or items match nothing. Items with fewer than five words are one
shingle and match documents that are exactly that sequence. Repeated rows give repeated
results. Extra columns are ignored. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from safelabel.llm.hashing import batches, distinct, shingle_sets, shingles, stream, word_hashes

_U = np.uint64
PERMUTATIONS = 32
BLOCK_ITEMS = 50_000
PREFIX = 18  # leading bits by which most window values are told apart from all items
LEAKS = "doc_id long, item_id long, n_item_shingles int, n_shared int"
_STEPS = stream(5, PERMUTATIONS) | _U(1)


class Signatures:
    """MinHash values of a block of items, by size partition."""

    def __init__(self, items: list[tuple[int, str]]):
        self.names = [i for i, _ in items]
        values, offsets = shingle_sets([t for _, t in items])
        self.sets = [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.parts = {}
        sizes = np.diff(offsets)
        level = np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
        for p in sorted(set(level[sizes > 0].tolist())):
            own = np.flatnonzero((level == p) & (sizes > 0))
            self.parts[p] = own
        self.tables = {}
        for p, own in self.parts.items():
            minima = np.stack([[(self.sets[i] * step).min() for i in own] for step in _STEPS])
            tables = []
            for row in minima:
                order = np.argsort(row)
                maybe = np.zeros(1 << PREFIX, bool)
                maybe[row >> _U(64 - PREFIX)] = True
                tables.append((row[order], own[order], maybe))
            self.tables[p] = tables

    def candidates(self, runs: np.ndarray, offsets: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) places whose MinHash values meet in some window."""
        out: set[tuple[int, int]] = set()
        counts = np.diff(offsets)
        held = np.flatnonzero(counts)
        if not len(held) or not self.parts:
            return out
        for k, step in enumerate(_STEPS):
            hashed = runs * step
            length = 1
            owner = np.repeat(np.arange(len(counts)), counts)
            for p in self.parts:
                width = 1 << p
                if length == 1 or width > length:
                    # Block minima of this partition from those of the smaller one.
                    per = width // length
                    first = np.searchsorted(owner, np.arange(len(counts)))
                    place = np.arange(len(owner)) - first[owner]
                    start = np.flatnonzero(place % per == 0)
                    hashed, owner, length = np.minimum.reduceat(hashed, start), owner[start], width
                windows = hashed.copy()
                same = owner[1:] == owner[:-1]
                windows[:-1][same] = np.minimum(hashed[:-1][same], hashed[1:][same])
                values, items, maybe = self.tables[p][k]
                at = np.flatnonzero(maybe[windows >> _U(64 - PREFIX)])
                low, high = np.searchsorted(values, windows[at], "left"), np.searchsorted(values, windows[at], "right")
                for i in np.flatnonzero(high > low):
                    out.update((int(owner[at[i]]), int(j)) for j in items[low[i] : high[i]])
        return out


def _search(frames: Iterator[pd.DataFrame], signatures: Signatures, threshold: int) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts, ids = frame["text"].tolist(), frame["doc_id"].tolist()
        out = []
        for a, b in batches(texts):
            runs, offsets = shingles(*word_hashes(texts[a:b]))
            found = sorted(signatures.candidates(runs, offsets))
            for d in sorted({d for d, _ in found}):
                own = distinct(runs[offsets[d] : offsets[d + 1]], np.array([0, offsets[d + 1] - offsets[d]]))[0]
                for item in [i for e, i in found if e == d]:
                    wanted = signatures.sets[item]
                    both = int((own[np.minimum(np.searchsorted(own, wanted), len(own) - 1)] == wanted).sum())
                    if both and 100 * both >= threshold * len(wanted):
                        out.append((ids[a + d], signatures.names[item], len(wanted), both))
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "n_item_shingles", "n_shared"])


def leaks(documents: DataFrame, benchmark: DataFrame, threshold: int = 75) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared) of items of which ``threshold`` % of the shingles are in a document."""
    spark = documents.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long"), "text")
    rows = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), "text")
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    found = None
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()
        sent = spark.sparkContext.broadcast(Signatures([(r[0], r[1]) for r in own]))
        part = rows.mapInPandas(lambda frames, sent=sent: _search(frames, sent.value, threshold), LEAKS)
        found = part if found is None else found.union(part)
    return found


def clean(documents: DataFrame, benchmark: DataFrame, threshold: int = 75) -> DataFrame:
    """The documents that hold no item; columns as they were."""
    found = leaks(documents, benchmark, threshold).select(F.col("doc_id").alias("leaked_id")).distinct()
    return documents.join(found, documents["doc_id"].cast("long") == found["leaked_id"], "left_anti")
