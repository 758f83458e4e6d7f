"""Near copies by an exact Jaccard self-join of five-word shingle sets.

Method: universe-partition pigeonhole. Two sets of sizes s <= t with Jaccard >= 0.75 differ
in at most (s + t) / 7 <= 2 t / 7 elements. For each band of sizes the universe is hashed
into m segments. The larger set of a pair gives each segment an allowance: 0 (unused), 1
(the segment must agree) or 2 (it may differ by one element). If the allowances add up to
more than 2 t / 7, some segment keeps within its allowance, so no link is lost. Every set
indexes its segments, and one-deletion neighbours of some. Allowances are given by cost, the
number of sets that share a signature: what few share costs little and is used, and only if
that does not add up, the cheapest of what many share. The choice changes the work, never
the result.

Steps, each a Spark job over narrow data:
1. equal texts become one row (one shuffle of the texts, combined on the map side);
2. each text is turned into packed signatures, dealt by hash bucket; a signature that many
   sets of a block share leaves the bucket as rows of its own, so a hot one is no hot bucket;
3. sets that share a signature become pairs, or groups of members where there are many;
   allowances in large groups are given where they are needed;
4. each set is first compared with the smallest one it may link with and with the first of
   its groups; links give components; only pairs across components are compared after that,
   those of large groups where the groups are, so that no rows are made of them. Groups with
   the same first member are one bundle: near copies share most of their groups, and a set
   travels once a bundle and block;
5. components of all verified links, and of equal texts.

Comparison is exact on the sets of 64-bit shingle hashes. In bands beyond 64 elements, empty
segments are not indexed; the allowances still suffice but for odds below 1e-10 a set.

Null and empty texts have an empty set and link with nothing, not even each other. Rows that
repeat a doc_id count as one document; rows without one are left out. Extra columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from safelabel.llm.graph import components
from safelabel.llm.hashing import batches, mix, shingle_sets, stream
from safelabel.llm.store import broadcast_if_small, fresh_name, remove, written

_U = np.uint64
FLUSH_TOKENS = 600_000
FLUSH_DOCS = 16_000
HEAVY = 48
PAIRS_UP_TO = 64
MARK = 0x3FFF
BROADCAST_IDS = 200_000
FOUND = "kind int, a long, b long, n int, role int"
CELLS = 128
BLOCK_MEMBERS = 4_096
LONG = 2_048
SIZE, PAIR, MEMBER = 0, 1, 2


def allowance(size: np.ndarray) -> np.ndarray:
    """Most elements by which a set of this size differs from a linked set that is not larger."""
    return 2 * size // 7


def plan(top: int) -> tuple[int, int, bool]:
    """(segments, segments with deletions, index empty ones) of the band of sizes below ``top``."""
    need = int(allowance(np.int64(top - 1))) + 1
    if need == 1:
        return 1, 0, True
    m = -(-need * 115 // 100)
    return (m, m, True) if top <= 64 else (m, m * 8 // 100 + 4, False)


def packed(entries: np.ndarray) -> bytes:
    """Sorted 64-bit entries as steps, byte plane by byte plane: the high planes are nearly empty and compress."""
    return np.diff(entries, prepend=_U(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(_U).ravel(), dtype=_U)


class Block:
    """Packed signatures of a block of sets: (bucket, entry), the entry holding hash, place and role."""

    def __init__(self, ids: np.ndarray, tokens: np.ndarray, offsets: np.ndarray):
        self.ids, self.tokens, self.offsets = ids, tokens, offsets
        self.size = np.diff(offsets)
        self.value = mix(tokens + _U(0x51ED270B))

    def band(self, which: np.ndarray, top: int, probe: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, place of the set, deletion?, largest allowance) of the signatures of sets ``which`` in one band."""
        m, deletions, empties = plan(top)
        count = self.size[which]
        begin = np.concatenate([[0], np.cumsum(count)])
        source = np.repeat(self.offsets[which] - begin[:-1], count) + np.arange(begin[-1])
        owner = np.repeat(np.arange(len(which)), count)
        segment = (((self.tokens[source] >> _U(32)) * _U(m)) >> _U(32)).astype(np.int64)
        cell = owner * m + segment  # grows along the sorted tokens
        start = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        total = np.add.reduceat(self.value[source], start) if len(start) else np.zeros(0, _U)
        cells = cell[start]
        if empties:
            lack = np.setdiff1d(np.arange(len(which) * m), cells, assume_unique=True)
            cells = np.concatenate([cells, lack])
            total = np.concatenate([total, np.zeros(len(lack), _U)])
        salt = stream(top, m)
        whole = mix(total + salt[cells % m])
        lengths = np.diff(np.append(start, len(cell)))
        # Where empty segments are not indexed, a single element may not be the one that differs.
        double = (cells % m < deletions) & (empties | (np.append(lengths, np.zeros(len(cells) - len(lengths), np.int64)) > 1))
        level = (1 + double) * probe
        cut = np.repeat(np.arange(len(start)), lengths)
        cut_ok = (segment < deletions) & (np.repeat(lengths, lengths) > (0 if empties else 1))
        rest = mix(total[cut[cut_ok]] - self.value[source[cut_ok]] + salt[segment[cut_ok]])
        return (
            np.concatenate([whole, rest]), which[np.concatenate([cells // m, owner[cut_ok]])],
            np.concatenate([np.zeros(len(cells), bool), np.ones(len(rest), bool)]),
            np.concatenate([level, level[cut[cut_ok]]]),
        )

    def signatures(self) -> tuple[np.ndarray, ...]:
        """All bands: each set in its own, and for larger partners in the next where they reach there."""
        out = []
        top = 1 << np.ceil(np.log2(self.size + 1)).astype(np.int64)  # smallest power of two above the size
        for t in np.unique(top[self.size > 0]):
            own = np.flatnonzero((top == t) & (self.size > 0))
            out.append(self.band(own, int(t), True))
            up = own[4 * self.size[own] >= 3 * t]
            if len(up):
                out.append(self.band(up, int(2 * t), False))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def sign(frames: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """Packed signatures of (doc_id, text) rows: bucket, ids, sizes, entries; heavy ones are rows of bucket -1."""
    ids: list[int] = []
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0

    def flush() -> pd.DataFrame:
        tokens = np.concatenate([p[0] for p in parts])
        sizes = np.concatenate([np.diff(p[1]) for p in parts])
        block = Block(np.array(ids, np.int64), tokens, np.concatenate([[0], np.cumsum(sizes)]))
        room = np.zeros(len(ids), np.int64)
        if len(tokens):
            hashed, place, cut, level = block.signatures()
            np.add.at(room, place[~cut], level[~cut])
        rows = [(-2, block.ids.tobytes(), block.size.astype(np.int32).tobytes(), room.tobytes())]
        if len(tokens):
            bucket = (mix(hashed + _U(77)) % _U(buckets)).astype(np.int64)
            entry = (hashed >> _U(17) << _U(17)) | (place.astype(_U) << _U(3)) | (cut.astype(_U) << _U(2)) | level.astype(_U)
            order = np.lexsort((entry, bucket))
            bucket, entry = bucket[order], entry[order]
            key = entry >> _U(17)
            start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (bucket[1:] != bucket[:-1])]))
            count = np.diff(np.append(start, len(key)))
            heavy = np.repeat(count > HEAVY, count)
            for a in np.flatnonzero(count > HEAVY):
                own = entry[start[a] : start[a] + count[a]]
                at = (own >> _U(3)).astype(np.int64) & MARK
                rows.append((-1, block.ids[at].tobytes(), block.size[at].astype(np.int32).tobytes(), packed(own)))
            marks = start[count > HEAVY]
            bucket = np.concatenate([bucket[~heavy], bucket[marks]])
            entry = np.concatenate([entry[~heavy], key[marks] << _U(17) | _U(MARK << 3)])
            order = np.argsort(bucket, kind="stable")
            bucket, entry = bucket[order], entry[order]
            start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            for a, b in zip(start, np.append(start[1:], len(bucket)), strict=True):
                own = entry[a:b]
                at = (own >> _U(3)).astype(np.int64) & MARK
                used, local = np.unique(at[at != MARK], return_inverse=True)
                fresh = np.full(len(own), MARK, np.int64)
                fresh[at != MARK] = local
                own = np.sort((own & ~_U(MARK << 3)) | fresh.astype(_U) << _U(3))
                rows.append((int(bucket[a]), block.ids[used].tobytes(), block.size[used].astype(np.int32).tobytes(), packed(own)))
        return pd.DataFrame(rows, columns=["bucket", "ids", "sizes", "entries"])

    for frame in frames:
        texts = frame["text"].tolist()
        names = frame["doc_id"].tolist()
        for a, b in batches(texts):
            if held + len(ids) * 100 > FLUSH_TOKENS or len(ids) + b - a > FLUSH_DOCS:
                if ids:
                    yield flush()
                ids, parts, held = [], [], 0
            for c in range(a, b, FLUSH_DOCS):
                if len(ids) + FLUSH_DOCS > MARK and ids and b - a > FLUSH_DOCS:
                    yield flush()
                    ids, parts, held = [], [], 0
                d = min(b, c + FLUSH_DOCS)
                parts.append(shingle_sets(texts[c:d]))
                ids += names[c:d]
                held += len(parts[-1][0])
    if ids:
        yield flush()


def _linkable(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    return 4 * np.minimum(s, t) >= 3 * np.maximum(s, t)


def match(frame: pd.DataFrame) -> pd.DataFrame:
    """Sets of one bucket that share a signature: sizes, pairs, and members of large groups."""
    if frame["bucket"].iloc[0] < 0:
        ids = np.concatenate([np.frombuffer(x, np.int64) for x in frame["ids"]])
        sizes = np.concatenate([np.frombuffer(x, np.int32) for x in frame["sizes"]])
        if frame["bucket"].iloc[0] == -2:
            room = np.concatenate([np.frombuffer(x, np.int64) for x in frame["entries"]])
            return pd.DataFrame({"kind": SIZE, "a": ids, "b": room, "n": sizes, "role": 0})
        entry = np.concatenate([unpacked(x) for x in frame["entries"]])
        return pd.DataFrame({"kind": MEMBER, "a": (entry >> _U(17)).astype(np.int64), "b": ids, "n": sizes, "role": (entry & _U(7)).astype(np.int64)})
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in frame["ids"]])
    sizes = np.concatenate([np.frombuffer(x, np.int32) for x in frame["sizes"]])
    shift = np.concatenate([[0], np.cumsum([len(x) // 8 for x in frame["ids"]])])
    parts = [unpacked(x) for x in frame["entries"]]
    entry = np.concatenate(parts)
    local = (entry >> _U(3)).astype(np.int64) & MARK
    marked = local == MARK
    place = np.where(marked, -1, local + np.repeat(shift[:-1], [len(p) for p in parts]))
    key = entry >> _U(17)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    count = np.diff(np.append(start, len(ranked)))
    shared = np.repeat(count > 1, count)
    order = order[shared]
    key, place, role, marked = key[order], place[order], (entry[order] & _U(7)).astype(np.int64), marked[order]
    size = np.where(marked, 0, sizes[place])
    name = np.where(marked, -(1 << 62), ids[place])
    order = np.lexsort((name, size, key))
    key, size, name, role, marked = key[order], size[order], name[order], role[order], marked[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(start, len(key)))
    hot = marked[start] if len(start) else np.zeros(0, bool)
    large = np.repeat((count > PAIRS_UP_TO) | hot, count)
    out = []
    one = large & ~marked
    if one.any():
        out.append(pd.DataFrame({"kind": MEMBER, "a": key[one].astype(np.int64), "b": name[one], "n": size[one], "role": role[one]}))
    key, size, name, role = key[~large], size[~large], name[~large], role[~large]
    pairs = []
    for k in range(1, PAIRS_UP_TO):
        low = np.flatnonzero(key[k:] == key[:-k]) if len(key) > k else np.zeros(0, np.int64)
        if not len(low):
            break
        high = low + k
        cuts = (role[low] >> 2) + (role[high] >> 2)
        fits = (name[low] != name[high]) & (cuts < 2) & ((role[high] & 3) >= 1 + cuts) & _linkable(size[low], size[high])
        # The later one is the larger; segments that agree count as many steps as they may be given.
        pairs.append(np.stack([name[low[fits]], name[high[fits]], np.where(cuts[fits] > 0, 1, role[high[fits]] & 3)]))
    if pairs:
        low, high, steps = np.concatenate(pairs, axis=1)
        order = np.lexsort((low, high))
        low, high, steps = low[order], high[order], steps[order]
        start = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])) if len(low) else np.zeros(0, np.int64)
        steps = np.add.reduceat(steps, start) if len(start) else steps
        out.append(pd.DataFrame({"kind": PAIR, "a": low[start], "b": high[start], "n": steps, "role": 0}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("kind", "a", "b", "n", "role")})


def outline(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc, cells, tokens) of (doc_id, text): elements per cell of the universe, and the set if it is not long."""
    for frame in frames:
        names, texts = frame["doc_id"].tolist(), frame["text"].tolist()
        for a, b in batches(texts):
            values, offsets = shingle_sets(texts[a:b])
            size = np.diff(offsets)
            at = np.repeat(np.arange(b - a), size) * CELLS + (mix(values) % _U(CELLS)).astype(np.int64)
            cells = np.minimum(np.bincount(at, minlength=(b - a) * CELLS), 255).astype(np.uint8).reshape(b - a, CELLS)
            tokens = [values[offsets[k] : offsets[k + 1]].tobytes() if size[k] <= LONG else None for k in range(b - a)]
            yield pd.DataFrame({"doc": names[a:b], "cells": [x.tobytes() for x in cells], "tokens": tokens})


def near_members(frame: pd.DataFrame) -> pd.DataFrame:
    """Links that join components within a bundle of groups, or across two blocks of one, and pairs of long sets that may link.

    Only what is asked for is compared, and a pair once, however many groups it shares. Cells
    that differ by a total of d mean sets that differ in d elements or more; where that leaves
    a pair open, the sets are compared here. A link between parts that are joined by then is
    not looked for: a bundle gives less links than it has members. Sets beyond ``LONG`` do not
    travel; their pairs are given as not linked yet.
    """
    frame = frame.sort_values(["n", "doc"], ignore_index=True)
    n, doc, block = (frame[x].to_numpy() for x in ("n", "doc", "block"))
    part = np.unique(frame["c"].to_numpy(), return_inverse=True)[1]
    cells = np.frombuffer(b"".join(frame["cells"]), np.uint8).reshape(-1, CELLS).astype(np.int16)
    held = [np.frombuffer(x, _U) if x else np.zeros(0, _U) for x in frame["tokens"]]
    length = np.array([len(x) for x in held])
    begin = np.concatenate([[0], np.cumsum(length)])
    names, code = np.unique(np.concatenate(held), return_inverse=True)
    mark = np.zeros(len(names) + 1, bool)
    crossing = frame["low"].iat[0] != frame["high"].iat[0]
    # Members of each group in order of size, and where each set stands in its groups.
    member = np.repeat(np.arange(len(frame)), [len(x) for x in frame["gs"]])
    group = np.unique(np.concatenate(frame["gs"].to_list()), return_inverse=True)[1]
    role = np.concatenate(frame["roles"].to_list()).astype(np.int64)
    order = np.lexsort((role, member, group))
    member, group, role = member[order], group[order], role[order]
    first = np.searchsorted(group, np.arange(int(group.max()) + 1))
    asks = np.flatnonzero(role & 3)
    asks = asks[np.argsort(member[asks], kind="stable")]
    near = np.zeros(len(frame), bool)
    out = []
    for own_asks in np.split(asks, np.flatnonzero(np.diff(member[asks])) + 1) if len(asks) else ():
        i = int(member[own_asks[0]])
        least = int(np.searchsorted(n, -(-3 * n[i] // 4)))
        near[:] = False
        for at in own_asks:
            low = first[group[at]]
            low += np.searchsorted(member[low:at], least)
            near[member[low:at][(role[low:at] >> 2) + (role[at] >> 2) < min(2, role[at] & 3)]] = True
        y = np.flatnonzero(near & (part != part[i]) & (doc != doc[i]))
        y = y[block[y] != block[i]] if crossing else y
        y = y[np.abs(cells[y] - cells[i]).sum(axis=1) <= (n[y] + n[i]) // 7]
        if not len(y):
            continue
        if n[i] > LONG:
            out += [(doc[k], doc[i], False) for k in y]
            continue
        own = code[begin[i] : begin[i + 1]]
        mark[own] = True
        edge = np.concatenate([[0], np.cumsum(length[y])])
        both = np.add.reduceat(mark[code[np.repeat(begin[y] - edge[:-1], length[y]) + np.arange(edge[-1])]].astype(np.int64), edge[:-1])
        mark[own] = False
        for k in y[100 * both >= 75 * (n[y] + n[i] - both)]:
            if part[k] != part[i]:
                part[part == part[k]] = part[i]
                out.append((doc[k], doc[i], True))
    pairs = pd.DataFrame(dict.fromkeys(out), columns=["x", "y", "linked"])
    return pd.DataFrame({"a": pairs[["x", "y"]].min(axis=1), "b": pairs[["x", "y"]].max(axis=1), "linked": pairs["linked"]})


def _verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        left, right = frame["left"].tolist(), frame["right"].tolist()
        keep = np.zeros(len(frame), bool)
        for x, y in batches([a + b for a, b in zip(left, right, strict=True)]):
            texts = list(dict.fromkeys(left[x:y] + right[x:y]))
            place = {t: i for i, t in enumerate(texts)}
            values, offsets = shingle_sets(texts)
            for i in range(x, y):
                a, b = place[left[i]], place[right[i]]
                own, other = values[offsets[a] : offsets[a + 1]], values[offsets[b] : offsets[b + 1]]
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep[i] = both > 0 and 100 * both >= 75 * (len(own) + len(other) - both)
        yield frame.loc[keep, ["a", "b"]]


def named_texts(names: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (doc_id, text) that ``names`` (doc_id) holds; only they are moved."""
    named = written(names.distinct())
    return texts.join(broadcast_if_small(named, named.count(), BROADCAST_IDS), "doc_id", "left_semi")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of a written table whose texts link."""
    held = named_texts(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), texts)
    left = held.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    right = held.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    return pairs.join(left, "b").join(right, "a").select("a", "b", "left", "right").mapInPandas(_verify, "a long, b long")


def _pair(x: str, y: str, side: str) -> Column:
    return (F.least(x, y) if side == "a" else F.greatest(x, y)).alias(side)


def _named(groups: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of groups, one row a document (doc, n, gs, roles), with the component ``c``."""
    return groups.join(parts.select(F.col("node").alias("doc"), "component"), "doc", "left").select("doc", "n", "gs", "roles", F.coalesce("component", "doc").alias("c"))


def _members(groups: DataFrame) -> DataFrame:
    """One row a group and member."""
    zipped = F.explode(F.arrays_zip(F.col("gs").alias("g"), F.col("roles").alias("role"))).alias("m")
    return groups.select(*[c for c in groups.columns if c not in ("gs", "roles")], zipped).select("*", "m.g", "m.role").drop("m")


def gathered(found: DataFrame) -> DataFrame:
    """Large groups of each set, one row a document: (doc, t, mine: [(k, g, role)], lost, room).

    ``k`` is the size of the group; ``lost`` are the steps of the set that fall into such groups, at most.
    """
    members = found.where(f"kind = {MEMBER}").select(F.col("a").alias("g"), F.col("b").alias("doc"), "n", "role").distinct()
    sizes = members.groupBy("g").agg(F.count("*").alias("k")).where("k > 1")
    mine = members.join(sizes, "g").groupBy("doc").agg(F.max("n").alias("t"), F.sort_array(F.collect_list(F.struct("k", "g", "role"))).alias("mine"))
    room = found.where(f"kind = {SIZE}").select(F.col("a").alias("doc"), F.col("b").alias("room"))
    lost = F.expr("aggregate(mine, 0L, (s, m) -> s + case when m.role in (1, 2) then m.role when m.role > 4 then 1 else 0 end)")
    return mine.withColumn("lost", lost).join(room, "doc")


def counted_pairs(found: DataFrame, mine: DataFrame) -> DataFrame:
    """Pairs (a < b) of small groups that share enough steps to be linked.

    A linked pair misses at most 2 t / 7 of the larger set's steps, so it shares the rest, but
    for steps in large groups, which are not counted.
    """
    shared = found.where(f"kind = {PAIR}").groupBy("a", "b").agg(F.sum("n").alias("steps"))
    room = found.where(f"kind = {SIZE}").select(F.col("a").alias("b"), F.col("b").alias("room"), F.col("n").alias("t"))
    lost = mine.select(F.col("doc").alias("b"), "lost")
    needed = room.join(lost, "b", "left").select("b", F.expr("room - coalesce(lost, 0) - div(2 * t, 7)").alias("needed"))
    return shared.join(needed, "b").where("steps >= needed").select(_pair("a", "b", "a"), _pair("a", "b", "b"))


def allotted(mine: DataFrame) -> DataFrame:
    """Large groups of each set, one row a document (doc, n, gs, roles), with allowances in the roles where a set has to ask.

    All steps of a set in small groups are used, at their small cost. What is missing of its
    sum of allowances is made up by the segments of its smallest large groups; if those do
    not suffice, by all it has. Groups where nobody asks are left out.
    """
    lack = F.expr("div(2 * t, 7) + 1 - (room - lost)")
    told = mine.withColumn("lack", lack).withColumn("whole", F.expr("filter(mine, m -> m.role in (1, 2))"))
    place = "case when m.role in (1, 2) and array_position(whole, m) <= lack then 1 else 0 end"
    level = f"case when lack <= 0 then 0 when size(whole) < lack then m.role % 4 else {place} end"
    told = told.select("doc", F.col("t").alias("n"), F.expr("transform(mine, m -> m.g)").alias("gs"),
                       F.expr(f"transform(mine, m -> cast(shiftright(m.role, 2) * 4 + {level} as int))").alias("roles"))
    told = written(told)
    asked = _members(told).groupBy("g").agg(F.max(F.col("role") % 4).alias("most")).where("most > 0").select("g")
    kept = _members(told).join(asked, "g", "left_semi").groupBy("doc", "n").agg(F.collect_list(F.struct("g", "role")).alias("m"))
    out = written(kept.select("doc", "n", F.col("m.g").alias("gs"), F.col("m.role").alias("roles")))
    remove(told)
    return out


def near_copies(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, representative) of every document; see the module."""
    source = documents.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = source.select("doc_id", "text", F.md5("text").alias("print"))
    members = written(keyed.groupBy("doc_id").agg(F.min("print").alias("print"), F.max(F.octet_length("text")).cast("long").alias("bytes")))
    first = written(members.groupBy("print").agg(F.min("doc_id").alias("rep"), F.max("bytes").alias("bytes")))
    total = first.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(12, total >> 24)

    texts = keyed.groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.any_value("text").alias("text")).select("doc_id", "text")
    packed = texts.mapInPandas(lambda frames: sign(frames, buckets), "bucket int, ids binary, sizes binary, entries binary")
    spread = packed.withColumn("part", F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("ids"), F.lit(buckets))).otherwise(0))
    found = written(
        spread.groupBy("bucket", "part").applyInPandas(lambda frame: match(frame), FOUND)
    )
    sizes = found.where(f"kind = {SIZE}").select(F.col("a").alias("rep"), F.col("n").cast("long").alias("n_shingles"))

    mine = written(gathered(found))
    groups = allotted(mine)
    pairs = written(counted_pairs(found, mine))
    remove(mine)

    # First, each document with the smallest one it may link with, and members of a group with its first.
    in_groups = _members(groups)
    first_of = in_groups.groupBy("g").agg(F.min(F.struct("doc", "n")).alias("c"))
    star = in_groups.join(first_of, "g").where("doc <> c.doc and 4 * least(n, c.n) >= 3 * greatest(n, c.n)")
    nearest = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    tried = written(nearest.union(star.select(_pair("doc", "c.doc", "a"), _pair("doc", "c.doc", "b"))).distinct())
    links = written(verified(tried, source))
    parts = written(components(links))
    # Then members with the first of another component in the group.
    named = _members(_named(groups, parts))
    other = named.join(named.groupBy("g").agg(F.min_by("c", "doc").alias("low")), "g").where("c <> low").groupBy("g").agg(F.min(F.struct("doc", "n", "c")).alias("c2"))
    star = named.join(other, "g").where("c <> c2.c and 4 * least(n, c2.n) >= 3 * greatest(n, c2.n)")
    again = written(star.select(_pair("doc", "c2.doc", "a"), _pair("doc", "c2.doc", "b")).distinct().join(tried, ["a", "b"], "left_anti"))
    if not again.isEmpty():
        links = written(links.union(verified(again, source)))
        parts = written(components(links))
        tried = tried.union(again)
    # Last, all that is left across components. A bundle is split into blocks of bounded size.
    label = parts.select(F.col("node").alias("doc"), "component")
    in_a = label.select(F.col("doc").alias("a"), F.col("component").alias("ca"))
    in_b = label.select(F.col("doc").alias("b"), F.col("component").alias("cb"))
    across = pairs.join(in_a, "a", "left").join(in_b, "b", "left").where("coalesce(ca, a) <> coalesce(cb, b)").select("a", "b")
    named = _members(_named(groups, parts))
    divided = named.groupBy("g").agg(F.min("c").alias("least"), F.max("c").alias("most"), F.min("doc").alias("bundle")).where("least <> most")
    mixed = named.join(divided.select("g", "bundle"), "g").groupBy("bundle", "doc", "n", "c").agg(F.collect_list(F.struct("g", "role")).alias("m"))
    mixed = written(mixed.select("bundle", "doc", "n", "c", F.col("m.g").alias("gs"), F.col("m.role").alias("roles")))
    sized = mixed.join(mixed.groupBy("bundle").agg(F.count("*").alias("k")), "bundle")
    outlines = written(named_texts(mixed.select(F.col("doc").alias("doc_id")), source).mapInPandas(outline, "doc long, cells binary, tokens binary"))
    blocks = sized.withColumn("blocks", F.ceil(F.col("k") / BLOCK_MEMBERS)).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    columns = ["block", "doc", "n", "c", "gs", "roles"]
    one = blocks.where("blocks = 1").select("bundle", F.col("block").alias("low"), F.col("block").alias("high"), *columns)
    many = blocks.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = one.union(many.select("bundle", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), *columns))
    rest = written(met.join(outlines, "doc").groupBy("bundle", "low", "high").applyInPandas(lambda frame: near_members(frame), "a long, b long, linked boolean"))
    remove(outlines, mixed)
    links = links.union(rest.where("linked").select("a", "b"))
    remaining = written(across.union(rest.where("not linked").select("a", "b")).distinct().join(tried, ["a", "b"], "left_anti"))
    links = links.union(verified(remaining, source))
    parts = components(written(links))
    named = first.select("print", "rep").join(sizes, "rep", "left").join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = named.select("print", "rep", F.coalesce("n_shingles", F.lit(0)).cast("long").alias("n_shingles"), F.coalesce("component", "rep").alias("component"))
    joined = members.join(named, "print")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("same_text_id"),
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """The documents with one of each group of near copies: the one with the smallest doc_id; columns as they were.

    Rows without a doc_id cannot be compared by it and stay. Rows of one doc_id stay or go together.
    """
    name = fresh_name(documents, "kept_id")
    first = near_copies(documents).where("component_id = doc_id").select(F.col("doc_id").alias(name))
    kept = documents.where("doc_id is not null")
    return kept.join(first, kept["doc_id"].cast("long") == first[name], "left_semi").union(documents.where("doc_id is null"))
