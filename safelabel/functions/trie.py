"""Terms in texts: a trie over UTF-8 bytes, walked by all places of a block of texts at once."""

from __future__ import annotations

import numpy as np

# Stands between texts; no UTF-8 text has this byte, so no term goes on beyond it.
END = 0xFF
# Places that walk at a time.
WALKERS = 1 << 18
NONE = np.iinfo(np.int32).max
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class TermTrie:
    """Distinct terms without the empty one, numbered as given.

    The first two bytes of a place are looked up in tables, all further steps in a hash table
    whose keys are a state and a byte.
    """

    def __init__(self, terms: list[str]):
        self.size = len(terms)
        edges, accept = {}, [-1]
        for number, term in enumerate(terms):
            state = 0
            for byte in term.encode():
                following = edges.get(state << 8 | byte)
                if following is None:
                    following = edges[state << 8 | byte] = len(accept)
                    accept.append(-1)
                state = following
            accept[state] = number
        self.accept = np.array(accept, np.int32)
        keys, states = (np.fromiter(x, np.int64, len(edges)) for x in (edges.keys(), edges.values()))
        self.shift = np.uint64(64 - max(4, (4 * len(edges)).bit_length()))
        self.keys = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        self.states = np.zeros(len(self.keys), np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.states[slots[placed]] = states[placed]
            keys, states, slots = keys[~placed], states[~placed], self._next(slots[~placed])
        every = np.arange(256)
        self.one = self._follow(np.zeros(256, np.int64), every)
        self.two = self._follow(np.repeat(self.one, 256).astype(np.int64), np.tile(every, 256))
        self.two[np.repeat(self.one == 0, 256)] = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def _next(self, slots: np.ndarray) -> np.ndarray:
        return (slots + 1) & (len(self.keys) - 1)

    def _follow(self, states: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The states that these go to by these bytes; 0 where there is none."""
        keys = states << 8 | data
        slots = self._slots(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.states[slots], 0)
        again = np.flatnonzero((there != keys) & (there >= 0))
        while len(again):
            slots[again] = self._next(slots[again])
            there = self.keys[slots[again]]
            same = there == keys[again]
            out[again[same]] = self.states[slots[again[same]]]
            again = again[~same & (there >= 0)]
        return out

    def _matches(self, data: np.ndarray, start: int, stop: int):
        """Places from ``start`` to before ``stop`` with the terms that begin there, a length at a time."""
        places = np.arange(start, stop)
        first = self.accept[self.one[data[start:stop]]]
        yield places[first >= 0], first[first >= 0]
        states = self.two[data[start:stop].astype(np.int32) << 8 | data[start + 1 : stop + 1]]
        depth = 2
        while len(alive := np.flatnonzero(states)):
            places, states = places[alive], states[alive]
            terms = self.accept[states]
            yield places[terms >= 0], terms[terms >= 0]
            states = self._follow(states.astype(np.int64), data[places + depth])
            depth += 1

    def first_places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, place) of each text and term in it: numbers, and the first place in code points from 0."""
        data = np.frombuffer(bytes([END]).join([*texts, b"", b""]), np.uint8)
        starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in texts])
        found = np.full(len(texts) * self.size, NONE, np.int32)
        stop = len(owner)
        for start in reversed(range(0, stop, WALKERS)):  # earlier places last, as they replace later ones
            for places, terms in self._matches(data, start, min(start + WALKERS, stop)):
                found[owner[places[::-1]] * np.int64(self.size) + terms[::-1]] = places[::-1]
        held = np.flatnonzero(found != NONE)
        text, term = np.divmod(held, self.size)
        points = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32)
        return text, term, points[found[held]] - points[starts[text]]
