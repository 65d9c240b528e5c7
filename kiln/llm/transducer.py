"""Weighted acyclic automata over n-grams of one length, on flat arrays.

Built from sorted n-grams: a state begins wherever a prefix differs from the
one before it; then, from the last word backwards, states with the same
continuations become one. Every path has a number (the paths in front of it in
sorted order), which arcs add up, and the count of an n-gram is the weight with
its number. States are shared within a prefix range only, so the ranges of one
shard are cut out of one build and travel alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kiln.llm.textbytes import mix


def squeeze(parts: list[np.ndarray]) -> bytes:
    """Integer arrays as one compressed value."""
    sizes = np.array([len(parts), *map(len, parts)], np.int64)
    body = np.concatenate([sizes, *(p.astype(np.int64, copy=False) for p in parts)]).tobytes()
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def spread(packed: bytes) -> list[np.ndarray]:
    body = pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True)
    x = np.frombuffer(body, np.int64)
    n = int(x[0])
    return np.split(x[1 + n:], np.cumsum(x[1:1 + n])[:-1])


def _classes(first: np.ndarray, labels: np.ndarray, targets: np.ndarray, route: np.ndarray) -> np.ndarray:
    """For each state the first state of its range with the same arcs (``first``: where arcs begin, and their end)."""
    size = np.diff(first)
    place = np.arange(len(labels)) - np.repeat(first[:-1], size)
    u = np.uint64
    h = mix(mix(labels.astype(u)) + mix(targets.astype(u) * u(2) + u(1)) * u(3) + mix(place.astype(u) * u(2)))
    sign = mix(np.add.reduceat(h, first[:-1]) + mix(route.astype(u) * u(2) + u(1)) + size.astype(u))
    _, begin, own = np.unique(sign, return_index=True, return_inverse=True)
    like = begin[own]
    # equal signatures are held against the arcs themselves; a state that differs stays alone
    same = (size == size[like]) & (route == route[like])
    other = np.repeat(np.where(same, first[:-1][like], first[:-1]), size) + place
    wrong = (labels != labels[other]) | (targets != targets[other])
    same &= np.add.reduceat(wrong.astype(np.int64), first[:-1]) == 0
    return np.where(same, like, np.arange(len(size)))


class Transducer:
    """``arcs[d]``: (where each state's arcs begin, labels, targets) at depth d; the only state at depth 0 is 0."""

    def __init__(self, arcs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], weights: np.ndarray):
        self.arcs, self.weights = arcs, weights

    @staticmethod
    def pieces(grams: np.ndarray, weights: np.ndarray, route: np.ndarray) -> Iterator[tuple[int, "Transducer"]]:
        """(range, automaton) for each value of ``route``; rows are sorted by (route, gram) and differ."""
        rows, n = grams.shape
        if not rows:
            return
        new = np.ones(rows, bool)
        new[1:] = route[1:] != route[:-1]
        starts = [new]  # starts[d]: rows that begin a prefix of d words (of 0: a range)
        for d in range(n):
            new = new.copy()
            new[1:] |= grams[1:, d] != grams[:-1, d]
            starts.append(new)
        states = [np.flatnonzero(s) for s in starts]
        target = np.zeros(rows, np.int64)  # of arcs at the depth at hand
        built: list = [None] * n
        kept_before = None  # of the states below: which are left
        for d in range(n - 1, -1, -1):
            at = states[d + 1]  # one arc for each prefix of d + 1 words
            labels = grams[at, d]
            first = np.append(np.searchsorted(at, states[d]), len(at))
            own_route = route[states[d]]
            like = _classes(first, labels, target, own_route) if d else np.arange(len(states[d]))
            left = np.flatnonzero(like == np.arange(len(like)))
            number = np.zeros(len(like), np.int64)
            number[left] = np.arange(len(left))
            size = np.diff(first)[left]
            arcs = np.repeat(first[:-1][left] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            built[d] = (np.append(0, np.cumsum(size)), labels[arcs], target[arcs], own_route[left])
            target = number[like]
        cuts = np.append(states[0], rows)
        ranges = route[states[0]]
        edges = [np.append(np.searchsorted(b[3], ranges), len(b[3])) for b in built]
        for k, r in enumerate(ranges):
            arcs = []
            for d, (first, labels, targets, _) in enumerate(built):
                a, b = edges[d][k], edges[d][k + 1]
                below = edges[d + 1][k] if d + 1 < n else 0
                arcs.append((first[a:b + 1] - first[a], labels[first[a]:first[b]], targets[first[a]:first[b]] - below))
            yield int(r), Transducer(arcs, weights[cuts[k]:cuts[k + 1]])

    @staticmethod
    def of(grams: np.ndarray, weights: np.ndarray) -> "Transducer":
        return next(x for _, x in Transducer.pieces(grams, weights, np.zeros(len(grams), np.int64)))

    def dump(self) -> bytes:
        return squeeze([self.weights] + [x for first, labels, targets in self.arcs for x in (np.diff(first), labels, targets)])

    @staticmethod
    def load(packed: bytes) -> "Transducer":
        weights, *rest = spread(packed)
        return Transducer([(np.append(0, np.cumsum(rest[k])), rest[k + 1], rest[k + 2]) for k in range(0, len(rest), 3)], weights)

    def paths(self) -> np.ndarray:
        """All n-grams in order."""
        state = np.zeros(1, np.int64)
        columns: list[np.ndarray] = []
        for first, labels, targets in self.arcs:
            size = np.diff(first)[state]
            arc = np.repeat(first[state] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            columns = [np.repeat(c, size) for c in columns] + [labels[arc]]
            state = targets[arc]
        return np.stack(columns, axis=1)

    def weights_of(self, grams: np.ndarray) -> np.ndarray:
        """The automaton composed with n-grams: the weight of each, 0 where it accepts none."""
        below = np.ones(1, np.int64)  # paths from each state to the end
        skip: list[np.ndarray] = []
        for first, _, targets in reversed(self.arcs):
            n = below[targets]
            total = np.append(0, np.cumsum(n))
            skip.append(total[:-1] - np.repeat(total[first[:-1]], np.diff(first)))
            below = total[first[1:]] - total[first[:-1]]
        state, number = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
        found = np.ones(len(grams), bool)
        for d, ((first, labels, targets), add) in enumerate(zip(self.arcs, reversed(skip))):
            names = np.unique(labels)
            place = np.minimum(np.searchsorted(names, grams[:, d]), len(names) - 1)
            found &= names[place] == grams[:, d]
            keys = np.repeat(np.arange(len(first) - 1), np.diff(first)) * len(names) + np.searchsorted(names, labels)
            want = state * len(names) + place
            arc = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            found &= keys[arc] == want
            state, number = np.where(found, targets[arc], 0), number + np.where(found, add[arc], 0)
        return np.where(found, self.weights[np.where(found, number, 0)], 0)


def distinct(columns: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of small numbers below ``width`` in order, and each row's place among them."""
    place = columns[:, 0].astype(np.int64)
    table = np.arange(width)[:, None]
    for k in range(1, columns.shape[1]):
        keys, place = np.unique(place * width + columns[:, k], return_inverse=True)
        table = np.concatenate((table[keys // width], (keys % width)[:, None]), axis=1)
    return table, place


def union(parts: list[Transducer]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-grams of several automata in order, their summed weights, and the place of every part's paths among them."""
    grams = np.concatenate([p.paths() for p in parts])
    weights = np.concatenate([p.weights for p in parts])
    names = np.unique(grams)
    table, place = distinct(np.searchsorted(names, grams), len(names))
    order = np.argsort(place, kind="stable")
    begin = np.searchsorted(place[order], np.arange(len(table)))
    return names[table], np.add.reduceat(weights[order], begin), place
