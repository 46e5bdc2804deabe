"""Minimal acyclic transducers: sorted words to their places in the order, as arrays that whole batches of text run through."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def build(words: Iterable[bytes]) -> dict[str, np.ndarray]:
    """The transducer of distinct words given in ascending order.

    The path of the last word is open; where the next word leaves it, the states below are closed and replaced by an equal state if there
    is one, so the result is minimal. The output of an edge is the number of words that come before all words through it, so the sum along a
    path is the word's place. States are numbered from the leaves up; the last one is the root.
    """
    known: dict[tuple, int] = {}
    count: list[int] = []
    path: list[list] = [[False, []]]  # per depth: is a word's end; closed edges (label, target)
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth:
            final, edges = path.pop()
            key = (final, tuple(edges))
            state = known.get(key)
            if state is None:
                state = known[key] = len(count)
                count.append(final + sum(count[t] for _, t in edges))
            if path:
                path[-1][1].append((last[len(path) - 1], state))

    for word in words:
        shared = 0
        for a, b in zip(last, word):
            if a != b:
                break
            shared += 1
        close(shared + 1)
        path.extend([False, []] for _ in range(len(word) - shared))
        path[-1][0] = True
        last = word
    close(0)
    start, label, target, output = [0], [], [], []
    for final, edges in known:
        before = int(final)
        for byte, state in edges:
            label.append(byte)
            target.append(state)
            output.append(before)
            before += count[state]
        start.append(len(label))
    return {
        "start": np.array(start, np.int32), "label": np.array(label, np.uint8), "target": np.array(target, np.int32),
        "output": np.array(output, np.int32), "final": np.fromiter((f for f, _ in known), bool, len(known)),
    }


class Transducer:
    """Looks words up, many at a time."""

    def __init__(self, parts: dict[str, np.ndarray], base: int = 0):
        self.start, self.label, self.target, self.output, self.final = (parts[k] for k in ("start", "label", "target", "output", "final"))
        self.base, self.root = base, len(self.final) - 1
        # the edges as an open hash table over (state, byte), at most half full
        bits = max(4, int(2 * len(self.label)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        self.edge = np.zeros(1 << bits, np.int32)
        left = np.arange(len(self.label))
        keys = np.repeat(np.arange(len(self.final), dtype=np.int64), np.diff(self.start)) << 8 | self.label
        place = self._place(keys)
        while len(left):
            free = self.key[place[left]] < 0
            self.key[place[left][free]] = keys[left][free]  # of several for one place the last stays
            won = self.key[place[left]] == keys[left]
            self.edge[place[left][won]] = left[won]
            left = left[~won]
            place[left] = place[left] + 1 & self.mask

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def _edges(self, keys: np.ndarray) -> np.ndarray:
        """The edge of each (state, byte), -1 where there is none."""
        place = self._place(keys)
        found = self.key[place]
        out = np.where(found == keys, self.edge[place], -1)
        left = np.flatnonzero((found != keys) & (found >= 0))
        place = place[left]
        while len(left):
            place = place + 1 & self.mask
            found = self.key[place]
            hit = found == keys[left]
            out[left[hit]] = self.edge[place[hit]]
            on = ~hit & (found >= 0)
            left, place = left[on], place[on]
        return out

    def places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The place of each word ``data[start:end]`` in the whole order, -1 for a word that is not there.

        All words go one byte ahead together; one that has no edge is out.
        """
        out = np.full(len(start), -1, np.int64)
        if self.root < 0:
            return out
        who, at, till = np.arange(len(start)), start, end
        state, place = np.full(len(start), self.root, np.int64), np.zeros(len(start), np.int64)
        while len(who):
            over = at == till
            if over.any():
                done = over & self.final[state]
                out[who[done]] = place[done] + self.base
                on = ~over
                who, at, till, state, place = who[on], at[on], till[on], state[on], place[on]
                if not len(who):
                    break
            edge = self._edges(state << 8 | data[at])
            on = edge >= 0
            if not on.all():
                who, at, till, place, edge = who[on], at[on], till[on], place[on], edge[on]
            state, place, at = self.target[edge].astype(np.int64), place + self.output[edge], at + 1
        return out

    def word(self, place: int) -> bytes:
        """The word at a place: from each state along the last edge whose output is not beyond it."""
        left, state, out = place - self.base, self.root, bytearray()
        while not (self.final[state] and left == 0):
            low, high = self.start[state], self.start[state + 1]
            edge = low + int(np.searchsorted(self.output[low:high], left, "right")) - 1
            out.append(self.label[edge])
            left -= int(self.output[edge])
            state = self.target[edge]
        return bytes(out)

    def __len__(self) -> int:
        """The number of words."""
        if self.root < 0:
            return 0
        state, n = self.root, 0
        while self.start[state + 1] > self.start[state]:
            edge = self.start[state + 1] - 1
            n, state = n + int(self.output[edge]), self.target[edge]
        return n + int(self.final[state])
