"""Front-coded sorted runs and their merge by a loser tree.

A run is a sorted list of byte strings; each is stored as the length it shares
with the one before it and the rest.  The merge keeps, for every run's current
string, its common prefix with the last string put out.  Of two strings the one
that shares more with the last output is smaller; only if both share equally
much are bytes looked at, from that length on.  No known prefix is compared
again, and each output comes with its common prefix with the one before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def common_prefixes(strings: list[bytes]) -> np.ndarray:
    """Common prefix of each string with the one before it (0 for the first)."""
    out = np.zeros(len(strings), np.int32)
    for at in range(1, len(strings), 8192):
        part = strings[at - 1:at + 8192]
        sizes = np.fromiter(map(len, part), np.int32, len(part))
        width = int(sizes.max())
        wide = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in part]), np.uint8).reshape(-1, width)
        other = wide[1:] != wide[:-1]
        same = np.where(other.any(axis=1), other.argmax(axis=1), width)
        out[at:at + 8192] = np.minimum(same, np.minimum(sizes[1:], sizes[:-1]))
    return out


def encode(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """``(shared, rest lengths, rests)`` of a sorted list."""
    shared = common_prefixes(strings)
    rests = [s[k:] for s, k in zip(strings, shared.tolist())]
    return shared, np.fromiter(map(len, rests), np.int32, len(rests)), b"".join(rests)


class Run:
    """Reader of one front-coded run; ``shared`` is the current string's common
    prefix with the last one put out by the merge, -1 at the end."""

    __slots__ = ("number", "lengths", "ends", "rests", "at", "text", "shared")

    def __init__(self, number: int, shared: np.ndarray, sizes: np.ndarray, rests: bytes):
        self.number, self.lengths, self.rests = number, shared.tolist(), rests
        self.ends = np.cumsum(sizes).tolist()
        self.at, self.text, self.shared = -1, b"", 0
        self.advance()
        if self.shared >= 0:
            self.shared = 0

    def advance(self) -> None:
        self.at += 1
        if self.at == len(self.lengths):
            self.shared = -1
            return
        k = self.lengths[self.at]
        self.text = self.text[:k] + self.rests[self.ends[self.at - 1] if self.at else 0:self.ends[self.at]]
        self.shared = k


def _first_difference(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix, known to be at least ``at``."""
    stop = min(len(a), len(b))
    while at < stop and a[at:at + 16] == b[at:at + 16]:
        at += 16
    if at >= stop:
        return stop
    while at < stop and a[at] == b[at]:
        at += 1
    return at


def _play(a: Run, b: Run) -> tuple[Run, Run]:
    """Winner and loser; the loser then knows its common prefix with the winner."""
    if a.shared != b.shared:
        return (a, b) if a.shared > b.shared else (b, a)
    if a.shared < 0:
        return a, b
    x, y = a.text, b.text
    k = _first_difference(x, y, a.shared)
    if k == len(x) == len(y):
        a, b = (a, b) if a.number < b.number else (b, a)
    elif not (k == len(x) or k < len(y) and x[k] < y[k]):
        a, b = b, a
    b.shared = k
    return a, b


def merge(runs: list[Run]) -> Iterator[tuple[bytes, int, int, int]]:
    """``(string, common prefix with the one before, run, place in the run)`` in
    sorted order; equal strings by run, then place."""
    if not runs:
        return
    size = len(runs)
    losers: list = [None] * size

    def build(node: int) -> Run:
        if node >= size:
            return runs[node - size]
        winner, losers[node] = _play(build(2 * node), build(2 * node + 1))
        return winner

    slot = {id(r): size + i for i, r in enumerate(runs)}
    top = build(1) if size > 1 else runs[0]
    while top.shared >= 0:
        yield top.text, top.shared, top.number, top.at
        top.advance()
        node = slot[id(top)] >> 1
        while node:
            other = losers[node]
            if other.shared > top.shared:
                losers[node], top = top, other
            elif other.shared == top.shared >= 0:
                top, losers[node] = _play(top, other)
            node >>= 1
