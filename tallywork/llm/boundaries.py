"""Sets of cut places in the Roaring manner, with rank and select.

A set of numbers below 2^32 is split by the upper 16 bits into containers. Each
is the smallest of three: an array of the lower halves, a bitmap of 2^16 bits, or
runs (first, length). Cumulative cardinalities of the containers, and within a
container of its words or runs, make `select` two binary searches.
"""

from __future__ import annotations

import struct

import numpy as np

ARRAY, BITMAP, RUN = 0, 1, 2
SPAN = 1 << 16
_HEAD = "<IBI"  # key, kind, number of 16-bit units that follow


def _runs(low: np.ndarray) -> np.ndarray:
    """First and length less one of each run of consecutive numbers."""
    edges = np.flatnonzero(np.diff(low.astype(np.int64), prepend=-2) != 1)
    lengths = np.diff(np.append(edges, len(low)))
    return np.stack([low[edges], (lengths - 1).astype(np.uint16)], axis=1).reshape(-1)


class BoundarySet:
    """An ordered set of places; `select(k)` is the place number `k`, counted from zero."""

    def __init__(self, containers: list[tuple[int, int, np.ndarray]], counts: list[int]):
        self.containers = containers
        self.before = np.concatenate(([0], np.cumsum(np.array(counts, np.int64))))

    @classmethod
    def of(cls, places: np.ndarray) -> BoundarySet:
        """`places` are distinct and in order."""
        edges = np.searchsorted(places, np.arange(0, int(places[-1]) + 1 if len(places) else 0, SPAN))
        containers, counts = [], []
        for key, (at, end) in enumerate(zip(edges, [*edges[1:], len(places)])):
            if at == end:
                continue
            low = (places[at:end] - key * SPAN).astype(np.uint16)
            # A run costs four bytes, a place in an array two, a bitmap 8192.
            first = int(low[0])
            if int(low[-1]) - first == len(low) - 1:
                kind, body = RUN, np.array([first, len(low) - 1], np.uint16)
            else:
                kind, body = RUN, _runs(low)
                if 2 * len(body) > min(2 * len(low), SPAN // 8):
                    if len(low) <= SPAN // 16:
                        kind, body = ARRAY, low
                    else:
                        bits = np.zeros(SPAN, np.uint8)
                        bits[low] = 1
                        kind, body = BITMAP, np.packbits(bits, bitorder="little").view("<u2")
            containers.append((key, kind, body))
            counts.append(len(low))
        return cls(containers, counts)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The container by its cumulative cardinality, then the place within it."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, "right")) - 1
        key, kind, body = self.containers[at]
        k -= int(self.before[at])
        if kind == ARRAY:
            low = int(body[k])
        elif kind == RUN:
            ends = np.cumsum(body[1::2].astype(np.int64) + 1)
            run = int(np.searchsorted(ends, k, "right"))
            low = int(body[2 * run]) + k - (int(ends[run - 1]) if run else 0)
        else:
            ends = np.cumsum(np.bitwise_count(body), dtype=np.int64)
            word = int(np.searchsorted(ends, k, "right"))
            k -= int(ends[word - 1]) if word else 0
            ones = np.flatnonzero(np.unpackbits(body[word : word + 1].view(np.uint8), bitorder="little"))
            low = 16 * word + int(ones[k])
        return key * SPAN + low

    def rank(self, place: int) -> int:
        """How many places of the set are below `place`."""
        at = int(np.searchsorted([key for key, _, _ in self.containers], place // SPAN))
        if at == len(self.containers) or self.containers[at][0] != place // SPAN:
            return int(self.before[at])
        _, kind, body = self.containers[at]
        low, count = place % SPAN, int(self.before[at])
        if kind == ARRAY:
            return count + int(np.searchsorted(body, low))
        if kind == RUN:
            first, more = body[::2].astype(np.int64), body[1::2].astype(np.int64) + 1
            return count + int(np.clip(low - first, 0, more).sum())
        return count + int(np.unpackbits(body.view(np.uint8), bitorder="little")[:low].sum())

    def to_bytes(self) -> bytes:
        parts = [struct.pack("<I", len(self.containers)), np.diff(self.before).astype("<u4").tobytes()]
        parts += [struct.pack(_HEAD, key, kind, len(body)) + body.astype("<u2").tobytes() for key, kind, body in self.containers]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> BoundarySet:
        (n,) = struct.unpack_from("<I", data)
        counts, at, containers = np.frombuffer(data, "<u4", n, 4).tolist(), 4 + 4 * n, []
        for _ in range(n):
            key, kind, size = struct.unpack_from(_HEAD, data, at)
            containers.append((key, kind, np.frombuffer(data, "<u2", size, at + struct.calcsize(_HEAD))))
            at += struct.calcsize(_HEAD) + 2 * size
        return cls(containers, counts)
