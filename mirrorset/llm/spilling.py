"""A priority queue whose surplus lies sorted in anonymous files of the task."""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator

CHUNK = 4_096


class SpillingQueue:
    """Least entry first. Beyond ``limit`` entries the held ones are written to a file as a sorted run.

    The files have no name and vanish with the task; what a lost task had spilled is recomputed with it.
    Entries must not be less than those already popped.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.held: list[tuple] = []
        self.heads: list[tuple] = []
        self.runs = 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.held, entry)
        if len(self.held) > self.limit:
            self._spill()

    def peek(self) -> tuple | None:
        if self.heads and (not self.held or self.heads[0][0] < self.held[0]):
            return self.heads[0][0]
        return self.held[0] if self.held else None

    def pop(self) -> tuple:
        if not self.heads or self.held and self.held[0] <= self.heads[0][0]:
            return heapq.heappop(self.held)
        entry, run, rest = self.heads[0]
        following = next(rest, None)
        if following is None:
            heapq.heappop(self.heads)
        else:
            heapq.heapreplace(self.heads, (following, run, rest))
        return entry

    def _spill(self) -> None:
        self.held.sort()
        file = tempfile.TemporaryFile()
        for start in range(0, len(self.held), CHUNK):
            pickle.dump(self.held[start : start + CHUNK], file)
        file.seek(0)
        rest = self._read(file)
        heapq.heappush(self.heads, (next(rest), self.runs, rest))
        self.runs += 1
        self.held = []

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        with file:
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return
