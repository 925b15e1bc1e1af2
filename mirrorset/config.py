"""Size limits that decide how joins and windows are planned."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Limits:
    """Bounds below which data may be held whole by a task or broadcast.

    A table of at most ``small_rows`` counted rows may be broadcast, and its groups
    may be held by one task each. Larger lookup tables are joined by shuffle; a key
    that holds a share of more than one in ``salts`` rows is then spread over as many
    tasks as its share asks for. ``group_rows`` is the longest sequence that a window
    by key may hold.
    """

    small_rows: int = 200_000
    group_rows: int = 100_000
    salts: int = 1_000

    def short(self, length: int) -> bool:
        return length <= self.group_rows

    def small(self, rows: int) -> bool:
        return rows <= self.small_rows


DEFAULT_LIMITS = Limits()
