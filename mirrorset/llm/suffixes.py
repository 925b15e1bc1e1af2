"""Suffix sorting in two stages, with array operations.

Only suffixes smaller than their successors are sorted directly; the others are induced by one scan
over the buckets of first bytes: scanning the suffixes in order, the predecessor of each, if it is
larger than its successor, is the next of its bucket.
"""

from __future__ import annotations

import numpy as np


def word_keys(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; beyond the end stand zeros."""
    wide = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    for step in (1, 2, 4):
        wide = (wide[:-step] << np.uint64(8 * step)) | wide[step:]
    return wide[: len(text)]


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Is the suffix from each position smaller than the one behind it? The last is not."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    out = np.zeros(n, bool)
    if len(change):
        rises = text[change + 1] > text[change]
        at = np.searchsorted(change, np.arange(n))
        inside = at < len(change)
        out[inside] = rises[at[inside]]
    return out


def _direct(positions: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` bytes; ties in any order."""
    key = keys[positions]
    order = np.argsort(key, kind="stable")
    result, key = positions[order], key[order]
    new = np.ones(len(result), bool)
    new[1:] = key[1:] != key[:-1]
    open_ = np.flatnonzero(_tied(new))
    group = np.cumsum(new)[open_]
    offset = 8
    while offset < depth and len(open_):
        key = keys[np.minimum(result[open_] + offset, len(keys) - 1)]
        order = np.lexsort((key, group))
        result[open_] = result[open_[order]]
        key, group = key[order], group[order]
        new = np.ones(len(open_), bool)
        new[1:] = (key[1:] != key[:-1]) | (group[1:] != group[:-1])
        tied = _tied(new)
        group = np.cumsum(new)[tied]
        open_ = open_[tied]
        offset += 8
    return result


def _tied(new: np.ndarray) -> np.ndarray:
    """Members of groups of two and more, where ``new`` marks the first of each group."""
    single = new.copy()
    single[:-1] &= new[1:]
    return ~single


def two_stage_order(text: np.ndarray, starts: np.ndarray, counts: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + counts[i] - 1`` in the order of at least ``depth`` bytes of their suffixes.

    ``text`` is one array that all positions lie in, each at least ``depth`` bytes before the end of
    its own piece.
    """
    n = len(text)
    text = np.concatenate((text, np.array([0, 255], np.uint8), np.zeros(depth, np.uint8)))
    rising = smaller_than_next(text)
    rising_at = np.flatnonzero(rising)
    lasts = rising_at[np.searchsorted(rising_at, starts + counts - 1)]  # each piece goes on to its next rising suffix
    mark = np.zeros(len(text) + 1, np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, lasts + 1, -1)
    taken = np.cumsum(mark[:-1]) > 0
    direct = _direct(np.flatnonzero(taken & rising), word_keys(text), depth)
    first = text[direct]
    heads = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    falling = taken & ~rising

    def induce(scanned: np.ndarray, byte: int) -> np.ndarray:
        """Hand the falling predecessors to their buckets; those of the same bucket are returned."""
        before = scanned[scanned > 0] - 1
        before = before[falling[before]]
        letters = text[before]
        own = before[letters == byte]
        before, letters = before[letters != byte], letters[letters != byte]
        if len(before):
            order = np.argsort(letters, kind="stable")
            before, letters = before[order], letters[order]
            cuts = np.flatnonzero(np.diff(letters)) + 1
            for part, letter in zip(np.split(before, cuts), letters[np.concatenate(([0], cuts))].tolist()):
                waiting[letter].append(part)
        return own

    for byte in range(256):
        front = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(front):
            out.append(front)
            front = induce(front, byte)
        bucket = direct[heads[byte] : heads[byte + 1]]
        if len(bucket):
            out.append(bucket)
            induce(bucket, byte)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    asked = np.zeros(len(text) + 1, np.int32)
    np.add.at(asked, starts, 1)
    np.add.at(asked, starts + counts, -1)
    return order[(np.cumsum(asked[:-1]) > 0)[order] & (order < n)]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length, up to ``depth``, of what each position in ``order`` has in common with the next one."""
    keys = word_keys(np.concatenate((text, np.zeros(depth + 8, np.uint8))))
    left, right = order[:-1], order[1:]
    common = np.zeros(len(left), np.int64)
    open_ = np.arange(len(left))
    offset = 0
    while offset < depth and len(open_):
        a, b = keys[left[open_] + offset], keys[right[open_] + offset]
        equal = a == b
        ends = open_[~equal]
        if len(ends):
            differs = (a ^ b)[~equal]
            same_bytes = (64 - np.frexp(differs.astype(np.float64))[1]) // 8
            # Rounding to a double may carry a number over a power of two; only byte boundaries matter then.
            carried = (differs >> (np.uint64(56) - np.uint64(8) * np.minimum(same_bytes, 7).astype(np.uint64))) == 0
            common[ends] = offset + same_bytes + carried
        open_ = open_[equal]
        offset += 8
    common[open_] = depth
    return np.minimum(common, depth)
