"""Word shingles of whole texts as hashes, many texts at once.

Words are runs of bytes other than ASCII white space. A text of fewer words than a shingle has one
shingle of all its words; a text without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from mirrorset.llm.common import SpanHash, mix64, text_bytes

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_FACTOR = np.uint64(0x100000001B3)


def words(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each word."""
    solid = ~_BLANK[flat]
    edge = np.zeros(len(flat) + 1, bool)
    edge[starts[lengths > 0]] = True
    edge[len(flat)] = True
    before = np.concatenate(([False], solid[:-1])) & ~edge[:-1]
    after = np.concatenate((solid[1:], [False])) & ~edge[1:]
    first = np.flatnonzero(solid & ~before)
    last = np.flatnonzero(solid & ~after) + 1
    filled = np.flatnonzero(lengths > 0)
    return first, last, filled[np.searchsorted(starts[filled], first, side="right") - 1] if len(filled) else first


def shingles(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, hash and count of the distinct shingles of each text, in order of text and hash."""
    flat, starts, lengths = text_bytes(column)
    none = np.zeros(0, np.int64)
    if not len(flat):
        return none, np.zeros(0, np.uint64), none
    first, last, owner = words(flat, starts, lengths)
    if not len(first):
        return none, np.zeros(0, np.uint64), none
    word = SpanHash(flat)(first, last)
    count = np.bincount(owner, minlength=len(column))
    begin = np.cumsum(count) - count
    place = np.arange(len(word)) - begin[owner]
    taken = np.minimum(count, size)[owner]
    at = np.flatnonzero(place + taken <= count[owner])
    at = at[(count[owner[at]] >= size) | (place[at] == 0)]
    total = np.zeros(len(at), np.uint64)
    for i in range(size):
        used = i < taken[at]
        term = word[np.minimum(at + i, len(word) - 1)]
        total = np.where(used, total * _FACTOR + term, total)
    value = mix64(total + taken[at].astype(np.uint64))
    order = np.lexsort((value, owner[at]))
    value, owner = value[order], owner[at][order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    return owner[heads], value[heads], np.diff(np.append(heads, len(value)))


def similarity(left: pa.Array, right: pa.Array, size: int) -> np.ndarray:
    """The greater of set and probability Jaccard similarity of the shingles of each pair of texts; 0 for texts without any."""
    return similarity_of(shingles(left, size), shingles(right, size), len(left))


def similarity_of(left: tuple[np.ndarray, ...], right: tuple[np.ndarray, ...], pairs: int) -> np.ndarray:
    """The same for shingles given as pair number, hash and count.

    Probability Jaccard: sum over the common shingles i of 1 / sum over all j of max(x_j / x_i, y_j / y_i). With
    the shingles of a pair sorted by x_j / y_j, falling, the inner sum is one of x up to i and one of y behind.
    """
    a, x, often = left
    b, y, also = right
    row, value = np.concatenate((a, b)), np.concatenate((x, y))
    given = np.concatenate((often, np.zeros(len(also), often.dtype))), np.concatenate((np.zeros(len(often), also.dtype), also))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    heads = np.flatnonzero(new)
    if not len(heads):
        return np.zeros(pairs)
    x, y = (np.add.reduceat(w[order], heads).astype(float) for w in given)
    row = row[heads]
    common = (x > 0) & (y > 0)
    sets = np.bincount(row, common, pairs) / np.maximum(np.bincount(row, minlength=pairs), 1)
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.lexsort((-ratio, row))
    row, x, y, common = row[order], x[order], y[order], common[order]
    begin = np.searchsorted(row, row)
    upto = np.cumsum(x)
    upto -= (upto - x)[begin]
    behind = np.cumsum(y)
    behind = np.bincount(row, y, pairs)[row] - (behind - (behind - y)[begin])
    term = np.zeros(len(x))
    term[common] = 1 / (upto[common] / x[common] + behind[common] / y[common])
    return np.maximum(sets, np.bincount(row, term, pairs))
