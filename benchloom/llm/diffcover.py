"""Suffix sorting by the difference cover {1, 2} modulo 3, on arrays."""

from __future__ import annotations

import numpy as np


def _packed(parts: list[np.ndarray], top: int) -> np.ndarray | None:
    """Several small numbers as one sortable 64-bit number, if they fit."""
    bits = max(1, int(top).bit_length())
    if bits * len(parts) > 63:
        return None
    key = parts[0].astype(np.int64)
    for p in parts[1:]:
        key = (key << bits) | p
    return key


def _order(parts: list[np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order of tuples, and for each sorted place whether it differs from the one before."""
    key = _packed(parts, top)
    if key is not None:
        place = max(1, len(key).bit_length())
        if len(parts) * max(1, int(top).bit_length()) + place <= 63:  # sorting numbers is faster than sorting places by them
            s = np.sort((key << place) | np.arange(len(key)))
            order = s & ((1 << place) - 1)
            s >>= place
        else:
            order = np.argsort(key)
            s = key[order]
        return order, np.concatenate([[True], s[1:] != s[:-1]])
    order = np.lexsort(parts[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for p in parts:
        s = p[order]
        new[1:] |= s[1:] != s[:-1]
    return order, new


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of an array of numbers >= 1, in sorted order.

    The suffixes at places 1 and 2 modulo 3 are named by their sorted triples; where names repeat, the string of names is
    sorted in the same way. The others follow from one number and the rank of the next suffix, and both sorted lists are
    merged.
    """
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: text[i:].tolist()), dtype=np.int64)
    s = np.concatenate([text.astype(np.int64), np.zeros(4, np.int64)])
    top = int(s.max())
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)  # an extra place keeps both halves apart
    sample = np.concatenate([one, two])
    order, new = _order([s[sample], s[sample + 1], s[sample + 2]], top)
    name = np.empty(len(sample), dtype=np.int64)
    name[order] = np.cumsum(new)
    if not new.all():
        deeper = suffix_array(name)
        order = deeper
        name[order] = np.arange(1, len(order) + 1)
    rank = np.zeros(n + 4, dtype=np.int64)
    rank[sample] = name
    sorted_sample = sample[order]
    sorted_sample = sorted_sample[sorted_sample < n]

    zero = np.arange(0, n, 3)
    top = max(top, len(sample))
    zero = zero[_order([s[zero], rank[zero + 1]], top)[0]]
    is_one = sorted_sample % 3 == 1
    first, second = sorted_sample[is_one], sorted_sample[~is_one]
    before = _less([s[zero], rank[zero + 1]], [s[first], rank[first + 1]], top)
    before += _less([s[zero], s[zero + 1], rank[zero + 2]], [s[second], s[second + 1], rank[second + 2]], top)
    place = np.arange(len(zero)) + before
    out = np.empty(n, dtype=np.int64)
    rest = np.ones(n, dtype=bool)
    rest[place] = False
    out[place] = zero
    out[rest] = sorted_sample
    return out


def _less(query: list[np.ndarray], among: list[np.ndarray], top: int) -> np.ndarray:
    """How many of the sorted tuples `among` are smaller than each of `query`."""
    a, q = _packed(among, top), _packed(query, top)
    if a is not None:
        return np.searchsorted(a, q)
    both = [np.concatenate([x, y]) for x, y in zip(among, query, strict=True)]
    order, new = _order(both, top)
    code = np.empty(len(order), dtype=np.int64)
    code[order] = np.cumsum(new)
    return np.searchsorted(code[: len(among[0])], code[len(among[0]) :])


def equal_windows(data: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of `width` bytes in an order that puts equal ones together, and where a new one begins.

    `data` holds strings ended by 0 with all bytes moved up by 1 (uint16); `starts` are the places of windows in it.
    Suffixes are sorted, and neighbours compared over the first `width` places.
    """
    wanted = np.zeros(len(data), dtype=bool)
    wanted[starts] = True
    order = suffix_array(data.astype(np.int64) + 1)
    order = order[wanted[order]]
    packed = np.concatenate([data.astype(np.int64), np.zeros(7, np.int64)])  # of 9 bits each, 7 in a number
    packed = sum(packed[k : len(data) + k] << (9 * (6 - k)) for k in range(7))
    new = np.ones(len(order), dtype=bool)
    same = np.arange(1, len(order))
    for k in range(0, width, 7):
        at = packed[order + k]
        if width - k < 7:
            at >>= 9 * (7 - width + k)
        same = same[at[same] == at[same - 1]]
    new[same] = False
    return order, new
