"""Suffix arrays by induced sorting and permuted common prefixes, in numpy, for shards of some megabytes.

Suffixes are classified as smaller (S) or larger (L) than their successor; the leftmost S suffixes of each run
cut the text into substrings, which are sorted by inducing, bucket by bucket, and named. The text of names is sorted
in turn, in rounds that each join two names into one of twice the length (its alphabet has too many buckets to walk),
until all differ. The order of the names induces that of all suffixes. It is whole: common prefixes are carried from one
suffix to the next, which does not hold where suffixes that agree far enough stand in any order.
"""

from __future__ import annotations

import numpy as np

from shelfpulse.llm.common import prefix_sums, span_hash


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one, a unique smallest value, is."""
    up = text[:-1] < text[1:]
    change = np.flatnonzero(text[:-1] != text[1:])
    runs = np.diff(change, prepend=-1)  # the end of its run of equal values decides
    return np.concatenate([np.repeat(up[change], runs), [True]])


def _deal(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by value, the counts, and each ordered item's rank among those of its value."""
    order = np.argsort(values, kind="stable")
    count = np.bincount(values, minlength=size)
    return order, count, np.arange(len(values)) - np.repeat(np.cumsum(count) - count, count)


def induce(text: np.ndarray, smaller: np.ndarray, firsts: np.ndarray, size: int) -> np.ndarray:
    """All suffixes in the order that the leftmost S suffixes, given in theirs, induce."""
    count = np.bincount(text, minlength=size)
    stop = np.cumsum(count)
    start = stop - count
    array = np.full(len(text), -1, np.int32)
    order, held, rank = _deal(text[firsts], size)
    array[np.repeat(stop - held, held) + rank] = firsts[order]
    head = start.copy()
    for value in range(size):  # L suffixes from the left; a bucket's own ones feed on themselves
        done = start[value]
        while done < head[value]:
            reach = head[value]
            before = array[done:reach] - 1
            before = before[before >= 0]
            before = before[~smaller[before]]
            _append(array, head, text, before, size)
            done = reach
        before = array[stop[value] - held[value]: stop[value]] - 1
        before = before[before >= 0]
        _append(array, head, text, before[~smaller[before]], size)
    tail = stop.copy()
    tail[0] -= 1  # the last suffix stays
    for value in range(size - 1, -1, -1):  # S suffixes from the right
        done = stop[value]
        if value == 0:
            done, tail[0] = stop[0], stop[0] - 1
        while done > tail[value]:
            reach = tail[value]
            before = array[reach:done][::-1] - 1
            before = before[before >= 0]
            _prepend(array, tail, text, before[smaller[before]], size)
            done = reach
        before = array[start[value]: head[value]][::-1] - 1
        before = before[before >= 0]
        _prepend(array, tail, text, before[smaller[before]], size)
    return array


def _append(array: np.ndarray, head: np.ndarray, text: np.ndarray, items: np.ndarray, size: int) -> None:
    if len(items):
        order, count, rank = _deal(text[items], size)
        array[np.repeat(head, count) + rank] = items[order]
        head += count


def _prepend(array: np.ndarray, tail: np.ndarray, text: np.ndarray, items: np.ndarray, size: int) -> None:
    if len(items):
        order, count, rank = _deal(text[items], size)
        array[np.repeat(tail, count) - 1 - rank] = items[order]
        tail -= count


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; the last value must be 0 and no other one."""
    size = int(text.max()) + 1
    smaller = smaller_types(text)
    first = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1  # the last suffix is one of them
    if len(first) <= 1:
        return induce(text, smaller, np.array([len(text) - 1], np.int32), size)
    array = induce(text, smaller, first, size)
    place = np.full(len(text), -1, np.int32)
    place[first] = np.arange(len(first))
    ordered = place[array]
    ordered = ordered[ordered >= 0]  # numbers of the substrings, sorted
    stop = np.minimum(np.append(first[1:], len(text) - 1) + 1, len(text))
    drawn = span_hash(prefix_sums(text), first, stop)[ordered]
    fresh = np.concatenate([[False], drawn[1:] != drawn[:-1]])
    names = np.empty(len(first), np.int64)
    names[ordered] = np.cumsum(fresh)
    most, reach = int(names.max()) + 1, 1
    while most < len(first):
        ahead = np.zeros(len(first), np.int64)
        ahead[:-reach] = names[reach:] + 1
        pair = names * (most + 1) + ahead
        ordered = np.argsort(pair)
        names[ordered] = np.cumsum(np.concatenate([[False], pair[ordered][1:] != pair[ordered][:-1]]))
        most, reach = int(names.max()) + 1, 2 * reach
        if reach >= len(first):
            break
    return induce(text, smaller, first[np.argsort(names)].astype(np.int32), size)


LANES = 8192


def common_prefixes(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """For each suffix how much it has in common with the one before it in `array`, up to `most`, in text order.

    A suffix has at most one value less in common than the suffix to its left, so no value is read twice along
    the text; stretches of the text are walked in step."""
    count = len(text)
    before = np.full(count, -1, np.int64)
    before[array[1:]] = array[:-1]
    out = np.zeros(count, np.int32)
    length = -(-count // min(LANES, count))
    at = np.arange(0, count, length)
    end = np.minimum(at + length, count)
    same = np.zeros(len(at), np.int64)
    padded = np.concatenate([text, np.full(most + 1, -1, text.dtype)])
    while len(at):
        other = before[at]
        equal = (padded[at + same] == padded[other + same]) & (other >= 0) & (same < most)
        stuck = np.flatnonzero(~equal)
        same += equal
        out[at[stuck]] = same[stuck]
        at[stuck] += 1
        same[stuck] = np.maximum(same[stuck] - 1, 0)
        if len(stuck):
            stay = at < end
            if not stay.all():
                at, end, same = at[stay], end[stay], same[stay]
    return out
