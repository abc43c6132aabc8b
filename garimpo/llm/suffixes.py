"""Maximal repeats of a bounded set of byte strings: suffix array, common prefixes, interval tree."""

from __future__ import annotations

import numpy as np

#: Suffixes are ordered by this many bytes at a step.
STEP = 5


def sorted_suffixes(data: np.ndarray, pos: np.ndarray, end: np.ndarray, group: np.ndarray, least: int, depth: int):
    """(order, lcp) of the suffixes that share ``least`` bytes with another of their group.

    ``data`` ends in ``depth + STEP`` spare bytes.  Suffixes are refined step by step and leave once
    they stand alone before ``least`` bytes; ``lcp[i]`` is what i shares with i - 1, at most
    ``depth``, 0 at the first of a group.  Bytes past a suffix's end never match.
    """
    idx = np.arange(len(pos))
    rank = np.unique(group, return_inverse=True)[1].astype(np.int64)
    lcp = np.zeros(len(pos), np.int64)  # of an entry with the one before it in the present order
    for at in range(0, depth, STEP):
        p, room = pos[idx] + at, end[idx] - pos[idx] - at
        value = np.zeros(len(idx), np.int64)
        for j in range(STEP):
            value = value << 9 | np.where(room > j, data[np.minimum(p + j, len(data) - 1)].astype(np.int64) + 1, 0)
        order = np.lexsort((value, rank))
        idx, value, old = idx[order], value[order], rank[order]
        same = np.empty(len(idx), bool)
        same[:1] = False
        same[1:] = old[1:] == old[:-1]
        # Bytes shared within this step, where the entries were together before it.
        diff = value[1:] ^ value[:-1]
        extra = np.full(max(0, len(idx) - 1), STEP)
        for j in range(STEP):
            extra[(diff >> (9 * (STEP - 1 - j)) != 0) & (extra == STEP)] = j
        # What lies past the shorter suffix's end matches nothing.
        ends = np.minimum(room[order][1:], room[order][:-1])
        whole = same.copy()
        whole[1:] &= diff == 0
        fresh = np.zeros(len(idx), np.int64)
        fresh[1:] = np.where(same[1:], at + np.minimum(extra, ends), 0)
        # Groups keep their places: entries apart since an earlier step keep what they shared then.
        lcp = np.where(same, fresh, lcp)
        rank = np.cumsum(~whole) - 1
        if at + STEP >= least:
            continue
        size = np.bincount(rank)
        stay = size[rank] > 1
        if not stay.all():
            # An entry's neighbour may leave: the first that stays of a group starts anew.
            first = np.r_[True, rank[stay][1:] != rank[stay][:-1]] if stay.any() else np.empty(0, bool)
            idx, rank, lcp = idx[stay], rank[stay], np.where(first, 0, lcp[stay])
        if not len(idx):
            break
    return idx, lcp


def interval_tree(lcp: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(length, first, last + 1) of every interval of common prefixes of ``least`` or more, by a stack scan."""
    out: list[tuple[int, int, int]] = []
    stack: list[tuple[int, int]] = []
    values = lcp.tolist()
    for i in range(1, len(values) + 1):
        h = values[i] if i < len(values) else 0
        left = i - 1
        while stack and stack[-1][0] > h:
            length, left = stack.pop()
            out.append((length, left, i))
        if h >= least and (not stack or stack[-1][0] < h):
            stack.append((h, left))
    return out


def maximal_repeats(strings: list[bytes], groups: np.ndarray, least: int, depth: int):
    """Repeats of ``least`` bytes or more among strings of one group: yields (length, strings, starts).

    Each is maximal: no byte can be added on the right (it is an interval of the tree) nor on
    the left (the bytes before its occurrences differ, or one begins its string).  All
    occurrences are named.  Lengths stop at ``depth``, where the left is not asked.
    """
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.cumsum(sizes) - sizes
    n = np.maximum(0, sizes - least + 1)
    owner = np.repeat(np.arange(len(strings)), n)
    if not len(owner):
        return
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    data = np.frombuffer(b"".join(strings) + bytes(depth + STEP), np.uint8)
    idx, lcp = sorted_suffixes(data, starts[owner] + offset, (starts + sizes)[owner], groups[owner], least, depth)
    # Left byte + 1; 0 where a suffix begins its string, which differs from everything.
    at = (starts[owner] + offset)[idx]
    left = np.where(offset[idx] > 0, data[at - 1].astype(np.int64) + 1, 0)
    change = np.r_[0, np.cumsum((left[1:] != left[:-1]) | (left[1:] == 0))] if len(left) else left
    for length, a, b in interval_tree(lcp, least):
        if length >= depth or change[b - 1] != change[a] or left[a] == 0:
            yield length, owner[idx[a:b]], offset[idx[a:b]]
