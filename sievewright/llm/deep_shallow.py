"""Deep-shallow sorting of text windows in numpy.

Shallow part: multikey quicksort over eight-byte characters, one character at a time inside the
groups that agree so far, down to 16 bytes. Deep part: each group that still agrees is ordered by
blind tries. A trie is built along the path of its first member: another member hangs where it
leaves the path, under its own branching byte, and only the members that hang under the same
branch are compared again, in a trie of their own. All groups take a step together.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16
_STEPS = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)


def characters(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes at each position as one number that compares like the bytes."""
    return np.lib.stride_tricks.sliding_window_view(buf, 8)[at].view(">u8").ravel().astype(np.uint64)


def _groups(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots in groups of two or more, and the first slot of each one's group."""
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, new.size))
    heads = np.repeat(first, sizes)
    many = np.repeat(sizes, sizes) > 1
    return np.flatnonzero(many), heads[many]


def _leave(buf: np.ndarray, member: np.ndarray, pivot: np.ndarray, known: int, depth: int) -> np.ndarray:
    """Where a member hangs beside its pivot's path, as a number in sorting order."""
    rank = np.full(member.size, depth * 256, np.int64)
    left = np.arange(member.size)
    for at in [*range(known, depth - 7, 8), *([depth - 8] if (depth - known) % 8 else [])]:
        x, y = characters(buf, member[left] + at), characters(buf, pivot[left] + at)
        differ = np.flatnonzero(x != y)
        if differ.size:
            a, b = x[differ], y[differ]
            byte = 7 - np.searchsorted(_STEPS, a ^ b, side="right")
            branch = ((a >> (8 * (7 - byte)).astype(np.uint64)) & np.uint64(255)).astype(np.int64)
            common = at + byte
            # smaller ones: the shorter the common part, the earlier; larger ones: the later
            rank[left[differ]] = np.where(a < b, common, 2 * depth - common) * 256 + branch
        left = np.delete(left, differ)
        if not left.size:
            break
    return rank


def sort_windows(buf: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the ``depth``-byte windows (24 or more) at ``starts``, and for each place in that
    order the number of its run of equal windows. ``buf`` needs 8 bytes after the last window."""
    n = starts.size
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = characters(buf, starts)
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    for at in range(8, SHALLOW, 8):
        slots, heads = _groups(new)
        key = characters(buf, starts[order[slots]] + at)
        rank = np.lexsort((key, heads))
        order[slots] = order[slots[rank]]
        key = key[rank]
        new[slots[1:]] |= key[1:] != key[:-1]
    slots, heads = _groups(new)
    while slots.size:
        member = starts[order[slots]]
        rank = _leave(buf, member, starts[order[heads]], SHALLOW, depth)
        again = np.lexsort((rank, heads))
        order[slots] = order[slots[again]]
        rank = rank[again]
        new[slots[1:]] |= (rank[1:] != rank[:-1]) | (heads[1:] != heads[:-1])
        open_ = rank != depth * 256
        slots = slots[open_]
        rank, heads = rank[open_], heads[open_]
        # groups of this round's branches
        edge = np.concatenate([[True], (rank[1:] != rank[:-1]) | (heads[1:] != heads[:-1])]) if slots.size else np.zeros(0, bool)
        keep, first = _groups(edge)
        slots, heads = slots[keep], slots[first]
    return order, np.cumsum(new) - 1
