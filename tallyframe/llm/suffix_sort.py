"""Two-stage suffix sorting, vectorised, to a given depth.

Suffixes smaller than their successor are sorted directly. All others are induced: buckets of a first byte are scanned in
ascending order, and a scanned suffix sends its predecessor, if that is one of the others, to the end of what its own
bucket has so far. Within a bucket only runs of the same byte depend on each other; they go one byte of the run at a time.
"""

from __future__ import annotations

import numpy as np

#: Pairs, and words of eight bytes, that are worked on at a time.
TOGETHER = 1 << 16


def place_type(n: int) -> type:
    """The least type for places in n bytes."""
    return np.int32 if n < 2**31 - 1 else np.int64


def smaller_than_successor(s: np.ndarray) -> np.ndarray:
    """For each suffix of s whether it is smaller than the next one; the last is not, as the empty suffix follows it."""
    n = len(s)
    at = np.arange(n, dtype=place_type(n))
    differs = np.ones(n, bool)
    differs[:-1] = s[:-1] != s[1:]
    decides = np.minimum.accumulate(np.where(differs, at, at.dtype.type(n))[::-1])[::-1]
    less = np.zeros(n, bool)
    less[:-1] = s[:-1] < s[1:]
    return less[decides]


def _direct(s: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The given suffixes, ordered by their first depth bytes and then by place."""
    padded = np.concatenate([s, np.zeros(depth, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    at = at[np.argsort(s[at], kind="stable")]
    ends = np.cumsum(np.bincount(s[at], minlength=256)).tolist()
    for a, b in zip([0, *ends], ends):  # those of one first byte at a time, as their bytes are copied
        if b - a > 1:
            at[a:b] = at[a:b][np.argsort(np.ascontiguousarray(rows[at[a:b]]).view(f"S{depth}").ravel(), kind="stable")]
    return at


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes of s (bytes; 0 separates texts), in the order of their first depth bytes at least."""
    n = len(s)
    if not n:
        return np.zeros(0, np.int64)
    small, kind = smaller_than_successor(s), place_type(n)
    direct = _direct(s, np.flatnonzero(small).astype(kind), depth)
    firsts = s[direct]
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def send(scanned: np.ndarray, c: int) -> np.ndarray:
        """Deals the predecessors out; returns those that go to bucket c itself."""
        before = scanned[scanned > 0] - 1
        before = before[~small[before]]
        to = s[before]
        order = np.argsort(to, kind="stable")
        before, to = before[order], to[order]
        own = before[:0]
        cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else []
        for a, b in zip(cuts, [*cuts[1:], len(to)]):
            if to[a] == c:
                own = before[a:b]
            else:
                induced[to[a]].append(before[a:b])
        return own

    induced[s[-1]].append(np.array([n - 1], kind))  # the empty suffix comes first of all and sends its predecessor
    for c in np.unique(s).tolist():
        chunk = np.concatenate(induced[c]) if induced[c] else np.zeros(0, kind)
        while len(chunk):
            out.append(chunk)
            chunk = send(chunk, c)
        chunk = direct[np.searchsorted(firsts, c) : np.searchsorted(firsts, c, side="right")]
        out.append(chunk)
        send(chunk, c)
    return np.concatenate(out)


def common_prefixes(s: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of suffixes a[i] and b[i], up to most."""
    padded = np.concatenate([s, np.zeros(most + 8, np.uint8)])
    words = np.zeros(len(s) + most, "<u8")
    for at in range(0, len(words), TOGETHER):
        part = words[at : at + TOGETHER]
        for k in range(8):
            part |= padded[at + k : at + k + len(part)].astype("<u8") << np.uint64(8 * k)
    out = np.full(len(a), most, np.int32)
    for at in range(0, len(a), TOGETHER):
        x, y, size = a[at : at + TOGETHER], b[at : at + TOGETHER], out[at : at + TOGETHER]
        left = np.arange(len(x))
        for off in range(0, most, 8):
            if not len(left):
                break
            odd = words[x[left] + off] ^ words[y[left] + off]
            end = odd != 0
            low = odd[end] & (~odd[end] + np.uint64(1))  # the lowest bit that differs
            size[left[end]] = np.minimum(most, off + np.bitwise_count(low - np.uint64(1)) // 8)
            left = left[~end]
    return out
