"""Patched frame-of-reference blocks of token ids, and files of them.

A block is BLOCK ids: their minimum is subtracted, and what is left is packed at the width that holds the percentile
``COVER`` of them; the high bits of the others go to an exception list. A segment is the unit of a file:

    magic "PFR1" | u32 version | u64 number of ids | u32 blocks | u32 documents | u64 first id's place in its partition
    documents: u64 doc_id, then u32 number of ids, each
    index: u64 byte at which each block starts (from the first block), and the end
    blocks: u32 minimum | u8 width | u8 0 | u16 exceptions | packed words | u8 place, each | u32 high bits, each

All numbers are little-endian. Any block can be read by itself from the index.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK, COVER = 128, 0.9
_HEAD = struct.Struct("<4sIQIIQ")


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(n, BLOCK) numbers below 2**width as (n, 2 * width) 64-bit words. A place of all blocks at a time, side by side."""
    places = np.ascontiguousarray(values.T, np.uint64)
    out = np.zeros((BLOCK * width // 64, len(values)), np.uint64)
    for j in range(BLOCK if width else 0):
        word, off = divmod(j * width, 64)
        out[word] |= places[j] << np.uint64(off)
        if off + width > 64:
            out[word + 1] |= places[j] >> np.uint64(64 - off)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T)
    out = np.zeros((BLOCK, len(words)), np.uint32)
    low = np.uint64((1 << width) - 1)
    for j in range(BLOCK if width else 0):
        word, off = divmod(j * width, 64)
        got = columns[word] >> np.uint64(off)
        if off + width > 64:
            got |= columns[word + 1] << np.uint64(64 - off)
        out[j] = got & low
    return np.ascontiguousarray(out.T)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """The last block is filled up with its last id."""
    if not len(ids):
        return []
    n = -(-len(ids) // BLOCK)
    full = np.full(n * BLOCK, ids[-1], np.uint32)
    full[: len(ids)] = ids
    full = full.reshape(n, BLOCK)
    least = full.min(axis=1)
    rest = full - least[:, None]
    covered = np.partition(rest, int(np.ceil(COVER * BLOCK)) - 1, axis=1)[:, int(np.ceil(COVER * BLOCK)) - 1]
    widths = np.ceil(np.log2(covered.astype(np.float64) + 1)).astype(np.int64)
    out: list[bytes] = [b""] * n
    for w in np.unique(widths).tolist():
        at = np.flatnonzero(widths == w)
        rows = rest[at]
        high = rows >> np.uint32(w) if w < 32 else np.zeros_like(rows)
        words = _pack(rows & np.uint32((1 << w) - 1), w)
        which, place = np.nonzero(high)
        extra = high[which, place].astype("<u4")
        cut = np.searchsorted(which, np.arange(len(at) + 1))
        place = place.astype(np.uint8)
        for k, i in enumerate(at.tolist()):
            a, b = cut[k], cut[k + 1]
            out[i] = struct.pack("<IBBH", int(least[i]), w, 0, b - a) + words[k].tobytes() + place[a:b].tobytes() + extra[a:b].tobytes()
    return out


def decode_blocks(data: bytes, starts: np.ndarray) -> np.ndarray:
    """All ids of the blocks at starts[:-1], with the last block's filling."""
    n = len(starts) - 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    at = starts[:-1].astype(np.int64)
    head = raw[at[:, None] + np.arange(8)]
    least = head[:, :4].copy().view("<u4")[:, 0]
    widths, counts = head[:, 4].astype(np.int64), head[:, 6:8].copy().view("<u2")[:, 0].astype(np.int64)
    out = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == w)
        size = BLOCK * w // 8
        words = raw[at[rows][:, None] + 8 + np.arange(size)].copy().view("<u8") if size else np.zeros((len(rows), 0), np.uint64)
        out[rows] = _unpack(words, w)
    if counts.sum():
        which = np.repeat(np.arange(n), counts)
        k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = (at + 8 + BLOCK * widths // 8)[which]
        place = raw[begin + k].astype(np.int64)
        high = raw[(begin + counts[which] + 4 * k)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
        out[which, place] |= high << widths[which].astype(np.uint32)
    return (out + least[:, None]).reshape(-1)


def write_segment(doc_ids: list[int], lengths: list[int], ids: np.ndarray, first: int) -> bytes:
    blocks = encode_blocks(ids)
    index = np.concatenate(([0], np.cumsum([len(b) for b in blocks], dtype=np.int64))).astype("<u8")
    return b"".join(
        [
            _HEAD.pack(b"PFR1", 1, len(ids), len(blocks), len(doc_ids), first),
            np.array(doc_ids, "<i8").tobytes(),
            np.array(lengths, "<u4").tobytes(),
            index.tobytes(),
            *blocks,
        ]
    )


def read_segment(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(doc_ids, lengths, ids, first)."""
    magic, version, n, blocks, docs, first = _HEAD.unpack_from(data)
    if magic != b"PFR1" or version != 1:
        raise ValueError("not a PFR1 segment")
    at = _HEAD.size
    doc_ids = np.frombuffer(data, "<i8", docs, at)
    lengths = np.frombuffer(data, "<u4", docs, at + 8 * docs).astype(np.int64)
    at += 12 * docs
    starts = np.frombuffer(data, "<u8", blocks + 1, at)
    return doc_ids, lengths, decode_blocks(data[at + 8 * (blocks + 1) :], starts)[:n], first


def read_block(data: bytes, k: int) -> np.ndarray:
    """Block k alone."""
    _, _, n, blocks, docs, _ = _HEAD.unpack_from(data)
    at = _HEAD.size + 12 * docs
    starts = np.frombuffer(data, "<u8", blocks + 1, at)
    body = at + 8 * (blocks + 1)
    one = data[body + int(starts[k]) : body + int(starts[k + 1])]
    return decode_blocks(one, np.array([0, len(one)]))[: n - k * BLOCK]
