"""Cutting texts where byte-level BPE can never join, so that equal pieces are encoded once and remembered.

In the split pattern of such vocabularies three places always lie between two pre-tokens, whatever stands around them: before
a single space or line break between two characters that are not white space, behind such a line break, and between a letter
and a full stop, comma, colon, semicolon, exclamation or question mark. A text in which every white-space run is one space or
one line break is cut there; any other text is one piece. Both give the ids that the whole text gives.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space other than space and line feed, in the widest sense of any of the libraries.
_OTHER = "[\\t\\x0b-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"
_SPACE, _BREAK = 32, 10
_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_STOP[[*b".,;:!?"]] = True


def cut_pieces(texts: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """Pieces of the texts, one behind the other, and the number of pieces up to each text's end. Null texts are empty."""
    texts = pc.fill_null(texts, "")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int32, n + 1) if n else np.zeros(1, np.int32)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[: ends[-1]] if data is not None else np.zeros(0, np.uint8)
    whole = pc.match_substring_regex(texts, _OTHER).to_numpy(zero_copy_only=False)
    space, new_line = raw == _SPACE, raw == _BREAK
    white = space | new_line
    twice = np.flatnonzero(white[1:] & white[:-1])
    inner = np.searchsorted(ends, twice, side="right") - 1
    whole[inner[ends[inner + 1] > twice + 1]] = True
    cut = white.copy()
    cut[1:] |= new_line[:-1]
    cut[1:] |= _LETTER[raw[:-1]] & _STOP[raw[1:]]
    for i in np.flatnonzero(whole).tolist():
        cut[ends[i] : ends[i + 1]] = False
    full = ends[1:] > ends[:-1]
    cut[ends[:-1][full]] = True
    starts = np.flatnonzero(cut)
    offsets = np.append(starts, len(raw)).astype(np.int32)
    pieces = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return pieces, np.searchsorted(starts, ends[1:])


_HELD: dict[str, object] = {}


class Carried:
    """A model on its way to Python workers, compressed. A worker unpacks it only where it doesn't hold it yet."""

    def __init__(self, model):
        import pickle

        import zstandard

        self.key, self.data = model.key, zstandard.ZstdCompressor(level=1).compress(pickle.dumps(model, protocol=5))


def held(carried: Carried):
    """The model that this Python worker holds, so that its tasks share what it remembers.

    A model has a key that is made with it and travels with it. Only one is held, and the one before goes first, so that a
    worker that goes from one job to another has room.
    """
    if carried.key not in _HELD:
        import pickle

        import zstandard

        from .common import settle

        _HELD.clear()
        settle()
        _HELD[carried.key] = pickle.loads(zstandard.ZstdDecompressor().decompress(carried.data))
    return _HELD[carried.key]


def release() -> None:
    """For work that needs no model, in a worker that may still hold the one of a job before: that one goes."""
    if _HELD:
        from .common import settle

        _HELD.clear()
        settle()


#: Pieces in a generation of a memo: two generations take some 115 MB at most.
REMEMBER = 250_000


def new_key() -> str:
    return uuid.uuid4().hex


class Memo:
    """Remembers many(pieces) of short pieces. Of two generations of at most ``most`` each, the older one goes when the
    younger is full; what is used again moves to the younger. No value is None."""

    def __init__(self, many, most: int = REMEMBER, longest: int = 48):
        self.many, self.most, self.longest, self.young, self.older = many, most, longest, {}, {}

    def all(self, pieces: list) -> list:
        """The value of every piece; pieces that are not known are looked up together. Equal ones should come once."""
        values = list(map(self.young.get, pieces))
        gaps = [i for i, v in enumerate(values) if v is None]
        if not gaps:
            return values
        older, new, longest = self.older.get, [], self.longest
        if len(self.young) + len(gaps) > self.most:
            self.older, self.young = self.young, {}
        young = self.young
        for i in gaps:
            v = values[i] = older(pieces[i])
            if v is None:
                new.append(i)
            else:
                young[pieces[i]] = v
        if new:
            wanted = [pieces[i] for i in new]
            for i, p, v in zip(new, wanted, self.many(wanted)):
                values[i] = v
                if len(p) <= longest:
                    young[p] = v
        return values


#: Bytes of text that are encoded in one go.
TOGETHER = 2 << 20


def encode_texts(texts: pa.StringArray, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, one behind the other, and the number of ids up to each text's end. The memo's values are
    little-endian unsigned 32-bit ids of a piece."""
    pieces, ends = cut_pieces(texts)
    if not len(pieces):
        return np.zeros(0, np.uint32), np.zeros(len(ends), np.int64)
    coded = pieces.dictionary_encode()
    which = coded.indices.to_numpy()
    values = memo.all(as_bytes(coded.dictionary))
    sizes = np.fromiter(map(len, values), np.int32, len(values)) // 4
    flat = np.frombuffer(b"".join(values), "<u4")
    size = sizes[which]
    stop = np.cumsum(size)
    at = np.repeat((np.cumsum(sizes, dtype=np.int32) - sizes)[which] - (stop - size).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at], np.concatenate(([0], stop))[ends]


def as_bytes(column: pa.BinaryArray) -> list[bytes]:
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).tolist()
    raw = column.buffers()[2].to_pybytes()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def slices(array: pa.Array, most: int = TOGETHER):
    """(start, number of rows) of slices of a text or binary column with about so many bytes each, at least a row."""
    sizes = pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (int(ends[a - 1]) if a else 0) + most, side="right")))
        yield a, b - a
        a = b
