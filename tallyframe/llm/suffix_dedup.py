"""Suffix-array deduplication: every byte covered by a string of ``length`` bytes that also starts earlier goes.

"Earlier" is a smaller doc_id, or a smaller start in the same document. Matches never cross documents.

How it scales: a corpus has one suffix array too many for any machine, so suffixes are first dealt into buckets that keep
equal strings together. The least hash of the GRAM-byte strings within a window of ``length`` bytes depends on the window
alone; consecutive windows with the same least hash are one run, cut out of the text once. Equal windows are thus in runs
with the same key, and a run whose key occurs once, and once only in it, holds no repeat at all and is dropped on arrival.
Equal runs, compared byte by byte, keep the earliest. What is left of a bucket is sorted by two-stage suffix sorting, and
neighbours in that order whose common prefix reaches ``length`` are repeats: all of them go but the earliest.

A gram that very many documents have in different surroundings would make a bucket of its own that no machine holds. Such
grams are found in a sample of the texts and rank behind all others: a window is dealt by one of them only where it has no
other. Which grams these are changes how windows are dealt, never which are equal.

Runs travel as compressed blocks for each bucket. A bucket is read one block at a time and equal runs are merged as they
come, so a passage that a third of all documents share costs one run a block, not one a document. Keys of a bucket are then
sorted in portions.

Defined results: a null or empty text has no bytes and no spans; rows with a null doc_id come before all others; rows that
share doc_id and text are one document and get the same result; those that share doc_id only are ordered by the hash of
their text; very long texts are cut in pieces that overlap by a window; an empty table gives no rows; extra columns, whatever
their names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text, load, settle, utf8
from .suffix_sort import TOGETHER, common_prefixes, place_type, suffix_array
from .units import release, slices

LENGTH, GRAM = 100, 24
#: Bytes of runs in a bucket, of text in one go, of runs in one block, and of runs that are sorted together.
BUCKET_BYTES, PIECE_BYTES, BLOCK_BYTES, SORT_BYTES, HELD_BYTES = 16 << 20, 1 << 20, 16 << 20, 1 << 19, 24 << 20
#: One text in SAMPLE is looked at for frequent grams; a gram whose runs would have HOT_BYTES is one; MAX_HOT are kept.
SAMPLE, HOT_BYTES, MAX_HOT = 64, 8 << 20, 1 << 16
ZSTD_LEVEL = 6
NULL_ID = -(2**63)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the gram bytes from each place on, of which 2**k <= gram are hashed by doubling and then joined."""
    h, size = _mix(raw.astype(np.uint64) + np.uint64(1)), 1
    while 2 * size <= gram:
        h = (h[:-size] * _MIX) ^ (h[size:] >> np.uint64(7)) ^ (h[size:] << np.uint64(11))
        size *= 2
    if size < gram:
        h = (h[: len(h) - (gram - size)] * _MIX) ^ (h[gram - size :] >> np.uint64(9)) ^ (h[gram - size :] << np.uint64(5))
    return _mix(h)


class Ranks:
    """The order of grams: by hash, those of ``hot`` behind all others."""

    def __init__(self, hot=()):
        self.hot = np.unique(np.asarray(hot, np.uint64) >> np.uint64(1))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hot & np.uint64(0xFFFF)).astype(np.int64)] = True

    def of(self, h: np.ndarray) -> np.ndarray:
        h = h >> np.uint64(1)
        if len(self.hot):
            at = np.flatnonzero(self.seen[(h & np.uint64(0xFFFF)).astype(np.int64)])
            place = np.minimum(np.searchsorted(self.hot, h[at]), len(self.hot) - 1)
            h[at[self.hot[place] == h[at]]] |= np.uint64(1 << 63)
        return h


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over x[i : i + width]."""
    size = 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def runs_of(raw: np.ndarray, doc: np.ndarray, length: int = LENGTH, gram: int = GRAM, ranks: Ranks = Ranks()):
    """(start, windows, key, repeats, place) of the runs in raw; doc numbers the text that each byte belongs to, ascending.

    repeats: whether the key's gram is at two places of a run, so that the run may repeat itself.
    """
    if len(raw) < length:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(bool), none
    h = ranks.of(gram_hashes(raw, gram))
    w = length - gram + 1
    least = sliding(h, w, np.minimum)
    valid = doc[: len(least)] == doc[length - 1 : length - 1 + len(least)]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1 : len(least)] != doc[: len(least) - 1])
    starts = np.flatnonzero(new & valid)
    stop = np.flatnonzero(np.concatenate(((new | ~valid)[1:], [True]))) + 1
    ends = stop[np.searchsorted(stop, starts, side="right")]
    # chosen places: the hash there is the least of some window; in a run of one key they follow each other
    most = sliding(np.concatenate([np.zeros(w - 1, np.uint64), np.where(valid, least, np.uint64(0)), np.zeros(w - 1, np.uint64)]), w, np.maximum)
    chosen = np.flatnonzero(h == most[: len(h)])
    twice = chosen[:-1][(h[chosen[1:]] == h[chosen[:-1]]) & (np.diff(chosen) < length)]
    repeats = np.zeros(len(starts), bool)
    if len(twice):
        i = np.searchsorted(twice, starts)
        repeats = (i < len(twice)) & (twice[np.minimum(i, len(twice) - 1)] < ends + w)
    # the key's gram, as a place in the run's first window, from which the key can be computed again
    key = least[starts]
    at = np.searchsorted(chosen, starts)
    open_ = np.flatnonzero(h[chosen[at]] != key) if len(starts) else at
    while len(open_):
        at[open_] += 1
        open_ = open_[h[chosen[at[open_]]] != key[open_]]
    return starts, ends - starts, key, repeats, chosen[at] - starts if len(starts) else starts


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... sizes[i] of them, for each i."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def gather(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray, together: int = 1 << 20) -> np.ndarray:
    """raw[starts[i] : starts[i] + sizes[i]] one behind the other; indices for about so many bytes exist at a time."""
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    a = 0
    while a < len(starts):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + together)))
        if b == a + 1:
            out[done : ends[a]] = raw[starts[a] : starts[a] + sizes[a]]
        else:
            out[done : ends[b - 1]] = raw[_ragged(starts[a:b], sizes[a:b])]
        a = b
    return out


class Runs:
    """Columns of runs, and their bytes one behind the other."""

    def __init__(self, key, doc_id, tie, start, windows, repeats, place, raw, length):
        self.key, self.doc_id, self.tie, self.start, self.windows, self.repeats, self.place, self.raw = key, doc_id, tie, start, windows, repeats, place, raw
        self.length = length

    def __len__(self):
        return len(self.key)

    @property
    def sizes(self):
        return self.windows + (self.length - 1)

    def take(self, at: np.ndarray) -> Runs:
        sizes = self.sizes
        raw = gather(self.raw, (np.cumsum(sizes) - sizes)[at], sizes[at])
        return Runs(*(c[at] for c in (self.key, self.doc_id, self.tie, self.start, self.windows, self.repeats, self.place)), raw, self.length)

    def slice(self, a: int, b: int, from_byte: int, to_byte: int) -> Runs:
        cols = (self.key, self.doc_id, self.tie, self.start, self.windows, self.repeats, self.place)
        return Runs(*(c[a:b] for c in cols), self.raw[from_byte:to_byte], self.length)

    @staticmethod
    def join(many: list[Runs]) -> Runs:
        cols = ("key", "doc_id", "tie", "start", "windows", "repeats", "place", "raw")
        return Runs(*(np.concatenate([getattr(m, c) for m in many]) for c in cols), many[0].length)

    def pack(self) -> bytes:
        """Compressed columns. A key travels as the place of its gram, a byte, and is computed again."""
        import zstandard

        docs, which = np.unique(np.stack([self.doc_id, self.tie]), axis=1, return_inverse=True)
        wide = bool(len(self)) and int(max(self.start.max(), self.windows.max())) >= 2**31
        n, number = len(self), "<u8" if wide else "<u4"
        head = np.array([n, docs.shape[1], wide], "<i8").tobytes()
        body = [
            head, np.ascontiguousarray(docs, "<i8").tobytes(), which.astype("<u4").tobytes(), self.place.tobytes(),
            self.start.astype(number).tobytes(), (self.windows * 2 + self.repeats).astype(number).tobytes(), self.raw.tobytes(),
        ]
        return zstandard.ZstdCompressor(level=ZSTD_LEVEL).compress(b"".join(body))

    @staticmethod
    def unpack(data, length: int, ranks: Ranks = Ranks()) -> Runs:
        import zstandard

        raw = zstandard.ZstdDecompressor().decompress(data)
        n, d, wide = np.frombuffer(raw, "<i8", 3).tolist()
        at, size = 24, 8 if wide else 4
        docs = np.frombuffer(raw, "<i8", 2 * d, at).reshape(2, d)
        at += 16 * d
        which = np.frombuffer(raw, "<u4", n, at)
        at += 4 * n
        place = np.frombuffer(raw, np.uint8, n, at)
        at += n
        start, windows = (np.frombuffer(raw, f"<u{size}", n, at + size * n * i).astype(np.int64) for i in range(2))
        text, windows, repeats = np.frombuffer(raw, np.uint8, offset=at + 2 * size * n), windows >> 1, (windows & 1).astype(bool)
        sizes = windows + (length - 1)
        key, grams = np.empty(n, np.uint64), np.cumsum(sizes) - sizes + place
        for a in range(0, n, 4000):
            key[a : a + 4000] = ranks.of(gram_hashes(text[grams[a : a + 4000, None] + np.arange(GRAM)].T)[0])
        return Runs(key, docs[0][which], docs[1][which], start, windows, repeats, place, text, length)


def _pieces(raw: bytes, length: int):
    """(offset, bytes) of a text: each window is whole in one of them."""
    for a in range(0, max(1, len(raw) - length + 1), PIECE_BYTES):
        yield a, raw[a : a + PIECE_BYTES + length - 1]


def text_runs(texts: list[tuple[int, int, bytes]], length: int, ranks: Ranks = Ranks()) -> list[Runs]:
    """Runs of (doc_id, tie, bytes) texts, in parts of about PIECE_BYTES of text."""
    return list(each_runs(texts, length, ranks))


def each_runs(texts: list[tuple[int, int, bytes]], length: int, ranks: Ranks = Ranks()):
    """What text_runs gives, a part at a time."""
    held, size = [], 0

    def flush():
        raw = np.frombuffer(b"".join(p for *_, p in held), np.uint8)
        sizes = np.array([len(p) for *_, p in held])
        doc = np.repeat(np.arange(len(held)), sizes)
        starts, windows, key, repeats, place = runs_of(raw, doc, length, ranks=ranks)
        of = doc[starts]
        ids, ties, at = (np.array(x, np.int64) for x in zip(*((h[0], h[1], h[2]) for h in held)))
        begin = np.cumsum(sizes) - sizes
        bytes_ = gather(raw, starts, windows + length - 1)
        return Runs(key, ids[of], ties[of], starts - begin[of] + at[of], windows, repeats, place.astype(np.uint8), bytes_, length)

    for doc_id, tie, raw in texts:
        if len(raw) < length:
            continue
        for at, piece in _pieces(raw, length):
            held.append((doc_id, tie, at, piece))
            size += len(piece)
            if size >= PIECE_BYTES:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def merge_equal(runs: Runs, spans: list) -> Runs:
    """Keeps the earliest of equal runs, in the order of their keys; the others are covered as a whole."""
    from xxhash import xxh3_128_digest

    sizes = runs.sizes
    ends = np.cumsum(sizes).tolist()
    buffer = memoryview(np.ascontiguousarray(runs.raw))
    digest = np.frombuffer(b"".join(xxh3_128_digest(buffer[e - n : e]) for e, n in zip(ends, sizes.tolist())), "<u8").reshape(-1, 2)
    order = np.lexsort((runs.start, runs.tie, runs.doc_id, digest[:, 1], digest[:, 0], runs.key))
    d, k = digest[order], runs.key[order]
    same = np.zeros(len(order), bool)
    same[1:] = (d[1:] == d[:-1]).all(axis=1) & (k[1:] == k[:-1]) & (sizes[order[1:]] == sizes[order[:-1]])
    at = np.flatnonzero(same)
    if len(at):  # equal digests are checked byte by byte
        begin, n = np.cumsum(sizes) - sizes, sizes[order[at]]
        unlike = gather(runs.raw, begin[order[at]], n) != gather(runs.raw, begin[order[at - 1]], n)
        same[at[np.add.reduceat(unlike, np.cumsum(n) - n, dtype=np.int64) > 0]] = False
        # a run that came twice, of rows with the same id and text, is no repeat of itself
        twin = np.zeros(len(order), bool)
        twin[1:] = (runs.doc_id[order[1:]] == runs.doc_id[order[:-1]]) & (runs.tie[order[1:]] == runs.tie[order[:-1]]) & (runs.start[order[1:]] == runs.start[order[:-1]])
        gone = order[same & ~twin]
        if len(gone):
            spans.append((runs.doc_id[gone], runs.tie[gone], runs.start[gone], runs.start[gone] + sizes[gone]))
    return runs.take(order[~same])


def repeated_windows(runs: Runs, spans: list) -> None:
    """Two-stage suffix sorting of distinct runs, which hold all windows of their keys; neighbours that agree are repeats."""
    length, sizes = runs.length, runs.sizes
    n = len(runs)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    s = np.zeros(int(sizes.sum()) + n, np.uint8)
    text, window = np.ones(len(s), bool), np.zeros(len(s), np.int8)
    text[begin + sizes] = False
    s[text] = runs.raw + np.uint8(1)  # no byte of UTF-8 is 255; 0 ends a run
    window[begin], window[begin + runs.windows] = 1, -1
    window = np.cumsum(window, dtype=np.int8).astype(bool)
    order = suffix_array(s, length)
    order = order[window[order]]
    same = np.zeros(len(order), bool)
    same[1:] = common_prefixes(s, order[:-1], order[1:], length) >= length
    inside = same.copy()
    inside[:-1] |= same[1:]
    at, group = order[inside], np.cumsum(~same, dtype=order.dtype)[inside]
    del text, window, order, same, inside
    # numbers of runs and places are held in as few bytes as they need: a key's windows may be a million
    of = np.empty(len(at), np.int32)
    for a in range(0, len(at), TOGETHER):
        of[a : a + TOGETHER] = np.searchsorted(begin, at[a : a + TOGETHER], side="right") - 1
    kind = place_type(max(len(s), int((runs.start + sizes).max())))
    place = (runs.start - begin).astype(kind)[of]
    place += at
    del at
    doc = np.unique(np.stack([runs.doc_id, runs.tie]), axis=1, return_inverse=True)[1].reshape(-1).astype(np.int32)  # in that order
    rank = np.lexsort((place, doc[of], group))
    later = np.zeros(len(rank), bool)
    later[1:] = group[rank][1:] == group[rank][:-1]
    gone = rank[later]
    # neighbouring windows of a run become one span
    by = np.lexsort((place[gone], of[gone]))
    o, p = of[gone][by], place[gone][by]
    if len(o):
        first = np.ones(len(o), bool)
        first[1:] = (o[1:] != o[:-1]) | (p[1:] - p[:-1] > length)
        last = np.concatenate((first[1:], [True]))
        spans.append((runs.doc_id[o[first]], runs.tie[o[first]], p[first].astype(np.int64), p[last].astype(np.int64) + length))


def bucket_spans(parts, length: int, sort_bytes: int = SORT_BYTES, held_bytes: int = HELD_BYTES) -> list:
    """Spans of one bucket's runs, which come in blocks. Each is (doc_id, tie, start, end) arrays."""
    spans: list = []
    held: list[Runs] = []
    size = 0
    limit = held_bytes
    for part in parts:
        held.append(part)
        size += len(part.raw)
        if size > limit:
            joined, held = Runs.join(held), []  # the parts go before the copy without equal runs is made
            del part
            held.append(merge_equal(joined, spans))
            del joined
            size = len(held[0].raw)
            limit = max(held_bytes, 2 * size)
    if not held:
        return spans
    # a portion of the keys at a time, so that no copy of a whole bucket is made
    keys = np.concatenate([r.key for r in held])
    sizes = np.concatenate([r.sizes for r in held])
    order = np.argsort(keys, kind="stable")
    total, sorted_keys = np.cumsum(sizes[order]), keys[order]
    bounds, at = [], 0
    while at < len(order):
        stop = int(np.searchsorted(total, (int(total[at - 1]) if at else 0) + 8 * sort_bytes, side="right"))
        at = int(np.searchsorted(sorted_keys, sorted_keys[min(max(stop, at + 1), len(order)) - 1], side="right"))  # whole keys
        bounds.append(sorted_keys[at - 1])
    del keys, sizes, order, total, sorted_keys
    low = None
    for high in bounds:
        sorted_spans(Runs.join([r.take(np.flatnonzero((r.key <= high) if low is None else (r.key <= high) & (r.key > low))) for r in held]), length, sort_bytes, spans)
        low = high
    return spans


def sorted_spans(runs: Runs, length: int, sort_bytes: int, spans: list) -> None:
    """Appends the spans of runs that have all there is of their keys."""
    _, which, count = np.unique(runs.key, return_inverse=True, return_counts=True)
    runs = runs.take(np.flatnonzero((count[which] > 1) | runs.repeats))
    if not len(runs):
        return
    runs = merge_equal(runs, spans)  # sorted by key from here on
    new = np.concatenate(([True], runs.key[1:] != runs.key[:-1]))
    group = np.cumsum(new) - 1
    many = (np.bincount(group)[group] > 1) | (np.bincount(group, runs.repeats)[group] > 0)
    runs = runs.take(np.flatnonzero(many))
    if not len(runs):
        return
    new = np.flatnonzero(np.concatenate(([True], runs.key[1:] != runs.key[:-1])))
    total = np.concatenate(([0], np.cumsum(runs.sizes)))
    a = 0
    while a < len(runs):
        b = np.searchsorted(total, total[a] + sort_bytes)
        i = np.searchsorted(new, b, side="right") - 1  # a key's runs stay together
        stop = int(new[i]) if new[i] > a else int(new[i + 1]) if i + 1 < len(new) else len(runs)
        if b >= len(runs):
            stop = len(runs)
        repeated_windows(runs.take(np.arange(a, stop)), spans)
        a = stop


def frequent_grams(narrow: DataFrame, length: int, sample: int = SAMPLE, hot_bytes: int = HOT_BYTES) -> list[int]:
    """Hashes of grams that would be the key of more than hot_bytes of runs, by the different texts of a sample."""
    least = max(2, hot_bytes // (sample * 2 * length))
    some = narrow.where(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0).where(F.octet_length("text") >= length)

    def keys(batches):
        release()
        for batch in batches:
            for a, n in slices(batch.column(0)):
                for text in batch.column(0).slice(a, n).to_pylist():
                    raw = utf8(text)
                    found = [r.key for r in text_runs([(0, 0, raw)], length)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], ["key"])
        settle()

    counts = some.select("text").distinct().mapInArrow(keys, "key long").groupBy("key").count().where(F.col("count") >= least)
    return [int(r.key) << 1 for r in counts.orderBy(F.desc("count"), "key").limit(MAX_HOT).collect()]


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET_BYTES, hot: list[int] | None = None) -> DataFrame:
    """(doc_id, tie, start, end): spans of documents with repeats, unmerged. hot: hashes of frequent grams, if they are known."""
    narrow = id_text(docs, id_col, text_col).select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    w = length - GRAM + 1
    buckets = max(1, -(-int(total * (1 + 2 * (length - 1) / (w + 1))) // bucket_bytes))
    ranks = Ranks(frequent_grams(narrow, length) if hot is None else hot)

    def cut(batches):
        from xxhash import xxh64_intdigest

        def emit(texts):
            by_bucket: dict[int, list[Runs]] = {}
            for runs in each_runs(texts, length, ranks):
                to = (runs.key % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(to, kind="stable")
                runs, to = runs.take(order), to[order]
                cuts = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1], [True])))
                offsets = np.concatenate(([0], np.cumsum(runs.sizes)))[cuts].tolist()
                for a, b, x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), offsets, offsets[1:]):
                    by_bucket.setdefault(int(to[a]), []).append(runs.slice(a, b, x, y))
            texts.clear()
            ids, spans = sorted(by_bucket), []
            for a in range(0, len(ids), 64):
                rows = [merge_equal(Runs.join(by_bucket.pop(i)), spans).pack() for i in ids[a : a + 64]]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a : a + 64], pa.int64()), pa.array(rows, pa.binary())], ["bucket", "block"])
            if spans:
                yield from known([np.concatenate(c) for c in zip(*spans)])

        def known(columns):
            """Spans that are settled within a block travel with the runs, under numbers that no bucket has."""
            data = np.stack([np.asarray(c, "<i8") for c in columns], axis=1)
            for a in range(0, len(data), 50_000):
                number = -1 - int((data[a, 0] ^ data[a, 2]) % buckets)
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([data[a : a + 50_000].tobytes()], pa.binary())], ["bucket", "block"])

        def flush():
            # ascending ids, so that the first of equal texts is the earliest
            held_.sort(key=lambda r: r[0])
            first: dict[bytes, tuple] = {}
            gone = [(i, tie, len(raw)) for i, tie, raw in held_ if first.setdefault(raw, (i, tie)) != (i, tie)]
            texts = [(i, tie, raw) for raw, (i, tie) in first.items()]
            held_.clear()
            first.clear()
            yield from emit(texts)
            if gone:  # whole copies
                ids_, ties, sizes = zip(*gone)
                yield from known([ids_, ties, np.zeros(len(gone)), sizes])

        release()
        held_, size = [], 0
        for batch in batches:
            for a, n in slices(batch.column(1)):
                for i, text in zip(batch.column(0).slice(a, n).to_pylist(), batch.column(1).slice(a, n).to_pylist()):
                    raw = utf8(text)
                    if len(raw) < length:
                        continue
                    held_.append((i, int(np.uint64(xxh64_intdigest(raw, 42)).astype(np.int64)), raw))
                    size += len(raw)
                    if size >= BLOCK_BYTES:
                        yield from flush()
                        size = 0
        yield from flush()
        settle()

    def find(batches):
        def rows(spans):
            ids, ties, starts, ends = (np.concatenate(c) for c in zip(*spans))
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ties), pa.array(starts), pa.array(ends)], ["doc_id", "tie", "start", "end"])

        def blocks():
            for batch in batches:
                for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield bucket, block.as_buffer()

        release()
        stream = blocks()
        item = next(stream, None)
        while item is not None:
            bucket = item[0]
            if bucket < 0:
                yield rows([np.frombuffer(item[1], "<i8").reshape(-1, 4).T])
                item = next(stream, None)
                continue

            def own():
                nonlocal item
                while item is not None and item[0] == bucket:
                    yield Runs.unpack(item[1], length, ranks)
                    item = next(stream, None)

            spans = bucket_spans(own(), length)
            settle()
            if spans:
                yield rows(spans)
        settle()

    dealt = narrow.mapInArrow(cut, "bucket long, block binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(find, "doc_id long, tie long, start long, end long")


def with_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with columns c0, c1 and so on, the text compressed (see expanded), and two columns more: starts and ends, bounds
    of repeated spans, unordered and overlapping, or null."""
    found = repeated_spans(docs, length, id_col, text_col).groupBy("doc_id", "tie")
    lists = found.agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    lists = lists.select("doc_id", "tie", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    at, names = docs.columns.index(text_col), [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    key = {
        "key_id": F.coalesce(F.col(names[docs.columns.index(id_col)]).cast("long"), F.lit(NULL_ID)),
        "key_tie": F.xxhash64(F.coalesce(F.col(names[at]).cast("string"), F.lit(""))),
    }
    keyed = plain.withColumns(key | {names[at]: F.col(names[at]).cast("string")})
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == names[at] else f for f in keyed.schema])

    def pack(batches):
        import zstandard

        release()
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for a, n in slices(batch.column(at)):
                columns = list(batch.slice(a, n).columns)
                columns[at] = pa.array([None if t is None else press(utf8(t)) for t in columns[at].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)
        settle()

    packed = keyed.mapInArrow(pack, schema)
    joined = packed.join(lists, (F.col("key_id") == F.col("doc_id")) & (F.col("key_tie") == F.col("tie")), "left")
    return joined.select(*names, "starts", "ends")


def expanded(data: bytes | None) -> bytes | None:
    import zstandard

    return None if data is None else zstandard.ZstdDecompressor().decompress(data)


def texts_with_spans(batches, at: int):
    """(batch, list of (bytes or None, merged spans)) of slices of what with_spans gives; at: the text's column."""
    for batch in batches:
        for a, n in slices(batch.column(at), 1 << 20):
            piece = batch.slice(a, n)
            starts, ends = (piece.column(piece.num_columns - k) for k in (2, 1))
            cuts = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(starts), 0).to_numpy(zero_copy_only=False)))).tolist()
            x, y = (c.flatten().to_numpy(zero_copy_only=False) for c in (starts, ends))
            out = []
            for k, data in enumerate(piece.column(at).to_pylist()):
                raw = expanded(data)
                out.append((raw, merge_spans(x[cuts[k] : cuts[k + 1]], y[cuts[k] : cuts[k + 1]], len(raw or b""))))
            yield piece, out


def merge_spans(starts, ends, n: int) -> list[tuple[int, int]]:
    """Maximal runs of covered places."""
    if not len(starts):
        return []
    starts, ends = np.asarray(starts, np.int64), np.asarray(ends, np.int64)
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.concatenate(([True], a[1:] > b[:-1])))
    last = np.concatenate((new[1:], [len(a)])) - 1
    return list(zip(a[new].tolist(), np.minimum(b[last], n).tolist()))


def keep(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def on_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole characters, so that what stays is valid UTF-8."""
    out = []
    for a, b in spans:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return out


def _results(docs: DataFrame, length: int, id_col: str, text_col: str, names: list[str], last, kind: pa.DataType, schema: str) -> DataFrame:
    """(doc_id, n_bytes, spans, ...): the last column is last(bytes, spans)."""
    joined = with_spans(id_text(docs, id_col, text_col), length)
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for piece, found in texts_with_spans(batches, 1):
            spans = [[{"start": x, "end": y} for x, y in cut] for _, cut in found]
            columns = [piece.column(0), pa.array([len(raw or b"") for raw, _ in found], pa.int64()), pa.array(spans, kinds), pa.array([last(raw or b"", cut) for raw, cut in found], kind)]
            yield pa.RecordBatch.from_arrays(columns, names)
        settle()

    return joined.mapInArrow(run, f"doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, {schema}")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): spans as array of [start, end), kept as binary."""
    return _results(docs, length, id_col, text_col, ["doc_id", "n_bytes", "spans", "kept"], keep, pa.binary(), "kept binary")


def suffix_dedup_digests(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same with the SHA-256 of what is kept, which then never leaves the Python worker."""

    def digest(raw, spans):
        return hashlib.sha256(keep(raw, spans)).hexdigest()

    return _results(docs, length, id_col, text_col, ["doc_id", "n_bytes", "spans", "kept_sha256"], digest, pa.string(), "kept_sha256 string")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup_digests(load(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")
