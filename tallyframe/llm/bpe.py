"""Byte-level BPE: two-tier encoding and exact decoding, by a public vocabulary of ranks.

Tier one: a minimal perfect hash (hash and displace) over all vocabulary entries; a pre-token that is an entry is found by
one hash, one displacement and one comparison. Tier two: a heap of adjacent pairs by rank over linked bytes; ties go left.
The vocabulary is read once on the driver (its path is a parameter) and travels with the tasks; its size is checked.

Defined results: a null or empty text has no ids and decodes to no bytes; repeated rows each get a row; an empty table
gives no rows; extra columns are not read. Texts of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from xxhash import xxh3_128_intdigest

from .common import id_text, load, settle, utf8
from .units import REMEMBER, TOGETHER, Carried, Memo, encode_texts, held, new_key, slices

#: Bytes of a rank file that may travel with the tasks.
MAX_RANK_FILE = 64 << 20
_MASK = (1 << 64) - 1
_STEP_INT = 0x9E3779B97F4A7C15
_STEP = np.uint64(_STEP_INT)
#: Over any id; ids of two neighbours make one key.
_WIDE = 1 << 32


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        raw = f.read(MAX_RANK_FILE + 1)
    if len(raw) > MAX_RANK_FILE:
        raise ValueError(f"{path} is over {MAX_RANK_FILE} bytes")
    return {base64.b64decode(k): int(v) for k, v in (line.split() for line in raw.splitlines() if line.strip())}


class PerfectHash:
    """A minimal perfect hash from byte strings to their place in a list.

    One 128-bit hash gives a bucket and two numbers, which a bucket's displacement mixes into a slot for each of its keys.
    Buckets are placed from the largest down, each at the first displacement that finds all of its slots free; what is left,
    buckets of one key, names its slot directly (as a negative displacement).
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 4, tries: int = 256):
        self.n, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        hashed = [self._hash(k) for k in keys]
        for i, (bucket, _, _) in enumerate(hashed):
            groups[bucket].append(i)
        first = np.array([h[1] for h in hashed], np.uint64)
        second = np.array([h[2] for h in hashed], np.uint64)
        displace = np.zeros(self.buckets, np.int64)
        slots = np.full(self.n, -1, np.int64)
        singles = []
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            group = np.array(groups[b], np.int64)
            if len(group) < 2:
                singles += [(b, i) for i in groups[b]]
                continue
            d = 1
            while True:
                x = first[group] + np.arange(d, d + tries, dtype=np.uint64)[:, None] * _STEP
                x = (x ^ (x >> np.uint64(29))) * second[group]
                at = ((x ^ (x >> np.uint64(32))) % np.uint64(self.n)).astype(np.int64)
                ordered = np.sort(at, axis=1)
                good = np.flatnonzero((slots[at] < 0).all(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1))
                if len(good):
                    displace[b] = d + good[0]
                    slots[at[good[0]]] = group
                    break
                d += tries
        for (b, i), slot in zip(singles, np.flatnonzero(slots < 0).tolist()):
            displace[b], slots[slot] = -slot - 1, i
        self.displace, self.slots = displace.tolist(), slots.tolist()

    def _hash(self, key: bytes) -> tuple[int, int, int]:
        h = xxh3_128_intdigest(key)
        return h % self.buckets, h >> 64, (h & _MASK) | 1

    def place(self, key: bytes) -> int:
        """Index of the only key that this one can be."""
        bucket, first, second = self._hash(key)
        d = self.displace[bucket]
        if d < 0:
            return self.slots[-d - 1]
        x = (first + d * _STEP_INT) & _MASK
        x = ((x ^ (x >> 29)) * second) & _MASK
        return self.slots[(x ^ (x >> 32)) % self.n]


class BytePairEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str, remember: int = REMEMBER):
        if lost := [i for i in range(256) if bytes([i]) not in ranks]:
            raise ValueError(f"the vocabulary lacks single bytes: {lost[:5]}")
        self.ranks, self.pattern, self.remember = ranks, pattern, remember
        self.keys = sorted(ranks, key=ranks.get)
        self.ids = [ranks[k] for k in self.keys]
        self.table = PerfectHash(self.keys)
        self._ready, self.key = False, new_key()

    def __getstate__(self):
        state = {k: v for k, v in self.__dict__.items() if k in ("ranks", "pattern", "remember", "keys", "ids", "table", "key")}
        return state | {"_ready": False}

    def _prepare(self):
        import regex

        self._find = regex.compile(self.pattern).findall
        most = max(self.ids, default=0)
        self._bytes = [b""] * (most + 1)
        for k, i in self.ranks.items():
            self._bytes[i] = k
        self._decimal = [str(i) for i in range(most + 1)]
        self._byte = [self.ranks[bytes([i])] for i in range(256)]
        # what two ids merge to; both halves of an entry are entries, or they never meet
        get = self.ranks.get
        self._merged = {
            left * _WIDE + right: r for k, r in self.ranks.items() for i in range(1, len(k))
            if (left := get(k[:i])) is not None and (right := get(k[i:])) is not None
        }
        self._memo = Memo(self._units, self.remember)
        self._ready = True

    def pre_token(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        i = self.table.place(piece)
        return [self.ids[i]] if self.keys[i] == piece else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost of equals, until no pair of neighbours is an entry."""
        if not self._ready:
            self._prepare()
        merged, n = self._merged.get, len(piece)
        part = [self._byte[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [merged(a * _WIDE + b) for a, b in zip(part, part[1:])]  # rank of each part with the next one
        pair.append(None)
        bits = n.bit_length()  # a heap's number is a rank and, in its low bits, a place
        low = (1 << bits) - 1
        heap = [r << bits | i for i, r in enumerate(pair) if r is not None]
        heapq.heapify(heap)
        push, pop = heapq.heappush, heapq.heappop
        while heap:
            top = pop(heap)
            r, i = top >> bits, top & low
            if pair[i] != r:
                continue  # one of the two has been merged since
            j = after[i]
            part[i], part[j], pair[j] = r, -1, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair[i] = new = merged(r * _WIDE + part[k])
                if new is not None:
                    push(heap, new << bits | i)
            else:
                pair[i] = None
            h = before[i]
            if h >= 0:
                pair[h] = new = merged(part[h] * _WIDE + r)
                if new is not None:
                    push(heap, new << bits | h)
        return [p for p in part if p >= 0]

    def _units(self, pieces: list[bytes]) -> list[bytes]:
        out = []
        for piece in pieces:
            ids: list[int] = []
            for match in self._find(piece.decode("utf-8", "surrogatepass")):
                ids += self.pre_token(utf8(match))
            out.append(array("I", ids).tobytes())
        return out

    def encode_arrow(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one behind the other, and the number of ids up to each text's end."""
        if not self._ready:
            self._prepare()
        return encode_texts(texts, self._memo)

    def encode(self, text: str | None) -> list[int]:
        return self.encode_arrow(pa.array([text], pa.string()))[0].tolist()

    def decode(self, ids) -> bytes:
        if not self._ready:
            self._prepare()
        return b"".join(map(self._bytes.__getitem__, ids))

    def decimals(self, ids) -> str:
        if not self._ready:
            self._prepare()
        return " ".join(map(self._decimal.__getitem__, ids))


def encoder(path: str, pattern: str, remember: int = REMEMBER) -> BytePairEncoder:
    return BytePairEncoder(read_ranks(path), pattern, remember)


def encode_documents(docs: DataFrame, bpe: BytePairEncoder, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids)."""
    carried = Carried(bpe)

    def run(batches):
        own = held(carried)
        for batch in batches:
            for a, n in slices(batch.column(1)):
                ids, ends = own.encode_arrow(batch.column(1).slice(a, n))
                offsets = np.concatenate(([0], ends)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))], ["doc_id", "ids"])
        settle()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, bpe: BytePairEncoder) -> DataFrame:
    """(doc_id, content) of (doc_id, ids); content is bytes, as ids may end within a character."""
    carried = Carried(bpe)

    def run(batches):
        own = held(carried)
        for batch in batches:
            got = [own.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.binary())], ["doc_id", "content"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, content binary")


def encoding_report(docs: DataFrame, bpe: BytePairEncoder, id_col: str = "doc_id", text_col: str = "text", together: int = TOGETHER) -> DataFrame:
    """Number of ids, digest of the ids and digest of the bytes that the ids decode to, in one scan. together: bytes of text
    that are encoded in one go."""
    carried = Carried(bpe)

    def run(batches):
        own = held(carried)
        for batch in batches:
            for a, rows in slices(batch.column(1), together):
                flat, ends = own.encode_arrow(batch.column(1).slice(a, rows))
                ends = ends.tolist()
                ids_sha, back_sha = [], []
                for start, end in zip([0, *ends], ends):
                    ids = flat[start:end].tolist()
                    ids_sha.append(hashlib.sha256(own.decimals(ids).encode()).hexdigest())
                    back_sha.append(hashlib.sha256(own.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, rows), pa.array(np.diff(ends, prepend=0)), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        settle()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def public_encoder(remember: int = REMEMBER) -> BytePairEncoder:
    import public_tokenizers

    return encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, remember)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding_report(load(spark, sf_dir, "documents"), public_encoder())
