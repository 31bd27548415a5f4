"""Token ids of documents, in files of patched frame-of-reference segments in ascending doc_id order.

Documents are encoded where they are read; only their ids are shuffled, into doc_id ranges, and each range is written as a
stream of segments (see pfor) of whole documents, as binary values of a table in the shared folder: Spark's
committer makes a lost executor's partial output vanish, in any store. The number of ids before a document is the total of
the ranges before its own (one small row each), plus the place that its segment's header gives, plus what stands
before it in the segment.

Defined results: a null text is encoded as the empty one, so it has the end id alone; rows with a null id come first;
repeated rows are written each; ties are ordered by a hash of their ids and then by these; very long texts are encoded whole,
a segment holds whole documents; an empty table gives no files and no rows; extra columns
are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, load, new_path, settle
from .pfor import read_segment, write_segment
from .units import Carried, Memo, encode_texts, held, new_key, slices

SEGMENT_IDS = 1 << 17
#: Pieces in a generation of the memo, and bytes of text that are encoded in one go: the more, the fewer pieces come again.
REMEMBER, TOGETHER = 400_000, 4 << 20
#: Bytes of a tokenizer's file that may travel with the tasks.
MAX_TOKENIZER = 64 << 20
NULL_ID = -(2**63)
#: White space, in UTF-8, in the widest sense of any of the libraries.
_WHITE = re.compile(
    rb"[\t-\r\x1c-\x20]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8b\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf"
)
_WHITE_BUT_SPACE = _WHITE.pattern.decode().replace(r"\x20", r"\x1f")
#: Words that the library gets as one text: it takes longer over a long text than over its parts.
WORDS = 128
REPORT = "doc_id long, start long, n_tokens long, ids_crc32 long"


class LibraryEncoder:
    """Ids by the tokenizers library; equal pieces of text are given to it once, as long as they are remembered."""

    def __init__(self, path: str, end_id: int, remember: int = REMEMBER):
        with open(path, encoding="utf-8") as f:
            self.definition = f.read(MAX_TOKENIZER + 1)
        if len(self.definition) > MAX_TOKENIZER:
            raise ValueError(f"{path} is over {MAX_TOKENIZER} characters")
        self.end_id, self.remember, self.tokenizer, self.key = end_id, remember, None, new_key()

    def __getstate__(self):
        return {"definition": self.definition, "end_id": self.end_id, "remember": self.remember, "tokenizer": None, "key": self.key}

    def _prepare(self):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.definition)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        most = max(self.end_id, *vocabulary.values())
        #: Bytes of an id on its way to a file.
        self.width = 2 if most < 1 << 16 else 4
        self._spaced = np.zeros(most + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True  # the byte-level mark of a space
        self._memo = Memo(self._pieces, self.remember)

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The library gets the pieces that are a space and a word as texts of many. No id's bytes join two of them, and those
        of each one's first id start with the space, which tells where a piece begins. Other pieces are texts of their own."""
        words = [i for i, p in enumerate(pieces) if p[:1] == b" " and len(p) > 1]
        own = [pieces[i] for i in words]
        # one look at all of them; piece by piece only where one has more white space than its first byte
        text = b"".join(own)
        if text.count(b" ") != len(own) or pc.match_substring_regex(pa.array([text], pa.binary()), _WHITE_BUT_SPACE)[0].as_py():
            words = [i for i in words if not _WHITE.search(pieces[i], 1)]
            own = [pieces[i] for i in words]
        others = np.setdiff1d(np.arange(len(pieces)), words, assume_unique=True).tolist()
        out: list[bytes] = [b""] * len(pieces)
        if words:
            many = [b"".join(own[a : a + WORDS]).decode("utf-8", "surrogatepass") for a in range(0, len(own), WORDS)]
            each = array("I")
            for found in self.tokenizer.encode_batch_fast(many, add_special_tokens=False):
                each.extend(found.ids)
            ids = np.frombuffer(each, "<u4")
            starts = np.flatnonzero(self._spaced[ids])
            if len(starts) != len(words):  # a vocabulary of another kind
                raise ValueError("this tokenizer does not mark the start of words by a space")
            raw, cuts = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
            for i, a, b in zip(words, cuts, cuts[1:]):
                out[i] = raw[a:b]
        texts = [pieces[i].decode("utf-8", "surrogatepass") for i in others]
        for i, found in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else ()):
            out[i] = array("I", found.ids).tobytes()
        return out

    def encode_arrow(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts, one text behind the other, each with the end id, and the number of ids up to each text's end."""
        if self.tokenizer is None:
            self._prepare()
        ids, ends = encode_texts(texts, self._memo)
        out = np.full(len(ids) + len(ends), self.end_id, np.uint32)
        out[np.arange(len(ids)) + np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))] = ids
        return out, ends + np.arange(1, len(ends) + 1)


def part_of(cuts: np.ndarray, ids: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Number of the range that each id is in. An id that is a cut several times fills as many ranges, dealt out by tie (a
    fraction of 1), so that one id with many rows is not one task."""
    left, right = np.searchsorted(cuts, ids, side="left"), np.searchsorted(cuts, ids, side="right")
    many = right - left
    return np.where(many > 1, left + 1 + np.minimum((tie * many).astype(np.int64), many - 1), right).astype(np.int32)


def write_token_files(docs: DataFrame, encoder: LibraryEncoder, path: str, id_col: str = "doc_id", text_col: str = "text", segment_ids: int = SEGMENT_IDS, parts: int | None = None) -> None:
    """Writes (part, segment, n_ids, payload) to path."""
    carried = Carried(encoder)

    def encode(batches):
        from xxhash import xxh3_64_intdigest

        own = held(carried)
        for batch in batches:
            for a, n in slices(batch.column(1), TOGETHER):
                ids = batch.column(0).slice(a, n).fill_null(NULL_ID)
                flat, ends = own.encode_arrow(batch.column(1).slice(a, n))
                raw = flat.astype(f"<u{own.width}")
                at = (np.concatenate(([0], ends)) * own.width).astype(np.int32)
                view = memoryview(raw).cast("B")
                tie = np.array([xxh3_64_intdigest(view[x:y]) >> 1 for x, y in zip(at.tolist(), at[1:].tolist())], np.int64)
                part = part_of(cuts, ids.to_numpy(zero_copy_only=False), tie / 2.0**63)
                small = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([ids, small, pa.array(part), pa.array(tie)], ["doc_id", "ids", "part", "tie"])
        settle()

    def segments(batches):
        part, number, first, size = None, 0, 0, 0
        held_: list[tuple] = []

        def flush():
            nonlocal number, first, size
            doc_ids, lengths, ids = (np.concatenate([h[k] for h in held_]) for k in range(3))
            payload = write_segment(doc_ids, lengths, ids, first)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())],
                ["part", "segment", "n_ids", "payload"],
            )
            number, first, size = number + 1, first + size, 0
            held_.clear()
            return row

        for batch in batches:
            doc_ids, parts_ = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            flat, ends = _flat(batch.column(1), width)
            lengths = np.diff(ends, prepend=0)
            stops = [*(np.flatnonzero(np.diff(parts_)) + 1).tolist(), len(parts_)]
            a = 0
            while a < len(parts_):
                if parts_[a] != part:
                    if held_:
                        yield flush()
                    part, number, first = int(parts_[a]), 0, 0
                before = int(ends[a - 1]) if a else 0
                full = int(np.searchsorted(ends, before + segment_ids - size)) + 1  # with it the segment is full
                b = min(full, next(s for s in stops if s > a))
                held_.append((doc_ids[a:b], lengths[a:b], flat[before : ends[b - 1]]))
                size += int(ends[b - 1]) - before
                if size >= segment_ids:
                    yield flush()
                a = b
        if held_:
            yield flush()
        settle()

    narrow = id_text(docs, id_col, text_col)
    # cuts of the ranges come from the ids alone: a sample of what is dealt out would encode all texts once more
    parts = parts or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = F.coalesce("doc_id", F.lit(NULL_ID))
    found = narrow.agg(F.percentile_approx(known, [k / parts for k in range(1, parts)] or [0.5], max(10_000, 20 * parts)).alias("b")).first().b
    cuts = np.array(sorted(found or []), np.int64)
    encoder._prepare()
    width = encoder.width
    encoded = narrow.mapInArrow(encode, "doc_id long, ids binary, part int, tie long")
    dealt = encoded.repartition("part").sortWithinPartitions("part", "doc_id", "tie", "ids").select("doc_id", "ids", "part")
    packed = dealt.mapInArrow(segments, "part int, segment int, n_ids long, payload binary")
    packed.write.option("compression", "uncompressed").parquet(path)


def _flat(ids: pa.BinaryArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column, one row behind the other, and the number of ids up to each row's end."""
    offsets = np.frombuffer(ids.buffers()[1], np.int32, len(ids) + 1, 4 * ids.offset).astype(np.int64)
    flat = np.frombuffer(ids.buffers()[2], f"<u{width}", int(offsets[-1] - offsets[0]) // width, int(offsets[0]))
    return flat, (offsets[1:] - offsets[0]) // width


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32), from the files alone."""
    table = spark.read.schema("part int, segment int, n_ids long, payload binary").parquet(path)
    starts, before = {}, 0
    for r in sorted(table.groupBy("part").agg(F.sum("n_ids").alias("n")).collect(), key=lambda r: r["part"]):
        starts[r["part"]] = before
        before += r["n"]

    def report(batches):
        # one segment at a time, each freed before the next
        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, lengths, ids, first = read_segment(payload.as_buffer().to_pybytes())
                ends = np.cumsum(lengths)
                flat = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(memoryview(flat)[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, mask=doc_ids == NULL_ID),
                        pa.array(starts[part] + first + ends - lengths),
                        pa.array(lengths),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return table.select("part", "payload").mapInArrow(report, REPORT)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = new_path(spark, "token-files")
    write_token_files(load(spark, sf_dir, "documents"), LibraryEncoder(public_tokenizers.path("byte_bpe_50k.json"), end_id=2), path)
    return read_token_files(spark, path)
