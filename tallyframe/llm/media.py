"""Media columns: content-addressed payloads in tar shards, with range reads.

A text's UTF-8 bytes, filled up with zero bytes to a positive multiple of WIDTH, are the samples of an 8-bit grey PNG image
of that width: one byte a sample, lossless. The image's SHA-256 is its address and its name in a tar shard. Rows carry
shard, digest, offset and length; metadata columns come from the first bytes of the stored file alone (``HEADER`` bytes,
read as a range), the payload columns from a range read of the whole member.

Images are made and written where the texts are read, so no payload is shuffled. A partition stores equal texts once;
where several partitions have the same text, the least of its places is its address, and the other copies, one a partition
at most, are referred to by no row. Each attempt of a task writes to a shard of a name of its own in the shared folder, and
the index of what was written is a table, so lost executors leave unused files at most.

Defined results: a null text is empty and so WIDTH zero bytes; repeated rows each get a row, rows with a null id too; an
empty table gives no shards and no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_text, load, materialize, new_path, utf8

WIDTH, HEADER = 64, 33
#: A shard is closed beyond so many bytes.
SHARD_BYTES = 256 << 20
_MAGIC = b"\x89PNG\r\n\x1a\n"
INDEX = "digest string, shard string, offset long, length long, n_bytes long, doc_ids array<long>"


def payload_of(text: str | None) -> bytes:
    raw = utf8(text)
    return raw + bytes(-len(raw) % WIDTH if raw else WIDTH)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def to_png(payload: bytes, level: int = 6) -> bytes:
    """Grey, 8 bits a sample, no filter, no interlacing."""
    height = len(payload) // WIDTH
    lines = np.zeros((height, WIDTH + 1), np.uint8)
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(height, WIDTH)
    header = struct.pack(">IIBBBBB", WIDTH, height, 8, 0, 0, 0, 0)
    return _MAGIC + _chunk(b"IHDR", header) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> dict:
    """Width, height, bits and colour type from the first HEADER bytes."""
    if head[:8] != _MAGIC or head[12:16] != b"IHDR":
        raise ValueError("not a PNG file")
    width, height, bits, colour = struct.unpack(">IIBB", head[16:26])
    return {"width": width, "height": height, "bits": bits, "colour": colour}


def from_png(data: bytes) -> bytes:
    """The samples of an image that to_png wrote."""
    info, at, body = png_header(data), 8, b""
    while at < len(data):
        (n,) = struct.unpack_from(">I", data, at)
        if data[at + 4 : at + 8] == b"IDAT":
            body += data[at + 8 : at + 8 + n]
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(body), np.uint8).reshape(info["height"], info["width"] + 1)
    return lines[:, 1:].tobytes()


def _tar_member(name: str, size: int) -> bytes:
    info = tarfile.TarInfo(name)
    info.size = size
    return info.tobuf(tarfile.USTAR_FORMAT)


class TarShards:
    """Writes members to tar shards below a folder, through any store that pyarrow opens."""

    def __init__(self, folder: str, most: int = SHARD_BYTES):
        self.fs, self.path = pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        self.most, self.out, self.name, self.at = most, None, "", 0

    def add(self, digest: str, data: bytes) -> tuple[str, int, int]:
        """(shard, offset, length) of the member's bytes."""
        if self.out is not None and self.at >= self.most:
            self.close()
        if self.out is None:
            self.name, self.at = f"{uuid.uuid4().hex}.tar", 0
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}")
        head = _tar_member(f"{digest}.png", len(data))
        self.out.write(head + data + bytes(-len(data) % 512))
        offset = self.at + len(head)
        self.at = offset + len(data) + -len(data) % 512
        return self.name, offset, len(data)

    def close(self):
        if self.out is not None:
            self.out.write(bytes(1024))
            self.out.close()
            self.out = None


class RangeReader:
    """Reads byte ranges of shards; one shard is open at a time."""

    def __init__(self, folder: str):
        self.fs, self.path = pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        self.name, self.file = None, None

    def read(self, shard: str, offset: int, length: int) -> bytes:
        if shard != self.name:
            if self.file is not None:
                self.file.close()
            self.name, self.file = shard, self.fs.open_input_file(f"{self.path}/{shard}")
        return self.file.read_at(length, offset)


def store_media(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards and returns their index: a row for each digest and batch of documents, at the digest's address."""

    def write(batches):
        shards, places = TarShards(folder), {}
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                groups: dict[bytes, list] = {}
                for i, t in zip(*(c.to_pylist() for c in batch.slice(a, 2000).columns)):
                    groups.setdefault(utf8(t), []).append(i)
                out = []
                for raw, ids in groups.items():
                    key = hashlib.sha256(raw).digest()
                    if key not in places:
                        image = to_png(payload_of(raw.decode("utf-8", "surrogatepass")))
                        digest = hashlib.sha256(image).hexdigest()
                        places[key] = (digest, *shards.add(digest, image))
                    out.append((*places[key], len(raw), ids))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["digest", "shard", "offset", "length", "n_bytes", "doc_ids"])
        shards.close()

    written = materialize(id_text(docs, id_col, text_col).mapInArrow(write, INDEX), "media-index")
    place = written.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("place"))
    return written.select("digest", "n_bytes", "doc_ids").join(place, "digest").select("digest", "place.shard", "place.offset", "place.length", "n_bytes", "doc_ids")


def media_header(index: DataFrame, folder: str) -> DataFrame:
    """Adds width, height, bits and colour to index rows, from range reads of HEADER bytes."""
    cols = index.columns
    schema = T.StructType([*index.schema, *(T.StructField(n, T.IntegerType()) for n in ("width", "height", "bits", "colour"))])

    def run(batches):
        reader = RangeReader(folder)
        for batch in batches:
            where = batch.select(["shard", "offset"])
            got = [png_header(reader.read(s, o, HEADER)) for s, o in zip(*(c.to_pylist() for c in where.columns))]
            new = [pa.array([g[k] for g in got], pa.int32()) for k in ("width", "height", "bits", "colour")]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*cols, "width", "height", "bits", "colour"])

    return index.mapInArrow(run, schema)


def read_media(index: DataFrame, folder: str) -> DataFrame:
    """Adds the payload's and the stored file's figures to index rows, from range reads of whole members."""
    cols = index.columns
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256"]
    schema = T.StructType([*index.schema, *(T.StructField(n, T.StringType() if n.endswith("sha256") else T.LongType()) for n in names)])

    def run(batches):
        reader, last, found = RangeReader(folder), None, None
        for batch in batches:
            out = []
            for at in zip(*(c.to_pylist() for c in batch.select(["shard", "offset", "length"]).columns)):
                if at != last:
                    data, last = reader.read(*at), at
                    samples = from_png(data)
                    found = (len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest())
                out.append(found)
            new = [pa.array([o[k] for o in out], pa.string() if n.endswith("sha256") else pa.int64()) for k, n in enumerate(names)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*cols, *names])

    return index.mapInArrow(run, schema)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "media")
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop)
    index = store_media(load(spark, sf_dir, "documents"), folder)
    places = index.select("digest", "shard", "offset", "length").distinct()
    near = places.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
    media = read_media(media_header(near, folder), folder)
    found = index.select("digest", "n_bytes", "doc_ids").join(media, "digest")
    feature = F.concat_ws(":", F.lit("png"), F.concat_ws("x", "width", "height"), "bits", "colour")
    return found.select(
        F.explode("doc_ids").alias("doc_id"), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
        feature.alias("feature"), "digest", "shard", "offset", "length",
    )
