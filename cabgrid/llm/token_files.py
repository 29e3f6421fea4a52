"""Token ids as bit-plane or byte-plane shards with a chunk index.

A shard holds the ids of consecutive documents. They are cut into blocks of a
fixed number of ids; each block is one chunk. Of a chunk, plane ``p`` holds bit
(or byte) ``p`` of every id, so that the almost empty high planes stand apart,
and each plane is compressed with zstandard on its own. Layout, all numbers
little-endian:

    magic | planes of chunk 0, 1, ... | document index | chunk index | footer

The document index is a compressed array of (doc_id, 1 if it is null, number
of ids); the chunk index has, per chunk, the offset in the file, the number of
ids and the compressed size of each plane. The footer says how long both are
and which planes were used. A reader can fetch any chunk by one ranged read.

Shards are written to a name of the attempt's own and moved to their final name
when complete, so a lost executor or a second attempt leaves no half-written
shard behind that anyone reads. Executors reach the folder through pyarrow's
file systems, by the URI Spark uses for it.

Cases: a null text is an empty one and holds only the end id; equal ids of
documents are ordered by text; an empty table gives no shards and no rows;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cabgrid import session
from cabgrid.llm.common import batch_of, partitions, parts, rows_of, stored, texts
from cabgrid.llm.encoding import encoder

MAGIC = b"IDPLANE1"
FOOTER = struct.Struct("<QQQIIB3x")  # ids, bytes of document index, of chunk index, ids a block, planes, bits a plane
BLOCK = 1 << 16
#: A shard is closed at the first document end after so many ids.
SHARD_IDS = 1 << 25
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MANIFEST = "path string, task int, part int, first_doc long, documents long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The 32 bit planes or 4 byte planes of unsigned 32-bit ids."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [octets[:, p].tobytes() for p in range(4)]
    each = np.unpackbits(octets, axis=1, bitorder="little")
    return [np.packbits(each[:, p], bitorder="little").tobytes() for p in range(32)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    if bits == 8:
        octets = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        each = [np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little", count=n) for p in planes]
        octets = np.packbits(np.stack(each, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").ravel()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """A file system and a path in it, for a folder named the way Spark names it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri.removeprefix("file://").removeprefix("file:")
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class ShardWriter:
    def __init__(self, fs: pafs.FileSystem, path: str, attempt: str, bits: int = 8, block: int = BLOCK) -> None:
        self.fs, self.path, self.own = fs, path, f"{path}.{attempt}"
        self.bits, self.block = bits, block
        self.out = fs.open_output_stream(self.own)
        self.out.write(MAGIC)
        self.at, self.n_ids = len(MAGIC), 0
        self.pending = bytearray()
        self.docs: list[tuple[int, int, int]] = []
        self.chunks: list[list[int]] = []
        self.press = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id or 0, int(doc_id is None), len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.pending += ids
        while len(self.pending) >= 4 * self.block:
            self._chunk(self.block)

    def _chunk(self, n: int) -> None:
        ids = np.frombuffer(bytes(self.pending[: 4 * n]), "<u4")
        del self.pending[: 4 * n]
        pressed = [self.press.compress(p) for p in to_planes(ids, self.bits)]
        self.chunks.append([self.at, n, *map(len, pressed)])
        for p in pressed:
            self.out.write(p)
            self.at += len(p)

    def close(self) -> None:
        if self.pending:
            self._chunk(len(self.pending) // 4)
        docs = self.press.compress(np.array(self.docs, "<i8").tobytes())
        chunks = self.press.compress(np.array(self.chunks, "<i8").tobytes())
        planes = 32 // self.bits
        self.out.write(docs + chunks)
        self.out.write(FOOTER.pack(self.n_ids, len(docs), len(chunks), self.block, planes, self.bits) + MAGIC)
        self.out.close()
        self.fs.move(self.own, self.path)


class ShardReader:
    def __init__(self, fs: pafs.FileSystem, path: str) -> None:
        self.file = fs.open_input_file(path)
        size, tail = self.file.size(), FOOTER.size + len(MAGIC)
        end = self.file.read_at(tail, size - tail)
        if end[-len(MAGIC) :] != MAGIC:
            raise ValueError(f"{path} is no complete shard")
        self.n_ids, docs, chunks, _, planes, self.bits = FOOTER.unpack(end[: FOOTER.size])
        unpress = zstandard.ZstdDecompressor().decompress
        index = self.file.read_at(docs + chunks, size - tail - docs - chunks)
        self.docs = np.frombuffer(unpress(index[:docs]), "<i8").reshape(-1, 3)
        self.chunks = np.frombuffer(unpress(index[docs:]), "<i8").reshape(-1, 2 + planes)
        self.unpress = unpress

    def chunk(self, at: int) -> np.ndarray:
        """The ids of one chunk, by one ranged read."""
        offset, n, *sizes = self.chunks[at].tolist()
        data, planes, begin = self.file.read_at(sum(sizes), offset), [], 0
        for size in sizes:
            planes.append(self.unpress(data[begin : begin + size]))
            begin += size
        return from_planes(planes, n, self.bits)

    def documents(self) -> Iterator[tuple[int | None, int, int]]:
        """(doc_id, ids, crc32 of the ids) of each document; at most one chunk is held."""
        chunk, at, rest = -1, 0, b""
        for doc_id, null, n in self.docs.tolist():
            crc, need = 0, 4 * n
            while need:
                if at == len(rest):
                    chunk, at = chunk + 1, 0
                    rest = self.chunk(chunk).tobytes()
                part = rest[at : at + need]
                crc = zlib.crc32(part, crc)
                at += len(part)
                need -= len(part)
            yield (None if null else doc_id), n, crc


def write(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, bits: int = 8, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write all ids to ``folder`` in ascending order of doc_id; the stored list of shards.

    Sampled splitters deal the documents by doc_id, each task sorts its own and
    streams them to shards; only one block of ids is held at a time.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()
    ordered = texts(docs).repartitionByRange(partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        encode, context = encoder(tokenizer).encode, TaskContext.get()
        task, attempt, part, shard = context.partitionId(), str(context.taskAttemptId()), 0, None

        def done(shard: ShardWriter) -> pa.RecordBatch:
            shard.close()
            name, first = shard.path.rsplit("/", 1)[1], shard.docs[0]
            first_id = None if first[1] else first[0]
            return rows_of(MANIFEST, [(f"{folder}/{name}", task, part, first_id, len(shard.docs), shard.n_ids)])

        for batch in parts(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if shard is None:
                    shard = ShardWriter(fs, f"{base}/{task:06d}-{part:04d}.ids", attempt, bits)
                shard.add(doc_id, encode(text) + end)
                if shard.n_ids >= shard_ids:
                    yield done(shard)
                    part, shard = part + 1, None
        if shard is not None:
            yield done(shard)

    return stored(ordered.mapInArrow(put, MANIFEST), "shards")


def read(shards: DataFrame) -> DataFrame:
    """Every document of the listed shards, from the files: ids before it, ids, and their crc32."""
    before = Window.orderBy("task", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    listed = shards.withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(*(c.to_pylist() for c in batch.columns)):
                folder, name = path.rsplit("/", 1)
                fs, base = open_folder(folder)
                doc_ids, sizes, crcs = zip(*ShardReader(fs, f"{base}/{name}").documents())
                yield batch_of(READ, doc_ids, before + np.cumsum(sizes) - sizes, sizes, crcs)

    spread = partitions(shards.sparkSession)
    return listed.select("path", "before").repartition(spread).mapInArrow(get, READ)


def write_and_read(docs: DataFrame, tokenizer: str = TOKENIZER, bits: int = 8) -> DataFrame:
    """Round trip through shards in a fresh folder of the shared one."""
    return read(write(docs, session.scratch_path(docs.sparkSession, "token-ids"), tokenizer, bits))
