"""Token ids in files of independent zstandard frames with a trailing seek table.

File format (the public Zstandard seekable format): frames one after the other, each a whole
zstandard frame of little-endian unsigned 32-bit ids; then a skippable frame with, per frame,
its compressed size, its decompressed size and the low 32 bits of the XXH64 of its contents; then
the number of frames, a descriptor byte and the closing magic number. A reader takes the last
bytes of a file, then only the frames that hold the documents it is asked for.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerspark.llm import tokens
from ledgerspark.llm.hashing import slices
from ledgerspark.session import shared_folder, written

# Fixed values of the Zstandard seekable format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")

#: Bytes of ids per frame: a frame is closed after the document that reaches this size, and a
#: document of more than four times this size is cut into frames of its own.
FRAME = 1 << 18

INDEX = "doc_id long, part int, file string, first long, n_tokens long"
READ = "doc_id long, part int, first long, n_tokens long, ids_crc32 long"


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file that all executors share."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class FrameWriter:
    def __init__(self, stream):
        self.stream, self.entries, self.waiting, self.size = stream, [], [], 0
        self.packer = zstandard.ZstdCompressor(level=1)

    def add(self, ids: bytes) -> None:
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= FRAME:
            self.flush()

    def flush(self) -> None:
        raw = b"".join(self.waiting)
        step = len(raw) if len(raw) <= 4 * FRAME else FRAME
        for at in range(0, len(raw), step or 1):
            part = raw[at:at + step]
            packed = self.packer.compress(part)
            self.stream.write(packed)
            self.entries.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(ENTRY.pack(*e) for e in self.entries) + FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        self.stream.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class FrameReader:
    """Reads byte ranges of the decompressed contents; keeps the frame it read last."""

    def __init__(self, stream):
        self.stream, end = stream, stream.size()
        stream.seek(end - FOOTER.size)
        n, flags, magic = FOOTER.unpack(stream.read(FOOTER.size))
        if magic != SEEKABLE or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        size = n * ENTRY.size + FOOTER.size
        stream.seek(end - size - 8)
        if struct.unpack("<II", stream.read(8)) != (SKIPPABLE, size):
            raise ValueError("the seek table does not begin where it should")
        table = np.frombuffer(stream.read(n * ENTRY.size), "<u4").reshape(n, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.bounds = np.concatenate([[0], np.cumsum(table[:, 1])])
        self.checks, self.at, self.frame = table[:, 2], -1, b""
        self.unpacker = zstandard.ZstdDecompressor()

    def _load(self, k: int) -> bytes:
        if k != self.at:
            self.stream.seek(int(self.places[k]))
            self.frame = self.unpacker.decompress(self.stream.read(int(self.places[k + 1] - self.places[k])))
            if xxhash.xxh64_intdigest(self.frame) & 0xFFFFFFFF != self.checks[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self.at = k
        return self.frame

    def read(self, start: int, size: int) -> Iterator[bytes]:
        k = int(np.searchsorted(self.bounds, start, side="right")) - 1
        while size:
            frame, skip = self._load(k), start - int(self.bounds[k])
            part = frame[skip:skip + size]
            yield part
            start, size, k = start + len(part), size - len(part), k + 1


def write_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes all texts in ascending id order; returns the index that finds them again.

    Partitions are ranges of ids, so hot sources and copies spread as any other rows. Each
    attempt of a task writes a file of its own name and only the rows of the attempt that ended
    well name their file: a lost executor or a second attempt never leaves half a file in use.
    A null text counts as empty (its document is the end id alone); a null id comes first;
    documents of the same id follow each other by text; an empty table gives no file.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = tokens.encoder(vocabulary), TaskContext.get().partitionId()
        place, end = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst", np.array([end_id], "<u4").tobytes()
        system, path = opened(place)
        writer, first = None, 0
        for batch in batches:
            for rows in slices(batch, text_col):
                if writer is None:
                    system.create_dir(path.rsplit("/", 1)[0])
                    writer = FrameWriter(system.open_output_stream(path, compression=None))
                sizes = []
                for ids in encoder.encode(rows.column(text_col).to_pylist()):
                    writer.add(ids + end)
                    sizes.append(len(ids) // 4 + 1)
                starts = first + np.cumsum([0, *sizes])
                first, n = int(starts[-1]), rows.num_rows
                yield pa.RecordBatch.from_arrays([rows.column(id_col).cast(pa.int64()), pa.array([part] * n, pa.int32()), pa.array([place] * n, pa.string()), pa.array(starts[:-1], pa.int64()), pa.array(sizes, pa.int64())], ["doc_id", "part", "file", "first", "n_tokens"])
        if writer is not None:
            writer.close()
            writer.stream.close()

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), text_col)
    return written(rows.repartitionByRange(id_col).sortWithinPartitions(id_col, text_col).mapInArrow(write, INDEX))


def read_files(index: DataFrame) -> DataFrame:
    """Reads the documents of index rows from their files: length and crc32 of the ids of each.

    Any subset of the index may be given; only frames that hold one of its documents are read.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, reader = None, None
        for batch in batches:
            crcs, sizes = [], []
            for file, first, n in zip(*[batch.column(c).to_pylist() for c in ("file", "first", "n_tokens")]):
                if file != name:
                    system, path = opened(file)
                    name, reader = file, FrameReader(system.open_input_file(path))
                crc = size = 0
                for part in reader.read(4 * first, 4 * n):
                    crc, size = zlib.crc32(part, crc), size + len(part)
                crcs.append(crc)
                sizes.append(size // 4)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), batch.column("first"), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "part", "first", "n_tokens", "ids_crc32"])

    return index.mapInArrow(read, READ)


def token_digest(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Writes the files, reads them back and gives each document's place among all ids."""
    folder = f"{shared_folder(docs.sparkSession).rstrip('/')}/tokens/{uuid.uuid4().hex}"
    index = write_files(docs, folder, vocabulary, end_id)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: far fewer than documents, so the running sum is a small step.
    bases = index.groupBy("part").agg(F.sum("n_tokens").alias("ids")).select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return read_files(index).join(bases, "part").select("doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
