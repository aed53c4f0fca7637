"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is, in order: data frames, each a complete zstandard frame of little-endian unsigned 32-bit
ids; a skippable frame with the document index (an Arrow stream of key and number of ids, in file
order); a skippable frame with the seek table, laid out as zstandard's published seekable format
(compressed and decompressed size and checksum of every frame, then the number of frames, a
descriptor and a magic number). A plain zstandard decoder reads the ids as one stream; a reader that
wants some documents loads the table and decompresses only the frames they lie in, checking each.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugeline.llm.encoding import encoder_of, with_end
from gaugeline.llm.texts import batch_of, filled, pa_schema, slices
from gaugeline.session import new_path, written
from gaugeline.ship import ship

# Fixed values of the seekable format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
#: Ids in a data frame.
FRAME_IDS = 1 << 16
LEVEL = 3


def place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder given as a path or URI."""
    return fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "", 1))


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class TokenFileWriter:
    """Writes one file; ids may be added in portions of any size."""

    def __init__(self, stream, key_type: pa.DataType):
        self.stream, self.key_type = stream, key_type
        self.frames: list[tuple[int, int, int]] = []
        self.keys: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.rest = np.zeros(0, "<u4")
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)

    def add(self, keys: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(np.diff(offsets))
        self.rest = np.concatenate([self.rest, ids.astype("<u4")])
        whole = len(self.rest) // FRAME_IDS * FRAME_IDS
        for at in range(0, whole, FRAME_IDS):
            self._frame(self.rest[at : at + FRAME_IDS])
        self.rest = self.rest[whole:].copy()

    def _frame(self, ids: np.ndarray) -> None:
        raw = ids.tobytes()
        packed = self.compressor.compress(raw)
        self.stream.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> tuple[int, int]:
        """Finish the file; the numbers of its documents and ids."""
        if len(self.rest):
            self._frame(self.rest)
        counts = np.concatenate([*self.counts, np.zeros(0, np.int64)])
        index = pa.table({"key": pa.chunked_array(self.keys, self.key_type), "n": pa.array(counts, pa.int64())})
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, index.schema) as out:
            out.write_table(index)
        self.stream.write(_skippable(SKIPPABLE_INDEX, zstandard.ZstdCompressor(LEVEL).compress(sink.getvalue())))
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.stream.write(_skippable(SKIPPABLE_SEEK_TABLE, table))
        return len(counts), int(counts.sum())


class TokenFile:
    """Reads one file through its seek table."""

    def __init__(self, path: str):
        system, where = place(path)
        self.file = system.open_input_file(where)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError(f"{path}: no seek table")
        at = size - 9 - 12 * n
        self.frames = np.frombuffer(self._bytes(at, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        head = int(self.starts[-1])
        _, length = struct.unpack("<II", self._bytes(head, 8))
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(head + 8, length))
        index = pa.ipc.open_stream(raw).read_all()
        self.keys, self.counts = index["key"], index["n"].to_numpy()
        self.ends = np.cumsum(self.counts)
        self.id_ends = np.cumsum(self.frames[:, 1]) // 4

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def frame(self, i: int) -> np.ndarray:
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(int(self.starts[i]), int(self.frames[i, 0])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(raw, "<u4")

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document; only the frames it lies in are decompressed."""
        stop = int(self.ends[i])
        start = stop - int(self.counts[i])
        if start == stop:
            return np.zeros(0, "<u4")
        first, last = np.searchsorted(self.id_ends, [start, stop - 1], "right")
        ids = np.concatenate([self.frame(j) for j in range(first, last + 1)])
        before = int(self.id_ends[first - 1]) if first else 0
        return ids[start - before : stop - before]

    def checksums(self) -> Iterator[tuple[int, int]]:
        """Number and crc32 of each document, frame by frame in file order."""
        doc, value, left = 0, 0, int(self.counts[0]) * 4 if len(self.counts) else 0
        for i in range(len(self.frames)):
            raw, at = self.frame(i).tobytes(), 0
            while at < len(raw):
                take = min(left, len(raw) - at)
                value, left, at = zlib.crc32(raw[at : at + take], value), left - take, at + take
                while left == 0:
                    yield doc, value
                    doc, value = doc + 1, 0
                    if doc == len(self.counts):
                        return
                    left = int(self.counts[doc]) * 4


MANIFEST = "shard int, path string, n_documents bigint, n_ids bigint"


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of every text, ``end_id`` appended, in ascending ``key`` order, one file for
    each range of keys; returns the manifest (shard, path, documents, ids).

    ``folder`` (by default a new one in the shared folder) must be a path or URI all executors reach.
    Each attempt of a task writes a file of its own name, and only files in the manifest count, so a
    lost or repeated task does no harm. A null text counts as empty (its end id only), null keys
    come first, rows with equal keys are ordered by a hash of their text, and an empty table gives an
    empty manifest. Columns other than ``key`` and ``text`` are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_path(spark, "tokens")
    schema = pa_schema(MANIFEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, writer, path = TaskContext.get().partitionId(), None, f"{folder}/{uuid.uuid4().hex}.zst"
        encoder = encoder_of(vocabulary)
        for part in slices(batches, "_text"):
            if writer is None:
                system, where = place(path)
                system.create_dir(where.rsplit("/", 1)[0], recursive=True)
                writer = TokenFileWriter(system.open_output_stream(where, compression=None), part.schema.field("_key").type)
            writer.add(part["_key"], *with_end(*encoder.encode(filled(part["_text"])), end_id))
        if writer is not None:
            n_documents, n_ids = writer.close()
            writer.stream.close()
            yield pa.RecordBatch.from_pylist([{"shard": shard, "path": path, "n_documents": n_documents, "n_ids": n_ids}], schema)

    narrow = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    order = [F.col("_key").asc_nulls_first(), F.xxhash64("_text")]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    return written(ranged.mapInArrow(run, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, key_type: str = "bigint", key: str = "doc_id") -> DataFrame:
    """Per document, read back from the files: key, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32``. Each file is one task's work and is read frame by frame."""
    ship(manifest.sparkSession)
    schema = f"{key} {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    kind = pa_schema(schema)
    # One row for each file: a running sum over the files, not over their documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["path"])
                sums = np.fromiter((c for _, c in file.checksums()), np.int64, len(file.counts))
                done = batch_of(
                    **{key: file.keys.combine_chunks(), "start": row["before"] + file.ends - file.counts, "n_tokens": file.counts, "ids_crc32": sums}
                )
                for at in range(0, done.num_rows, 10_000):
                    yield done.slice(at, 10_000).cast(kind)

    return placed.repartition(max(1, manifest.count())).mapInArrow(run, schema)
