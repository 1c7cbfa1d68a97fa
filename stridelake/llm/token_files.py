"""Token ids in seekable zstandard files.

A file is a row of independent zstandard frames, then a seek table: a skippable
frame with the compressed size, the size and the checksum (low 32 bits of XXH64)
of every frame, closed by the frame count, a descriptor and the magic number of
the public seekable format.  The last data frame is the index, an Arrow
stream of the documents' ids, frames, offsets and lengths.  A reader of one document reads the footer, the
table, the index and the frame it needs; any zstandard reader can decompress the
whole file.  A document is never split over frames.

Files hold documents in ascending order of id (null ids first, then by text), a
file for each range of ids.  Tasks write under a name of their own attempt and
rename, so a repeated or duplicate task leaves the same file.  Files go to the
shared folder by pyarrow's file systems.

Defined results: null and empty texts are the end id alone; rows with equal ids
are each written; an empty table writes no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm.base import materialize, table, text_slices
from stridelake.llm.tokens import worker_tokenizer
from stridelake.session import new_run_dir

# Fixed values of the public seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

END_ID = 2
FRAME_BYTES = 1 << 18


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FrameWriter:
    """Writes frames and, at the end, the seek table."""

    def __init__(self, sink, level: int = 3):
        self._sink, self._zstd, self.table = sink, zstandard.ZstdCompressor(level=level), []

    def add(self, data: bytes) -> None:
        packed = self._zstd.compress(data)
        self._sink.write(packed)
        self.table.append((len(packed), len(data), _checksum(data)))

    def close(self) -> None:
        entries = b"".join(struct.pack("<III", *e) for e in self.table)
        footer = struct.pack("<IBI", len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)


class FrameReader:
    """Random access to the frames and documents of a file."""

    def __init__(self, file):
        self._file = file
        size = file.size()
        frames, descriptor, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or descriptor != CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        entries = self._read(size - 9 - 12 * frames, 12 * frames)
        self.table = list(struct.iter_unpack("<III", entries))
        self.starts = [0, *np.cumsum([e[0] for e in self.table]).tolist()]
        index = pa.ipc.open_stream(self.frame(frames - 1)).read_all()
        self.ids = index["id"].to_pylist()
        self.places = np.stack([index[c].to_numpy() for c in ("frame", "offset", "n")], axis=1)

    def _read(self, at: int, n: int) -> bytes:
        self._file.seek(at)
        return self._file.read(n)

    def frame(self, k: int) -> bytes:
        packed, size, checksum = self.table[k]
        data = zstandard.ZstdDecompressor().decompress(self._read(self.starts[k], packed), max_output_size=size)
        if len(data) != size or _checksum(data) != checksum:
            raise ValueError(f"frame {k} is damaged")
        return data

    def document(self, row: int) -> np.ndarray:
        """Token ids of the file's document at this place; only its frame is read."""
        frame, offset, n = self.places[row].tolist()
        return np.frombuffer(self.frame(frame), "<u4", n, offset)

    def documents(self) -> Iterator[bytes]:
        """Token ids of all documents in order, a frame at a time."""
        held, data = -1, b""
        for frame, offset, n in self.places.tolist():
            if frame != held:
                held, data = frame, self.frame(frame)
            yield data[offset : offset + 4 * n]


def open_file(uri: str):
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _written(folder: str, path: str | None, end_id: int, frame_bytes: int, level: int):
    """Write a split as one file; a row for it: part, documents, tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, tokenizer, end = context.partitionId(), worker_tokenizer(path), np.array([end_id], "<u4").tobytes()
        system, root = fs.FileSystem.from_uri(folder)
        name, own = f"{root}/part-{part:08d}.zst", f"{root}/.part-{part:08d}-{context.taskAttemptId()}"
        sink = writer = None
        names, places, held, size, total = [], [], [], 0, 0
        try:
            for rows, texts in text_slices(batches):
                if writer is None:
                    system.create_dir(root, recursive=True)
                    sink = system.open_output_stream(own)
                    writer = FrameWriter(sink, level)
                names.append(rows.column(0))
                for ids in tokenizer.encode(texts):
                    ids += end
                    if held and size + len(ids) > frame_bytes:
                        writer.add(b"".join(held))
                        held, size = [], 0
                    places.append((len(writer.table), size, len(ids) // 4))
                    held.append(ids)
                    size += len(ids)
                    total += len(ids) // 4
            if writer is not None:
                writer.add(b"".join(held))
                index = pa.table({"id": pa.chunked_array(names), **{c: pa.array(v, pa.int64()) for c, v in zip(("frame", "offset", "n"), zip(*places))}})
                stream = pa.BufferOutputStream()
                with pa.ipc.new_stream(stream, index.schema) as out:
                    out.write_table(index)
                writer.add(stream.getvalue().to_pybytes())
                writer.close()
                sink.close()
                system.move(own, name)
                sink = None
        finally:
            if sink is not None:  # the attempt failed: its file goes
                sink.close()
                system.delete_file(own)
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(places)], pa.int64()), pa.array([total], pa.int64())], ["part", "documents", "tokens"])

    return run


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, tokenizer: str | None = None, frame_bytes: int = FRAME_BYTES, level: int = 3) -> DataFrame:
    """Write the files and return their catalogue: part (the file's number), documents, tokens."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("__id", F.xxhash64("text")).sortWithinPartitions("__id", F.xxhash64("text"))
    return materialize(rows.mapInArrow(_written(folder, tokenizer, end_id, frame_bytes, level), "part int, documents long, tokens long"), "token-catalogue")


def _read(folder: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_file(f"{folder}/part-{part:08d}.zst") as file:
                    reader = FrameReader(file)
                    sizes, crcs = reader.places[:, 2], []
                    for ids in reader.documents():
                        crcs.append(zlib.crc32(ids))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.ids, batch.schema.field(2).type), pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes), pa.array(crcs, pa.int64())], names
                    )

    return run


def read_back(spark: SparkSession, catalogue: DataFrame, folder: str, id_col: str = "doc_id", id_type: str = "long") -> DataFrame:
    """From the files: the id, start (tokens of all documents before), n_tokens, ids_crc32."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = catalogue.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"), F.lit(None).cast(id_type).alias("id"))
    files = files.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "part")
    return files.mapInArrow(_read(folder, [id_col, "start", "n_tokens", "ids_crc32"]), f"`{id_col}` {id_type}, start long, n_tokens long, ids_crc32 long")


def op4_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from the files."""
    folder = f"{new_run_dir(spark, 'tokens')}/files"
    catalogue = write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_back(spark, catalogue, folder)
