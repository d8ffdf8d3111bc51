"""Token ids as binary shards: independent zstandard frames with a trailing seek table.

A shard is a file of zstandard frames, one a document, each compressed on its
own.  After them come two skippable frames, which any zstandard decoder passes
over: the documents' ids, and last the seek table of the public seekable
format, with every frame's compressed size, decompressed size and checksum
(the low 32 bits of XXH64 of the decompressed bytes).  A reader loads the
table and decompresses only the frames of the documents it was asked for.

Documents are range-partitioned and sorted by (doc_id, row); every task writes
whole shards under names of its own attempt and renames them when complete,
and the manifest (a row a shard) is committed by Spark, so an attempt that was
lost leaves no shard in it; its files are removed when the manifest is there.
Each shard's first token is a running sum over the manifest, whose rows (one for
SHARD_BYTES of frames) meet in one task.

Defined cases: equal or null ids keep their own frames (null sorts first, ties
go by row); a null text is an empty document, which holds the end id alone; a
text of any length is one frame, encoded whole; an empty table gives no shard;
extra columns are not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mobility.llm.common import ROW, keyed, shared_dir, ship, written
from mobility.llm.tokens import ID, encoder, vocabulary

#: Fixed values of the seekable format, and the magic of our document index.
SEEK_MAGIC = 0x8F92EAB1
SEEK_TABLE_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
CHECKSUM_FLAG = 0x80
_ENTRY = np.dtype([("compressed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
_INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1")])

END_ID = 2
#: A shard is closed when its frames reach this size.
SHARD_BYTES = 256 << 20
#: Texts encoded at once.
TEXTS = 64

MANIFEST = "path string, n_docs long, n_tokens long, first_id long, first_row long"


def _checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard; ``close`` appends index and seek table and renames the file into place."""

    def __init__(self, folder: str, width: int = 2):
        self.filesystem, path = _opened(folder)
        self.filesystem.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}.tok.zst"
        self.path, self.uri = f"{path}/{self.name}", f"{folder}/{self.name}"
        self.file = self.filesystem.open_output_stream(self.path + ".part")
        self.compressor = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.width, self.entries, self.ids, self.written = width, [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        data = ids.astype(f"<u{self.width}").tobytes()
        frame = self.compressor.compress(data)
        self.file.write(frame)
        self.entries.append((len(frame), len(data), _checksum(data)))
        self.ids.append((doc_id or 0, doc_id is None))
        self.written += len(frame)

    def close(self) -> str:
        index = struct.pack("<B", self.width) + np.array(self.ids, _INDEX).tobytes()
        self.file.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        table = np.array(self.entries, _ENTRY).tobytes()
        table += struct.pack("<IBI", len(self.entries), CHECKSUM_FLAG, SEEK_MAGIC)
        self.file.write(struct.pack("<II", SEEK_TABLE_FRAME, len(table)) + table)
        self.file.close()
        self.filesystem.move(self.path + ".part", self.path)
        return self.uri


@dataclass
class Shard:
    """An open shard: ``doc_ids`` and random access to each document's ids."""

    uri: str

    def __post_init__(self):
        filesystem, path = _opened(self.uri)
        self.file = filesystem.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"{self.uri} has no seek table with checksums")
        table = size - 9 - n * _ENTRY.itemsize
        self.entries = np.frombuffer(self._at(table, n * _ENTRY.itemsize), _ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["compressed"], dtype=np.int64)])
        magic, length = struct.unpack("<II", self._at(int(self.starts[-1]), 8))
        if magic != INDEX_FRAME:
            raise ValueError(f"{self.uri} has no document index")
        index = self._at(int(self.starts[-1]) + 8, length)
        self.width = index[0]
        found = np.frombuffer(index, _INDEX, offset=1)
        self.doc_ids = [None if null else int(i) for i, null in found]
        self.decompressor = zstandard.ZstdDecompressor()

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(start)
        return self.file.read(size)

    def __len__(self) -> int:
        return len(self.entries)

    def read(self, i: int) -> np.ndarray:
        """The ids of document ``i``; only its frame is read and decompressed."""
        frame = self._at(int(self.starts[i]), int(self.entries["compressed"][i]))
        data = self.decompressor.decompress(frame, max_output_size=int(self.entries["size"][i]))
        if _checksum(data) != self.entries["checksum"][i]:
            raise ValueError(f"frame {i} of {self.uri} does not match its checksum")
        return np.frombuffer(data, f"<u{self.width}").astype(ID)


def write_shards(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int = END_ID) -> DataFrame:
    """Shards of every document in ascending (doc_id, row) order; returns the written manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path)
        width = 2 if max(encode.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], ID)
        shard, n_tokens, first = None, 0, None

        def closed():
            row = (shard.close(), len(shard.ids), n_tokens, *first)
            return pa.RecordBatch.from_pylist(
                [dict(zip(("path", "n_docs", "n_tokens", "first_id", "first_row"), row))],
                pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("n_docs", "n_tokens", "first_id", "first_row")]]),
            )

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                rows, ids = part.column(0).to_pylist(), part.column(1).to_pylist()
                for row, doc_id, found in zip(rows, ids, encode.encoded(part.column(2).to_pylist())):
                    if shard is None:
                        shard, n_tokens, first = ShardWriter(folder, width), 0, (doc_id, row)
                    tokens = np.concatenate([np.frombuffer(found, ID), end])
                    shard.add(doc_id, tokens)
                    n_tokens += len(tokens)
                    if shard.written >= SHARD_BYTES:
                        yield closed()
                        shard = None
        if shard is not None:
            yield closed()

    ship(docs.sparkSession)
    ordered = (
        docs.select(ROW, "doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(F.col("doc_id"), F.col(ROW))
        .sortWithinPartitions("doc_id", ROW)
    )
    manifest = written(ordered.mapInArrow(write, MANIFEST), "manifest")
    remove_lost(manifest, folder)
    return manifest


def remove_lost(manifest: DataFrame, folder: str) -> int:
    """Removes the files of ``folder`` that the manifest does not name (attempts that were lost); returns their number."""
    filesystem, path = _opened(folder)
    kept = {r["path"].rsplit("/", 1)[1] for r in manifest.select("path").toLocalIterator()}
    lost = [f for f in filesystem.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.base_name not in kept]
    for f in lost:
        filesystem.delete_file(f.path)
    return len(lost)


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the shards."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["path"])
                sizes, sums = [], []
                for i in range(len(shard)):
                    ids = shard.read(i)
                    sizes.append(len(ids))
                    sums.append(zlib.crc32(ids.tobytes()))
                starts = row["before"] + np.concatenate([[0], np.cumsum(sizes)])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    ship(manifest.sparkSession)
    before = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_row").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))  # a row a shard
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, docs: DataFrame, vocabulary_name: str = "byte_bpe_50k.json") -> DataFrame:
    folder = shared_dir(spark) + "/shards"
    return read_shards(write_shards(keyed(docs), folder, vocabulary(vocabulary_name)))
