"""Token ids in files of independent zstandard frames with a trailing seek table and a checksum per frame.

A file holds one frame per document, in ascending order of doc_id, then a skippable frame with the documents' ids and token
counts, then the seek table of the public seekable format of zstandard: a skippable frame with compressed size,
decompressed size and the low 32 bits of XXH64 of every frame, and a footer. A zstandard decoder that knows nothing of
this reads the same bytes; a reader that wants some documents reads the tail of the file and their frames.

Every task writes a file of its own to the shared folder and reports it in a manifest, which is written once all tasks
have ended; files of attempts that were lost are in no manifest.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import numpy as np
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from loadwitness.llm.common import in_slices, stored
from loadwitness.llm.token_ids import worker_encoder
from loadwitness.scratch import file_store, fresh_path

# Fixed values of the format: magic numbers of a skippable frame (16 are free to use), of the seek table's frame and its
# footer; the descriptor bit that says that the table has checksums.
SKIPPABLE, SEEK_FRAME, SEEK_FOOTER, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

NULL_ID = np.iinfo(np.int64).min
LEVEL = 1
# Bytes that are read at a time.
BLOCK = 1 << 20


def write_frames(out: BinaryIO, documents: Iterable[tuple[int, bytes]]) -> tuple[int, int, int]:
    """Write (doc id, ids) in the order given; returns frames, tokens and bytes. Empty ids give a frame of no bytes."""
    press = zstandard.ZstdCompressor(level=LEVEL)
    ids, counts, table, size = [], [], [], 0
    for doc_id, raw in documents:
        frame = press.compress(raw)
        out.write(frame)
        size += len(frame)
        table.append(struct.pack("<III", len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        ids.append(doc_id)
        counts.append(len(raw) // 4)
    index = np.array(ids, "<i8").tobytes() + np.array(counts, "<i8").tobytes()
    tail = struct.pack("<II", SKIPPABLE, len(index)) + index
    seek = b"".join(table) + struct.pack("<IBI", len(table), HAS_CHECKSUMS, SEEK_FOOTER)
    tail += struct.pack("<II", SEEK_FRAME, len(seek)) + seek
    out.write(tail)
    return len(ids), sum(counts), size + len(tail)


class FrameReader:
    """Random access to the documents of one file."""

    def __init__(self, source: BinaryIO, size: int):
        self.source = source
        source.seek(size - 9)
        n, descriptor, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEK_FOOTER or not descriptor & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        seek_at = size - 9 - 12 * n - 8
        index_at = seek_at - 16 * n - 8
        source.seek(index_at)
        tail = source.read(size - index_at)
        if struct.unpack_from("<II", tail) != (SKIPPABLE, 16 * n):
            raise ValueError("no index before the seek table")
        self.ids = np.frombuffer(tail, "<i8", n, 8)
        self.counts = np.frombuffer(tail, "<i8", n, 8 + 8 * n)
        table = np.frombuffer(tail, "<u4", 3 * n, 8 + 16 * n + 8).reshape(n, 3)
        self.sizes, self.raw_sizes, self.checksums = (table[:, i].astype(np.int64) for i in range(3))
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.press = zstandard.ZstdDecompressor()

    def read(self, frame: int) -> bytes:
        """Ids of the document in this frame; only its bytes are read and decompressed."""
        self.source.seek(int(self.offsets[frame]))
        data = self.source.read(int(self.sizes[frame]))
        raw = self.press.decompress(data, max_output_size=int(self.raw_sizes[frame])) if self.raw_sizes[frame] else b""
        if len(raw) != self.raw_sizes[frame] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checksums[frame]:
            raise ValueError(f"frame {frame} does not match its checksum")
        return raw


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode ``docs`` and write them to ``folder`` in ascending order of their ids; returns the manifest.

    The manifest has a row per file: ``path``, ``part`` (files ascend by it), ``documents``, ``tokens``, ``bytes``,
    ``first_id``, ``last_id`` and ``first`` (tokens in all files before). A null text is empty, which is the end id alone; a null doc_id comes
    first and is kept as the smallest long; rows that repeat an id follow one another in the order of their texts' hashes.
    An empty table gives an empty manifest. Ids must be integers; other columns are not read.
    """

    def run(batches):
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        encoder, end = worker_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        files, base = file_store(folder)
        files.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()

        last_id = NULL_ID

        def documents() -> Iterator[tuple[int, bytes]]:
            nonlocal last_id
            for ids, texts in in_slices(batches):
                for doc_id, text in zip(ids.to_pylist(), texts, strict=True):
                    last_id = NULL_ID if doc_id is None else doc_id
                    yield last_id, encoder.encode(text) + end

        rows = documents()
        first = next(rows, None)
        if first is None:
            return
        name = f"part-{part:06d}-{uuid.uuid4().hex}.zst"
        with files.open_output_stream(os.path.join(base, name), compression=None) as out:
            from itertools import chain

            n, tokens, size = write_frames(out, chain([first], rows))
        made = {"path": [f"{folder}/{name}"], "part": [part], "documents": [n], "tokens": [tokens], "bytes": [size]}
        made |= {"first_id": [first[0]], "last_id": [last_id]}
        yield pa.RecordBatch.from_pydict(made)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "path string, part bigint, documents bigint, tokens bigint, bytes bigint, first_id bigint, last_id bigint"
    written = stored(ordered.mapInArrow(run, schema), "token-file-parts")
    # One narrow row per file, not per document.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("bigint")))


def read_token_files(manifest: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents of the files, decompressed frame by frame: ``doc_id``, ``start`` (tokens of all documents before it),
    ``ids`` (binary). ``doc_ids``: only these documents are decompressed, and only files opened whose range holds one."""
    return _read(manifest, doc_ids, "doc_id bigint, start bigint, ids binary", lambda raw: {"ids": raw})


def file_digest(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document, read back from the files."""
    return _read(
        manifest,
        None,
        "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
        lambda raw: {"n_tokens": len(raw) // 4, "ids_crc32": zlib.crc32(raw)},
    )


def _read(manifest: DataFrame, doc_ids: list[int] | None, schema: str, columns) -> DataFrame:
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)
    kinds = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for file in batch.to_pylist():
                if wanted is not None:
                    within = wanted[(wanted >= file["first_id"]) & (wanted <= file["last_id"])]
                    if not len(within):
                        continue
                files, path = file_store(file["path"])
                # Frames follow one another: blocks are read ahead, not a piece per document.
                with files.open_input_file(path) as opened, io.BufferedReader(opened, BLOCK) as source:
                    reader = FrameReader(source, opened.size())
                    starts = file["first"] + np.cumsum(reader.counts) - reader.counts
                    asked = range(len(reader.ids)) if wanted is None else np.flatnonzero(np.isin(reader.ids, wanted))
                    rows, held = [], 0
                    for i in asked:
                        raw = reader.read(i)
                        doc_id = None if reader.ids[i] == NULL_ID else int(reader.ids[i])
                        rows.append({"doc_id": doc_id, "start": int(starts[i])} | columns(raw))
                        held += len(raw) + 64
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    # A file is a task's work. The number of tasks is stated, else the few rows of the manifest would be put together.
    files = manifest.select("path", "first", "part", "first_id", "last_id")
    return files.repartitionByRange(max(1, manifest.count()), "part").mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Digest of every document after it was written to fresh files in the shared folder and read back."""
    folder = fresh_path(docs.sparkSession, "token-files")
    return file_digest(stored(write_token_files(docs, tokenizer, folder, end_id), "token-manifest"))
