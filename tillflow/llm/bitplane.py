"""Token ids in files of compressed bit planes, with a chunk index.

A file holds the documents of one range of ids in order. Its ids are cut into blocks of a fixed
number; a block is transposed, so that plane ``k`` holds bit ``k`` of every id (or byte ``k``), and
each plane is compressed on its own. Only the planes up to the block's largest id are written.

    magic | block 0: plane, plane, ... | block 1 ... | index | length of the index | magic

The index (compressed JSON) names the kind of plane, the ids per block, and for each block its
place, number of ids and plane lengths; and for each document its id and its first id's number.
A reader can fetch one block, or one plane of it, by its place.

Scale: documents are sorted by range partitions, and each task streams its range through one block
at a time into files of its own of bounded size, named by attempt; a manifest lists the files that
count, so repeated tasks do no harm. Where a document starts among all follows from one row per file.

Defined results: NULL text is empty and holds only the end id. NULL ids come first. Rows with
the same id are ordered by the hash of their text. An empty table gives no file and an empty result.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow.llm.common import filesystem, new_folder, stored
from tillflow.llm.encoding import encoder

MAGIC = b"TFPLANE1"
BLOCK = 1 << 16
END_ID = 0
#: A file ends with the document that reaches one of these, so an index and its rows stay small.
FILE_IDS, FILE_DOCS = 1 << 27, 1 << 19
MANIFEST = "path string, n_docs bigint, n_ids bigint, n_bytes bigint, first_id bigint, first_hash bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The used planes of a block, from the lowest bit or byte up."""
    used = int(ids.max(initial=0)).bit_length()
    lanes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    lanes = lanes[: -(-used // 8)]
    if kind == "byte":
        return [lane.tobytes() for lane in lanes]
    planes = []
    for lane in lanes:
        bits = np.unpackbits(lane, bitorder="little").reshape(-1, 8).T
        planes += [row.tobytes() for row in np.packbits(bits, axis=1, bitorder="little")]
    return planes[:used]


def from_planes(planes: list[bytes], count: int, kind: str) -> np.ndarray:
    ids = np.zeros(count, np.uint32)
    for place, plane in enumerate(planes):
        values = np.frombuffer(plane, np.uint8)
        if kind == "bit":
            values = np.unpackbits(values, count=count, bitorder="little")
        ids |= values.astype(np.uint32) << np.uint32(place * (1 if kind == "bit" else 8))
    return ids


class PlaneWriter:
    """Streams documents into one file."""

    def __init__(self, out, kind: str = "bit", block: int = BLOCK, level: int = 3):
        self.out, self.kind, self.block = out, kind, block
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.waiting: list[np.ndarray] = []
        self.held = self.n_ids = 0
        self.blocks: list[list] = []
        self.docs: list[int | None] = []
        self.starts: list[int] = []
        self.place = len(MAGIC)
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.n_ids)
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block:
            self._flush(self.held - self.held % self.block)

    def _flush(self, upto: int) -> None:
        ids = np.concatenate(self.waiting)
        for start in range(0, upto, self.block):
            part = ids[start : min(start + self.block, upto)]
            planes = [self.compress(p) for p in to_planes(part, self.kind)]
            for plane in planes:
                self.out.write(plane)
            self.blocks.append([self.place, len(part), [len(p) for p in planes]])
            self.place += sum(map(len, planes))
        self.waiting, self.held = [ids[upto:]], len(ids) - upto

    def close(self) -> int:
        """Write the rest and the index; the file's length."""
        if self.held:
            self._flush(self.held)
        index = {"kind": self.kind, "block": self.block, "n_ids": self.n_ids}
        index |= {"blocks": self.blocks, "docs": self.docs, "starts": self.starts}
        tail = self.compress(json.dumps(index).encode())
        self.out.write(tail + len(tail).to_bytes(8, "little") + MAGIC)
        return self.place + len(tail) + 8 + len(MAGIC)


class PlaneReader:
    """Random access to a file; ``source`` needs ``read_at(length, offset)`` and ``size()``."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        last = source.read_at(8 + len(MAGIC), end - 8 - len(MAGIC))
        if last[8:] != MAGIC:
            raise ValueError("not a complete plane file")
        length = int.from_bytes(last[:8], "little")
        self.expand = zstandard.ZstdDecompressor().decompress
        tail = source.read_at(length, end - 8 - len(MAGIC) - length)
        self.index = json.loads(self.expand(tail))

    def block(self, number: int) -> np.ndarray:
        place, count, lengths = self.index["blocks"][number]
        data, planes, at = self.source.read_at(sum(lengths), place), [], 0
        for length in lengths:
            planes.append(self.expand(data[at : at + length]))
            at += length
        return from_planes(planes, count, self.index["kind"])

    def ids(self, start: int, end: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` to ``end`` in parts, reading only their blocks."""
        size = self.index["block"]
        for number in range(start // size, -(-end // size)):
            first = number * size
            yield self.block(number)[max(start - first, 0) : end - first]

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """``doc_id, start, number of ids, crc32`` of each document, one block in memory."""
        starts, total = self.index["starts"], self.index["n_ids"]
        held, number = np.zeros(0, np.uint32), -1
        for doc_id, start, end in zip(self.index["docs"], starts, [*starts[1:], total]):
            crc, at = 0, start
            while at < end:
                if at // self.index["block"] != number:
                    number = at // self.index["block"]
                    held = self.block(number)
                first = number * self.index["block"]
                part = held[at - first : end - first]
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                at += len(part)
            yield doc_id, start, end - start, crc


def write_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str,
    kind: str = "bit",
    block: int = BLOCK,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode ``doc_id, text`` into plane files in ``folder``; the manifest, one row per file, stored.

    A task goes on in a new file after the document with which a file reaches ``file_ids`` ids.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer, 2).encode_all
        writer, number = None, 0

        def closed() -> pa.RecordBatch:
            size = writer.close()
            out.close()
            row = [f"{folder}/{name}", len(writer.docs), writer.n_ids, size, *first]
            names = ["path", "n_docs", "n_ids", "n_bytes", "first_id", "first_hash"]
            types = [pa.string(), *[pa.int64()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, mark, tokens in zip(ids, marks, encode_all(batch.column(2))):
                if writer is None:
                    fs, root = filesystem(folder)
                    fs.create_dir(root, recursive=True)
                    part = TaskContext.get().partitionId()
                    name = f"part-{part:06d}-{number:06d}-{uuid.uuid4().hex[:12]}.planes"
                    out = fs.open_output_stream(f"{root}/{name}")
                    writer, first = PlaneWriter(out, kind, block), (doc_id, mark)
                writer.add(doc_id, np.append(tokens.astype(np.uint32), np.uint32(END_ID)))
                if writer.n_ids >= file_ids or len(writer.docs) >= FILE_DOCS:
                    yield closed()
                    writer, number = None, number + 1
        if writer is not None:
            yield closed()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("mark"), "text")
    placed = rows.repartitionByRange("doc_id", "mark").sortWithinPartitions("doc_id", "mark")
    return stored(placed.mapInArrow(write, MANIFEST), "manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, place = filesystem(path)
                with fs.open_input_file(place) as source:
                    columns = list(zip(*PlaneReader(source).documents()))
                arrays = [pa.array(c, pa.int64()) for c in columns]
                arrays[1] = pa.array(np.array(columns[1], np.int64) + start)
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    order = Window.orderBy("first_id", "first_hash", "path")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    count = max(1, manifest.count())
    return starts.repartition(count, "path").mapInArrow(read, DOCUMENTS)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write every document to plane files in the shared folder and read them back."""
    folder = new_folder(spark, "planes")
    return read_files(write_files(docs, tokenizer, folder))
