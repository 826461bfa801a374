"""Packing token sequences by the sum-of-squares rule.

Documents are cut into pieces of at most a sequence's length (only longer ones are cut) and the
pieces placed into sequences. Each piece goes where the sum, over the possible gaps, of the
squared number of open sequences with that gap becomes smallest; ties take the smallest gap. Since
a group's pieces are all known, they are placed from long to short, and no sequence is opened while
the open ones have room for all that is left and one of them takes the piece.

Scale: token ids never leave the task that makes them; a piece is one row of a few numbers. Pieces
are dealt by hash into groups of some ``GROUP`` rows, each packed by one task; a group leaves at
most a few sequences part empty, about one in 3,000.

Defined results: NULL text is empty and holds only the end id. Repeated rows are packed
separately. A piece of a full sequence's length is a sequence of its own. An empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored
from tillflow.llm.encoding import encoder

LENGTH = 2048
GROUP = 8192
END_ID = 0
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32, row``; stored.

    A document is its ids, then the end id.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all = encoder(tokenizer, 2).encode_all
        for batch in batches:
            rows = []
            for doc_id, found in zip(batch.column(0).to_pylist(), encode_all(batch.column(1))):
                ids = np.append(found.astype("<u4"), np.uint32(END_ID))
                for piece, start in enumerate(range(0, len(ids), length)):
                    part = ids[start : start + length]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            columns = list(zip(*rows)) or [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names
            )

    made = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(cut, PIECES)
    return stored(made.withColumn("row", F.monotonically_increasing_id()), "pieces")


def place(lengths: np.ndarray, room: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, by the sum-of-squares rule.

    ``lengths`` must not increase; all are at least 1 and less than ``room``.
    """
    open_with = np.zeros(room + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(room + 1)]
    fills: list[int] = []
    where, offsets = [], []
    left, gaps, impossible = int(lengths.sum()), 0, 1 << 60
    for size in lengths.tolist():
        # Moving a sequence from gap g to g - size changes the sum of squares by this much.
        now, then = open_with[size:room], open_with[: room - size]
        change = np.where(now > 0, 2 * (then - now) + 2, impossible)
        if now[0] > 0:
            change[0] = 1 - 2 * now[0]
        best = int(change.argmin())
        fits = change[best] < impossible
        if fits and (left <= gaps or change[best] <= 2 * open_with[room - size] + 1):
            gap = size + best
            sequence = by_gap[gap].pop()
            open_with[gap] -= 1
        else:
            gap, sequence = room, len(fills)
            fills.append(0)
            gaps += room
        where.append(sequence)
        offsets.append(fills[sequence])
        fills[sequence] += size
        left, gaps = left - size, gaps - size
        if gap > size:
            open_with[gap - size] += 1
            by_gap[gap - size].append(sequence)
    return np.array(where, np.int64), np.array(offsets, np.int64)


def packed(parts: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    short = parts.where(F.col("length") < length)
    groups = max(1, -(-short.count() // group))
    dealt = F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups)).alias("group")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True])
        sequence, offset = place(frame["length"].to_numpy(), length)
        # Odd numbers, apart for each group; full pieces have even ones.
        number = 2 * ((frame["group"].to_numpy().astype(np.int64) << 32) + sequence) + 1
        return frame[names].assign(sequence_id=number, offset=offset)

    filled = (
        short.select(*names, "row", dealt)
        .groupBy("group")
        .applyInPandas(pack, f"{PIECES}, sequence_id bigint, offset bigint")
    )
    full = parts.where(F.col("length") >= length).select(
        *names, (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return filled.unionByName(full)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row per piece of every document, with its sequence and its place there."""
    return packed(pieces(docs, tokenizer, length), length)
