"""Centroid clustering over a VA-file: few-bit cells decide, whole vectors are fetched only in doubt.

Vectors of whole numbers are stored in blocks. A block has three files of fixed-width rows: the whole
vectors, their ids, and their *cells*: per dimension the number of the interval that holds the entry,
in ``bits`` bits. The intervals of a dimension are narrow where entries are frequent (their density
follows the square root of a normal curve of the dimension's mean and spread, which makes the mean
width smallest); the outermost reach to the smallest and largest entry, so that cells always bound.

In every round each centroid gets a lookup table per dimension: the smallest and largest value, over a
cell, of the squared distance to it less that to a common reference point (the centroids' mean).
What is subtracted is the same for all centroids of a vector, so it doesn't change which is nearest,
but it makes the intervals much narrower. Sums over the dimensions bound each centroid's distance from
below and above. A vector whose lowest upper bound meets no other centroid's lower bound is assigned by
its cells alone; only for the others is the whole vector read, by its place in the file, and measured
exactly. Vectors that change their centroid are read too, to move them from one sum to the other; sums
of the others are kept from the round before. All numbers are whole, so sums and centroids are exact
and do not depend on order. Rounds end early once no vector moves, which changes nothing.

Scale: a round is one job over blocks of ``BLOCK`` rows, without a shuffle of vectors; per task it adds up
centroids x dimensions sums. The driver holds the centroids and their sums. Files are named by attempt
and listed in a stored manifest, so repeated tasks do no harm.

Defined results: vectors that are NULL, of another length or with NULL or non-finite components are
dropped. Ties go to the smaller centroid. Repeated rows count as often as they occur. Rows without an id
can't start a centroid but are clustered (if no row has an id the result is empty); start rows with equal ids are ordered by their vectors. With
fewer vectors than centroids each starts one; an empty table gives an empty result. Numbers so large that
a distance might leave the 64-bit range are refused with an error. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import filesystem, new_folder, stored
from tillflow.llm.vectors import usable, whole_rows

SCALE = 1024
CENTROIDS, ROUNDS, SIZE, SEED = 8, 10, 64, 3
#: Bits of a cell per dimension.
BITS = 6
#: Vectors in a block, and blocks that one task of a round handles (fewer while cores are idle).
BLOCK, BLOCKS_A_TASK = 1 << 14, 16
#: Doubtful vectors this close in a file are read in one go.
GAP = 32

FILES = "block string, n bigint"
SPREAD = "dim int, n bigint, total double, squares double, low bigint, high bigint"
ROUND = "block string, n bigint, labels string, sums array<bigint>"
ASSIGNED = "id bigint, cluster int, distance bigint"


def largest_entry(size: int) -> int:
    """Entries up to this keep every squared distance below 2**62."""
    return min(math.isqrt((1 << 60) // max(size, 1)), (1 << 31) - 1)


def write_bytes(path: str, data: np.ndarray) -> None:
    fs, place = filesystem(path)
    with fs.open_output_stream(place) as out:
        out.write(np.ascontiguousarray(data).tobytes())


def read_rows(path: str, kind: str, width: int) -> np.ndarray:
    """All rows of a fixed-width file."""
    fs, place = filesystem(path)
    with fs.open_input_file(place) as source:
        return np.frombuffer(source.read(), kind).reshape(-1, width)


def read_some(path: str, kind: str, width: int, wanted: np.ndarray) -> np.ndarray:
    """The rows with the numbers ``wanted`` (rising) of a fixed-width file, read by their places."""
    bytes_a_row = np.dtype(kind).itemsize * width
    out = np.empty((len(wanted), width), kind)
    if not len(wanted):
        return out
    fs, place = filesystem(path)
    breaks = np.flatnonzero(np.diff(wanted) > GAP) + 1
    with fs.open_input_file(place) as source:
        for run in np.split(np.arange(len(wanted)), breaks):
            first, last = int(wanted[run[0]]), int(wanted[run[-1]])
            data = source.read_at((last - first + 1) * bytes_a_row, first * bytes_a_row)
            out[run] = np.frombuffer(data, kind).reshape(-1, width)[wanted[run] - first]
    return out


def pack_cells(cells: np.ndarray, bits: int) -> np.ndarray:
    """Cell numbers below ``2**bits`` as rows of packed bits."""
    planes = np.unpackbits(cells[:, :, None], axis=2, bitorder="little")[:, :, :bits]
    return np.packbits(planes.reshape(len(cells), -1), axis=1, bitorder="little")


def unpack_cells(packed: np.ndarray, size: int, bits: int) -> np.ndarray:
    planes = np.unpackbits(packed, axis=1, count=size * bits, bitorder="little").reshape(-1, size, bits)
    return np.packbits(planes, axis=2, bitorder="little")[:, :, 0]


def cell_width(size: int, bits: int) -> int:
    return -(-size * bits // 8)


@dataclass
class Cells:
    """Per dimension the first whole number of every cell but the first, and the ends of the data."""

    starts: list[np.ndarray]
    low: np.ndarray
    high: np.ndarray
    bits: int

    def number(self, rows: np.ndarray) -> np.ndarray:
        out = np.empty(rows.shape, np.uint8)
        for dim, starts in enumerate(self.starts):
            out[:, dim] = np.searchsorted(starts, rows[:, dim], "right")
        return out

    def ends(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """The smallest and the largest whole number of each cell."""
        starts = self.starts[dim]
        return np.append(self.low[dim], starts), np.append(starts - 1, self.high[dim])


def cells_of(spread: list, bits: int) -> Cells:
    """Cells from ``dim, n, total, squares, low, high`` rows, sorted by dimension."""
    starts, count = [], 1 << bits
    for row in spread:
        mean = row["total"] / row["n"]
        deviation = math.sqrt(max(row["squares"] / row["n"] - mean * mean, 0.0))
        if deviation > 0:
            curve = NormalDist(mean, deviation * math.sqrt(2))
            cuts = np.array([math.ceil(curve.inv_cdf(k / count)) for k in range(1, count)], np.int64)
            cuts = np.unique(cuts[(cuts > row["low"]) & (cuts <= row["high"])])
        else:
            cuts = np.zeros(0, np.int64)
        starts.append(cuts)
    ends = [np.array([r[k] for r in spread], np.int64) for k in ("low", "high")]
    return Cells(starts, *ends, bits)


def tables(cells: Cells, centroids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per dimension the bounds (cell x centroid) of the squared distance less that to the reference.

    (x - m)**2 - (x - r)**2 is linear in x, so its extremes over a cell are at the cell's ends.
    """
    reference = np.rint(centroids.mean(0)).astype(np.int64)
    out = []
    for dim, place in enumerate(reference):
        low, high = (e[:, None] for e in cells.ends(dim))
        middle = centroids[:, dim][None, :]
        at_low = (low - middle) ** 2 - (low - place) ** 2
        at_high = (high - middle) ** 2 - (high - place) ** 2
        out.append((np.minimum(at_low, at_high), np.maximum(at_low, at_high)))
    return out


def bounds(numbers: np.ndarray, looked_up: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds (row x centroid) of rows given by their cells."""
    low, high = 0, 0
    for dim, (least, most) in enumerate(looked_up):
        low = low + least[numbers[:, dim]]
        high = high + most[numbers[:, dim]]
    return low, high


def distances(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, row x centroid."""
    out = np.empty((len(rows), len(centroids)), np.int64)
    for number, centroid in enumerate(centroids):
        gaps = rows.astype(np.int64) - centroid
        out[:, number] = np.einsum("ij,ij->i", gaps, gaps)
    return out


def nearest(
    path: str, numbers: np.ndarray, cells: Cells, centroids: np.ndarray, step: int = 0
) -> tuple[np.ndarray, int]:
    """The nearest centroid of every row of a block, and how many rows had to be fetched."""
    looked_up, fetched = tables(cells, centroids), 0
    labels = np.empty(len(numbers), "<i4")
    step = step or max(256, (1 << 18) // len(centroids))
    for start in range(0, len(numbers), step):
        part = numbers[start : start + step]
        low, high = bounds(part, looked_up)
        found = high.argmin(1)
        rivals = (low <= high[np.arange(len(part)), found][:, None]).sum(1)
        doubtful = np.flatnonzero(rivals > 1)
        rows = read_some(f"{path}.rows", "<i4", part.shape[1], doubtful + start)
        found[doubtful] = distances(rows, centroids).argmin(1)
        labels[start : start + step] = found
        fetched += len(doubtful)
    return labels, fetched


def gathered(rows: np.ndarray, labels: np.ndarray, count: int) -> np.ndarray:
    """Per centroid the number of rows and their sums, in one matrix."""
    out = np.zeros((count, rows.shape[1] + 1), np.int64)
    np.add.at(out[:, 0], labels, 1)
    for number in np.unique(labels):
        out[number, 1:] = rows[labels == number].sum(0, dtype=np.int64)
    return out


def write_blocks(kept: DataFrame, size: int, folder: str) -> DataFrame:
    """Blocks of whole vectors and ids in ``folder``; a stored row per block."""
    largest = largest_entry(size)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        held, waiting = 0, []

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}"
            write_bytes(f"{path}.rows", np.concatenate([w[0] for w in waiting]).astype("<i4"))
            write_bytes(f"{path}.ids", np.concatenate([w[1] for w in waiting]).astype("<i8"))
            write_bytes(f"{path}.known", np.concatenate([w[2] for w in waiting]).astype("u1"))
            return pa.RecordBatch.from_pydict({"block": [path], "n": pa.array([held], pa.int64())})

        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                ids = part.column(0)
                known = np.asarray(ids.is_valid())
                waiting.append(
                    (whole_rows(part.column(1), size, SCALE, largest=largest), np.asarray(ids.fill_null(0)), known)
                )
                held += part.num_rows
                if held >= BLOCK:
                    yield flush()
                    held, waiting = 0, []
        if held:
            yield flush()

    return stored(kept.select("id", "vector").mapInArrow(write, FILES), "va-blocks")


def spread_of(blocks: DataFrame, count: int, size: int) -> list:
    """Count, sums and ends of every dimension over all blocks."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = read_rows(f"{path}.rows", "<i4", size)
                exact = rows.astype(np.float64)
                yield pa.RecordBatch.from_pydict(
                    {
                        "dim": pa.array(np.arange(size, dtype=np.int32)),
                        "n": pa.array(np.full(size, len(rows), np.int64)),
                        "total": pa.array(exact.sum(0)),
                        "squares": pa.array((exact * exact).sum(0)),
                        "low": pa.array(rows.min(0).astype(np.int64)),
                        "high": pa.array(rows.max(0).astype(np.int64)),
                    }
                )

    parts = dealt(blocks.select("block"), count).mapInArrow(look, SPREAD).groupBy("dim")
    found = parts.agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("squares").alias("squares"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    return sorted(found.collect())


def dealt(blocks: DataFrame, count: int) -> DataFrame:
    """The ``count`` blocks in as many tasks as there are cores, or more, with ``BLOCKS_A_TASK`` blocks each."""
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(max(1, min(count, cores), -(-count // BLOCKS_A_TASK)))


def write_cells(blocks: DataFrame, count: int, size: int, cells: Cells) -> None:
    """The file of cells beside each block's vectors; a repeated task writes the same bytes again."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                numbers = cells.number(read_rows(f"{path}.rows", "<i4", size))
                write_bytes(f"{path}.cells", pack_cells(numbers, cells.bits))
            yield batch.select([0])

    done = dealt(blocks.select("block"), count).mapInArrow(write, "block string")
    done.write.format("noop").mode("overwrite").save()


def assign(blocks: DataFrame, count: int, size: int, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """One round over all blocks: the stored manifest with new labels and what changed in the sums.

    ``blocks`` has ``block, n`` and, from the second round on, ``labels`` (the labels' file). ``sums`` are
    rows, fetched and moved rows, then per centroid the change of its count and sums.
    """
    bits = cells.bits

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for entry in batch.to_pylist():
                path, before = entry["block"], entry.get("labels")
                numbers = unpack_cells(read_rows(f"{path}.cells", "u1", cell_width(size, bits)), size, bits)
                labels, fetched = nearest(path, numbers, cells, centroids)
                if before is None:
                    moved = len(labels)
                    change = gathered(read_rows(f"{path}.rows", "<i4", size), labels, len(centroids))
                else:
                    old = read_rows(before, "<i4", 1)[:, 0]
                    places = np.flatnonzero(old != labels)
                    rows, moved = read_some(f"{path}.rows", "<i4", size, places), len(places)
                    change = gathered(rows, labels[places], len(centroids)) - gathered(rows, old[places], len(centroids))
                name = f"{path}-{uuid.uuid4().hex[:12]}.labels"
                write_bytes(name, labels)
                row = {"block": path, "n": entry["n"], "labels": name}
                row["sums"] = [len(labels), fetched, moved, *change.reshape(-1).tolist()]
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema(
        [("block", pa.string()), ("n", pa.int64()), ("labels", pa.string()), ("sums", pa.list_(pa.int64()))]
    )
    return stored(dealt(blocks, count).mapInArrow(step, ROUND), "va-round")


def sums_of(manifest: DataFrame, shape: tuple[int, int]) -> tuple[dict, np.ndarray]:
    """The round's counts, and the change of all centroids' counts and sums, over all blocks."""
    spread = manifest.select(F.posexplode("sums").alias("place", "value"))
    found = spread.groupBy("place").agg(F.sum("value").alias("value")).where("value <> 0").collect()
    out = np.zeros(3 + shape[0] * shape[1], np.int64)
    for row in found:
        out[row["place"]] = row["value"]
    return dict(zip(("n", "fetched", "moved"), out[:3].tolist())), out[3:].reshape(shape)


def first_centroids(kept: DataFrame, size: int, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:id``, in the order of the hashes."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    whole = F.transform("vector", lambda c: F.floor(c * F.lit(float(SCALE))))
    top = kept.where(F.col("id").isNotNull()).select(mark.alias("mark"), whole.alias("whole"))
    rows = top.orderBy("mark", "whole").limit(count).collect()
    return np.array([r["whole"] for r in rows], np.int64).reshape(-1, size)


@dataclass
class Clustering:
    """Centroids, the manifest of the last assignment, and per round what was fetched and moved."""

    centroids: np.ndarray
    manifest: DataFrame
    log: list[dict]
    blocks: int


def fit(kept: DataFrame, size: int, count: int, rounds: int, seed: int, bits: int) -> Clustering | None:
    """Rounds of assignment and exact floor means over ``id, vector`` rows; None without vectors."""
    spark = kept.sparkSession
    blocks = write_blocks(kept, size, new_folder(spark, "va"))
    count_blocks = blocks.count()
    spread = spread_of(blocks, count_blocks, size)
    centroids = first_centroids(kept, size, count, seed) if spread else np.zeros((0, size), np.int64)
    if not len(centroids):
        return None
    cells = cells_of(spread, bits)
    write_cells(blocks, count_blocks, size, cells)
    sums = np.zeros((len(centroids), size + 1), np.int64)
    manifest, log = blocks, []
    for number in range(rounds + 1):
        entries = manifest.select("block", "n", *(["labels"] if number else []))
        manifest = assign(entries, count_blocks, size, cells, centroids)
        seen, change = sums_of(manifest, sums.shape)
        log.append(seen)
        if number == rounds or not seen["moved"]:
            break
        sums += change
        full = sums[:, 0] > 0
        centroids = centroids.copy()
        centroids[full] = sums[full, 1:] // sums[full, :1]
    return Clustering(centroids, manifest, log, count_blocks)


def assigned(clustering: Clustering, size: int) -> DataFrame:
    """``id, cluster, distance`` of every vector, from the blocks' files."""
    centroids = clustering.centroids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, labels_file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                labels = read_rows(labels_file, "<i4", 1)[:, 0]
                gaps = read_rows(f"{path}.rows", "<i4", size).astype(np.int64) - centroids[labels]
                known = read_rows(f"{path}.known", "u1", 1)[:, 0].astype(bool)
                ids = pa.array(read_rows(f"{path}.ids", "<i8", 1)[:, 0], mask=~known)
                far = np.einsum("ij,ij->i", gaps, gaps)
                arrays = [ids, pa.array(labels.astype(np.int32)), pa.array(far)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "cluster", "distance"])

    return dealt(clustering.manifest.select("block", "labels"), clustering.blocks).mapInArrow(read, ASSIGNED)


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    size: int = SIZE,
    seed: int = SEED,
    bits: int = BITS,
) -> tuple[DataFrame, Clustering | None]:
    """``id, cluster, distance`` of every usable vector (stored), and the clustering behind it."""
    if not 1 <= bits <= 8:
        raise ValueError("a cell has 1 to 8 bits")
    kept, size = usable(vectors, id_column, vector_column, size)
    found = fit(kept, size, centroids, rounds, seed, bits)
    if found is None:
        none = kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
        return none.where(F.lit(False)), None
    return stored(assigned(found, size), "va-assigned"), found


def clustered(vectors: DataFrame) -> DataFrame:
    """One row per vector with its cluster's figures, as the query returns them."""
    rows, found = cluster(vectors)
    digests = {
        number: hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
        for number, centroid in enumerate(found.centroids.tolist() if found else [])
    }
    totals = {r["cluster"]: r["s"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    # A few literals, one per centroid.
    inertias = F.array(*[F.lit(totals.get(k, 0)) for k in digests]).cast("array<bigint>")
    marks = F.array(*[F.lit(d) for d in digests.values()]).cast("array<string>")
    return rows.select(
        F.col("id").alias("vec_id"),
        "cluster",
        "distance",
        F.get(inertias, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("bigint").alias("inertia"),
        F.get(marks, F.col("cluster")).alias("centroid_sha256"),
    )
