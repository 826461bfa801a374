"""Repeated passages by content-defined chunking with a gear rolling hash.

A text's UTF-8 bytes are cut where a rolling hash of the last 32 bytes is small, at least ``LEAST`` and
at most ``MOST`` bytes after the cut before and never inside a character. An insertion moves only the
cuts near it, so equal passages are cut alike wherever they stand. Chunks are compared by their
128-bit BLAKE2 digests; the first occurrence (least id, then place) stays and the others are repeats.

Scale: texts are not shuffled. Digests travel packed by the thousand in buckets of bounded size, where
all that occur once end; digests that are frequent within a batch go around the buckets, spread by
batch, and tell them so by one entry. Only repeated chunks become rows; their first occurrence comes
from a partial aggregation and meets them in a join that Spark splits for frequent digests.

Defined results: NULL and empty texts have no chunks. A NULL id comes before all others. For ``repeats`` and
``passages`` rows with the same id are one document, and what they have at the same place is one chunk;
where texts are cut, every row is a document of its own, in the order of ids and texts. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, stored
from tillflow.llm.exact import flagged

#: A byte begins a chunk with a chance of one in ``MEAN``, within these limits of its length.
MEAN, LEAST, MOST = 24, 16, 256
WINDOW = 32
#: Neighbouring chunks repeated across documents are reported from so many bytes on.
PASSAGE_BYTES = 64
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096
BUCKET = 1 << 20
COMMON = 6
U32, U64 = np.uint32, np.uint64
_GEAR = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 32, 256, np.uint32)


def cuts(data: np.ndarray) -> np.ndarray:
    """The ends of the chunks of one text's bytes."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    rolled, span = _GEAR[data], 1
    while span < WINDOW:  # the hash of the last 2, 4, ... 32 bytes
        rolled[span:] = rolled[span:] + (rolled[:-span] << U32(span))
        span *= 2
    inside = (data & 0xC0) == 0x80  # later bytes of a character
    small = np.flatnonzero(rolled[:-1] < U32((1 << 32) // MEAN)) + 1
    ends, last = [], 0
    for place in [*small[~inside[small]].tolist(), n]:
        while place - last > MOST:
            forced = last + MOST
            while inside[forced]:
                forced -= 1
            last = forced
            ends.append(last)
        if place - last >= LEAST or place == n:
            last = place
            ends.append(last)
    return np.array(ends, np.int64)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    start = size = 0
    for place, text in enumerate(batch.column(1)):
        length = len(text.as_buffer()) if text.is_valid else 0
        if place > start and (size + length > BATCH_BYTES or place - start >= BATCH_ROWS):
            yield batch.slice(start, place - start)
            start, size = place, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)


PACKED = "bucket int, digests binary, owners binary, starts binary, lengths binary, rows binary"
CHUNKS = "digest binary, row bigint, start bigint, length int"
KINDS = {"digests": "<u8", "owners": "<u2", "starts": "<i8", "lengths": "<u2"}


def packed(rows: DataFrame, buckets: int) -> DataFrame:
    """The chunks of all ``row, text``, packed by the first bits of their digests."""
    shift = U64(64 - max(1, buckets.bit_length() - 1))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                ids = part.column(0).to_numpy()
                digests, owners, starts, lengths = [], [], [], []
                for place, text in enumerate(part.column(1)):
                    if not text.is_valid:
                        continue
                    raw = text.as_buffer().to_pybytes()
                    ends = cuts(np.frombuffer(raw, np.uint8))
                    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
                    digests += [blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(begins.tolist(), ends.tolist())]
                    owners.append(np.full(len(ends), place, np.uint16))
                    starts.append(begins)
                    lengths.append((ends - begins).astype(np.uint16))
                if not digests:
                    continue
                both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
                owner, start, length = [np.concatenate(x) for x in (owners, starts, lengths)]
                order = np.lexsort((both[:, 1], both[:, 0]))
                both, owner, start, length = both[order], owner[order], start[order], length[order]
                new = np.append(True, (both[1:] != both[:-1]).any(axis=1))
                sizes = np.diff(np.append(np.flatnonzero(new), len(new)))
                often = np.repeat(sizes >= COMMON, sizes)
                # A common digest's first entry stays, twice, so that its bucket knows it repeats.
                bucket = (both[:, 0] >> shift).astype(np.int64)
                stay = np.flatnonzero(~often | new)
                stay = np.repeat(stay, np.where(often[stay], 2, 1))
                edges = np.flatnonzero(np.append(True, bucket[stay][1:] != bucket[stay][:-1]))
                sent = [(int(bucket[p[0]]), p) for p in np.split(stay, edges[1:])]
                around = np.flatnonzero(often & ~new)
                if len(around):
                    sent.append((-1 - int(both[0, 1] % U64(buckets)), around))
                made = []
                for number, places in sent:
                    used, renamed = np.unique(owner[places], return_inverse=True)
                    columns = (both[places], renamed.astype("<u2"), start[places], length[places], ids[used])
                    made.append((number, *[c.tobytes() for c in columns]))
                names = [f.split()[0] for f in PACKED.split(", ")]
                types = [pa.int32(), *[pa.binary()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made), types)], names=names
                )

    return rows.select("row", "text").mapInArrow(scan, PACKED)


def repeated_in_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    """The chunks of the bucket whose digest occurs more than once."""
    parts = {name: [] for name in ("digest", "row", "start", "length")}
    for line in frame.itertuples():
        parts["digest"].append(np.frombuffer(line.digests, "<u8").reshape(-1, 2))
        parts["row"].append(np.frombuffer(line.rows, "<i8")[np.frombuffer(line.owners, "<u2")])
        parts["start"].append(np.frombuffer(line.starts, "<i8"))
        parts["length"].append(np.frombuffer(line.lengths, "<u2"))
    found = {name: np.concatenate(p) for name, p in parts.items()}
    if int(frame["bucket"].iloc[0]) >= 0:
        order = np.lexsort((found["start"], found["row"], found["digest"][:, 1], found["digest"][:, 0]))
        found = {name: p[order] for name, p in found.items()}
        d = found["digest"]
        same = (d[1:] == d[:-1]).all(axis=1)
        twin = same & (found["row"][1:] == found["row"][:-1]) & (found["start"][1:] == found["start"][:-1])
        keep = (np.append(False, same) | np.append(same, False)) & ~np.append(False, twin)
        found = {name: p[keep] for name, p in found.items()}
    digests = [x.tobytes() for x in found.pop("digest")]
    return pd.DataFrame({"digest": digests, **found})[["digest", "row", "start", "length"]]


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The chunks that occur more than once: ``digest, doc, start, length, first_doc, first_start, across, copies,
    kept``.

    ``across`` tells whether several documents hold the chunk; ``kept`` marks its first occurrence.
    Stored.
    """
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("doc"),
        F.col(text_column).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(3, math.ceil(math.log2(max(1, size / (MEAN + LEAST) / BUCKET))))
    # A chunk names its row by the id; NULL ids sort first.
    named = rows.select(F.coalesce("doc", F.lit(-(1 << 63))).alias("row"), "text")
    chunks = packed(named, buckets).groupBy("bucket").applyInPandas(repeated_in_bucket, CHUNKS)
    chunks = stored(chunks, "chunks")
    firsts = chunks.groupBy(F.col("digest").alias("same")).agg(
        F.min(F.struct("row", "start")).alias("first"), F.max("row").alias("most"), F.count("*").alias("copies")
    )
    joined = chunks.join(stored(firsts, "firsts"), F.col("digest") == F.col("same"))
    first = F.col("first")
    real = lambda column: F.when(column != F.lit(-(1 << 63)), column)
    return stored(
        joined.select(
            "digest",
            real(F.col("row")).alias("doc"),
            "start",
            "length",
            real(first["row"]).alias("first_doc"),
            first["start"].alias("first_start"),
            (first["row"] != F.col("most")).alias("across"),
            "copies",
            ((first["row"] == F.col("row")) & (first["start"] == F.col("start"))).alias("kept"),
        ),
        "repeats",
    )


def passages(docs: DataFrame, least: int = PASSAGE_BYTES) -> DataFrame:
    """Runs of neighbouring chunks that other documents hold too, one row each:
    ``doc_id, start, end`` (in bytes), ``n_chunks, first_doc_id, copies, kept``.

    ``first_doc_id`` is the least document that holds a chunk of the run, ``copies`` the most
    occurrences of one, and ``kept`` tells whether the whole run is its first occurrence; a run that is
    not kept may hold first occurrences, which ``parts()`` tells apart.
    """
    shared = repeats(docs).where("across")
    order = Window.partitionBy("doc").orderBy("start", "digest")
    gap = F.lag(F.col("start") + F.col("length")).over(order)
    opens = F.when(gap == F.col("start"), 0).otherwise(1)
    runs = shared.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order))
    spans = runs.groupBy("doc", "run").agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("length")).alias("end"),
        F.count("*").cast("bigint").alias("n_chunks"),
        F.min("first_doc").alias("first_doc_id"),
        F.max("copies").alias("copies"),
        F.min("kept").alias("kept"),
    )
    return spans.where(F.col("end") - F.col("start") >= least).select(
        F.col("doc").alias("doc_id"), "start", "end", "n_chunks", "first_doc_id", "copies", "kept"
    )


def parts(found: DataFrame, least: int = PASSAGE_BYTES) -> DataFrame:
    """Runs of neighbouring chunks among the ``repeats()`` found, of ``least`` bytes or more, cut into
    parts that have their first occurrence in one piece. One row a part: ``doc_id, start, end`` (in
    bytes), ``n_chunks, first_doc_id, first_start, across, copies, kept``.

    ``across`` tells whether several documents hold its chunks, or this one repeats them. The bytes of a part are those of document ``first_doc_id`` from ``first_start`` on; ``kept`` tells
    whether the part is that first occurrence, ``copies`` the most occurrences of one of its chunks.
    """
    order = Window.partitionBy("doc").orderBy("start", "digest")
    last = lambda name: F.lag(name).over(order)
    begins = ~F.coalesce(last("start") + last("length") == F.col("start"), F.lit(False))
    goes_on = (
        last("first_doc").eqNullSafe(F.col("first_doc"))
        & (last("first_start") + last("length") == F.col("first_start"))
        & (last("kept") == F.col("kept"))
        & (last("across") == F.col("across"))
    )
    marked = found.withColumns({"begins": begins.cast("int"), "opens": (begins | ~goes_on).cast("int")})
    placed = marked.withColumns({"run": F.sum("begins").over(order), "part": F.sum("opens").over(order)})
    spans = placed.groupBy("doc", "run", "part").agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("length")).alias("end"),
        F.count("*").cast("bigint").alias("n_chunks"),
        F.min("first_doc").alias("first_doc_id"),
        F.min("first_start").alias("first_start"),
        F.min("across").alias("across"),
        F.max("copies").alias("copies"),
        F.min("kept").alias("kept"),
    )
    run = Window.partitionBy("doc", "run")
    whole = F.max("end").over(run) - F.min("start").over(run)
    return spans.withColumn("whole", whole).where(F.col("whole") >= least).select(
        F.col("doc").alias("doc_id"), "start", "end", "n_chunks", "first_doc_id", "first_start", "across", "copies", "kept"
    )


def told_apart(docs: DataFrame, id_column: str) -> bool:
    """Whether every row has an id of its own; only the ids are read."""
    ids = docs.select(F.col(id_column).alias("id"))
    return ids.groupBy("id").count().where("id IS NULL OR count > 1").isEmpty()


def numbered(docs: DataFrame, id_column: str, text_column: str, row: str) -> DataFrame:
    """``docs`` with the number ``row`` in the order of ids (NULL first) and texts; stored."""
    order = [F.col(id_column), F.xxhash64(text_column)]
    placed = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(placed.withColumn(row, F.monotonically_increasing_id()), "numbered")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``whole_deduplicated()`` of documents whose ids may be missing or repeated: every row is a document
    of its own then, in the order of ids and texts, and keeps its id in the result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if told_apart(docs, "doc_id"):
        return whole_deduplicated(docs)
    rows = numbered(docs, "doc_id", "text", "row")
    found = whole_deduplicated(rows.select(F.col("row").alias("doc_id"), "text"))
    names = [rows.select(F.col("row").alias(f"row_{k}"), F.col("doc_id").alias(f"id_{k}")) for k in (1, 2)]
    joined = found.join(names[0], F.col("doc_id") == F.col("row_1")).join(
        names[1], F.col("first_doc_id") == F.col("row_2"), "left"
    )
    own = {"doc_id": F.col("id_1").alias("doc_id"), "first_doc_id": F.col("id_2").alias("first_doc_id")}
    return joined.select(*[own.get(c, F.col(c)) for c in found.columns])


def whole_deduplicated(docs: DataFrame) -> DataFrame:
    """The ``parts()`` of all repeats, and what ``without_repeats()`` leaves of every document:
    ``n_bytes`` of the text, ``bytes_kept`` and the SHA-256 ``digest_kept`` of what stays (NULL for a
    NULL text).

    One row a part; a document without parts has one row, with NULL in their columns. All repeated
    chunks are cut, also those in runs too short for a part. Every row must have an id of its own.
    """
    found = repeats(docs)
    sized = docs.select("doc_id", "text", F.octet_length("text").cast("bigint").alias("n_bytes"))
    left = cut_out(sized, found, "doc_id", "text").select(
        "doc_id",
        "n_bytes",
        F.octet_length("text").cast("bigint").alias("bytes_kept"),
        F.sha2(F.col("text").cast("binary"), 256).alias("digest_kept"),
    )
    left = stored(left, "left")
    spans = parts(found).withColumnRenamed("doc_id", "of")
    joined = left.join(spans, F.col("doc_id").eqNullSafe(F.col("of")), "left")
    return joined.select("doc_id", *spans.columns[1:], "n_bytes", "bytes_kept", "digest_kept")


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with every chunk that is not its first occurrence cut out of the texts.

    Rows without repeats pass a bitmap and are not shuffled. If ids are missing or repeated, all rows are
    stored once with a number that stands for the id.
    """
    if told_apart(docs, id_column):
        return cut_out(docs, repeats(docs, id_column, text_column), id_column, text_column)
    (row,) = fresh(docs, "_row")
    rows = numbered(docs, id_column, text_column, row)
    return cut_out(rows, repeats(rows, row, text_column), row, text_column).drop(row)


def cut_out(docs: DataFrame, found: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``docs`` without the chunks of their ``repeats()`` that are not kept."""
    again = found.where("NOT kept AND doc IS NOT NULL")
    spans = again.groupBy(F.col("doc").alias("of")).agg(
        F.sort_array(F.collect_list(F.struct("start", "length"))).alias("spans")
    )
    spans = stored(spans, "spans")
    maybe, of, list_name = fresh(docs, "_maybe", "_of", "_spans")
    marked = flagged(docs, id_column, spans.select("of"), maybe)
    side = spans.withColumnsRenamed({"of": of, "spans": list_name})
    hit = marked.where(F.col(maybe)).join(side, F.col(id_column) == F.col(of), "left")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, list_of in zip(texts, lists):
            if text is None or list_of is None:
                out.append(text)
                continue
            raw, parts, at = text.encode(), [], 0
            for span in list_of:
                parts.append(raw[at : span["start"]])
                at = span["start"] + span["length"]
            out.append(b"".join([*parts, raw[at:]]).decode())
        return pd.Series(out, dtype=object)

    changed = hit.withColumn(text_column, cut(F.col(text_column), F.col(list_name)))
    plain = marked.where(~F.col(maybe)).select(docs.columns)
    return plain.unionByName(changed.select(docs.columns))
