"""Exact Jaccard join of documents by universe partitioning and the pigeonhole principle.

A document is the set of its distinct word shingles. Two sets of sizes a and b with a similarity of
at least 3/4 differ in at most (a + b) / 7 shingles. The universe of shingles is partitioned by hash
into segments, as many as the size band of a set needs, and a set's shingles fall into them. If two
sets differ in at most H shingles, then of any H + 1 segments one holds the same shingles in both;
and a segment counts twice if it may differ by one shingle.

*Index.* Every set lists, for its own band, the hash of each segment's content, and for one in
``DELETABLE`` segments also the hashes with one shingle left out.
*Probe.* Every set looks for sets of its own and of the next lower band, with H + 1 units spent where
they are cheapest: a unit looks a segment up as it is; a second one also finds segments with one
shingle more or less. The cost is the number of documents that hold the rarest shingle of the
segment; a table of the most frequent ones (bounded by its number of entries) is counted first over all
documents. So passages that many documents share are not looked up.
*Verify.* Candidates are compared shingle by shingle.

Only components are asked for, so a list of candidates need not become all its pairs. Equal sets are
one node from the start. In rounds, every node is compared with one pivot of its lists, and lists
that lie within one component are done. Rounds go on as long as they link at least one in ``WORTH`` of the
nodes that are left; a list's pivot is its node that is in the most lists, which in a group of near
copies is one close to most. At the end, in lists that still span several, nodes outside the largest
component look for others. In lists of up to ``SHORT`` nodes they meet all. In longer ones every node is
written as its difference from the list's pivot (``by_difference``): two nodes that are similar, but not
merely since both are close to the pivot, share many shingles of their differences, so that one lies
among the first few of each in a common order; so large groups of copies that are all just too
different don't become all their pairs. Pairs whose sketches of ``SKETCH`` parity bits differ in more
than H places are passed over, since each bit that differs is a shingle that differs, and the closest
pairs are compared first, until all that are left lie within components.

Scale: texts are never shuffled. Segment hashes travel packed by the thousand, in buckets of bounded
size; those that repeat within a batch of documents go around the buckets, spread by batch. Sketches are
stored for sets with a segment that is repeated elsewhere, and shingles for those whose sketch is near.

Defined results: NULL and empty texts have no shingles, no links, and are their own component. Rows
with a NULL id are linked with nothing and have a NULL component. Rows with the same id are one
document for links. Shingles are compared by 64-bit hashes, sets by 128 bits (64 within a list). An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import stored
from tillflow.llm.components import labelled
from tillflow.llm.exact import flagged, without
from tillflow.llm.hashing import mix, shingles
from tillflow.operators.rows import first_rows

WORDS = 5
#: One in so many segments is also indexed with one shingle left out.
DELETABLE = 32
#: Most shingles whose number of documents is known to all tasks; the least frequent ones give way.
FREQUENT = 1 << 18
#: Shingles that a task counts together, and the count in them from which on one is reported.
WINDOW, REPORTED = 1 << 22, 3
#: Texts and bytes that are worked on together, and segment hashes of a bucket.
BATCH_ROWS, BATCH_BYTES = 4096, 1 << 20
BUCKET = 1 << 18
#: Bytes of a segment hash that travel, besides the first bits, which its bucket tells. A bucket has
#: some 2**18 hashes at any size of the input, so few of them agree by chance.
HASH_BYTES = 4
#: Bits of a set's parity sketch.
SKETCH = 2048
#: Entries of a segment hash in one batch from which on it goes around the buckets.
COMMON = 6
#: Rounds of pivots go on while they link one in so many of the nodes left, two at least.
ROUNDS, WORTH = 2, 50
#: Nodes of a list up to which the last step meets them directly.
SHORT = 16
INDEX, PROBE, COMMON_FLAG = 1, 2, 4
U64 = np.uint64


# --- sizes ---------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _bands() -> np.ndarray:
    """The least size of each band; similar sets lie in the same or in neighbouring bands.

    Wide bands make segments smaller, narrow ones let more sets probe two bands.
    """
    return 1 << np.arange(42, dtype=np.int64)


def bands(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of each size, and the largest size of that band."""
    band = np.searchsorted(_bands(), sizes, "right") - 1
    return band, _bands()[band + 1] - 1


def segments(largest: np.ndarray, wider: int = 1) -> np.ndarray:
    """Segments of a band: enough non-empty ones for its own sets and those of the next band.

    The additions make it most unlikely that chance leaves a set, above all a small one, too few.
    """
    needed = 0.375 * largest + 1.5 * np.sqrt(largest) + 4096 / np.maximum(largest, 1)
    return np.ceil(needed * wider).astype(np.int64)


# --- segment hashes of a batch ----------------------------------------------------------


def _ranks(owner: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """The rank of each entry among those of its owner, by ``keys``."""
    order = np.lexsort((*keys[::-1], owner))
    sorted_owner = owner[order]
    first = np.searchsorted(sorted_owner, sorted_owner)
    ranks = np.empty(len(owner), np.int64)
    ranks[order] = np.arange(len(owner)) - first
    return ranks


def signatures(
    tokens: np.ndarray,
    owner: np.ndarray,
    sizes: np.ndarray,
    frequency: np.ndarray,
    lower: bool,
    wider: int = 1,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segment hashes, their sets and flags; and the sets whose segments do not suffice.

    ``tokens`` are distinct within a set, ``owner`` does not decrease. With ``lower`` only the
    probes into the next lower band are made, else the index and the probes of the own band.
    """
    band, largest = bands(sizes)
    if lower:
        band = band - 1
        largest = np.where(band >= 0, _bands()[np.maximum(band, 0) + 1] - 1, 0)
        differ = (largest + sizes) // 7
        wanted = (band >= 0) & (4 * largest >= 3 * sizes) & (differ > 0)
    else:
        differ = 2 * sizes // 7
        # Sets too small to differ from any similar one are found as equal sets.
        wanted = (largest + -(-largest * 4 // 3)) // 7 > 0
    m = np.maximum(segments(largest, wider), 1)
    inside = wanted[owner]
    tokens, owner, frequency = tokens[inside], owner[inside], frequency[inside]
    none = np.zeros(0, np.int64)
    if not len(tokens):
        return np.zeros(0, U64), none, none, none
    segment = ((tokens >> U64(32)) * m[owner].astype(U64)) >> U64(32)
    order = np.argsort((owner.astype(U64) << U64(40)) | segment, kind="stable")
    owner, segment, frequency = owner[order], segment[order].astype(np.int64), frequency[order]
    content = mix(tokens[order] ^ U64(0x5DEE_CE66))
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])
    at = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    g_owner, g_segment = owner[at], segment[at]
    length = np.diff(np.append(at, len(owner)))
    total = np.add.reduceat(content, at)
    salt = mix(band[g_owner].astype(U64) * U64(2 * wider + 1) + U64(77)) + g_segment.astype(U64) * U64(0x9E37_79B9_7F4A_7C15)
    exact = mix(total + salt)
    shorter = mix(total[group] - content + salt[group])  # without one shingle
    other = U64(0xA5A5_A5A5_A5A5_A5A5)  # contents with one left out, on the index side

    # Spend the units where they are cheapest.
    deletable = (g_segment * DELETABLE < m[g_owner]) & (length > 1)
    rarest = np.minimum.reduceat(frequency, at)
    rare = np.add.reduceat((frequency == 0).astype(np.int64), at)
    second = np.where(rare >= 2, 0, np.maximum.reduceat(frequency, at))
    up = np.flatnonzero(deletable)
    everyone = np.arange(len(at))
    ranks = _ranks(
        np.concatenate([g_owner, g_owner[up]]),
        np.concatenate([rarest, np.maximum(second[up], rarest[up])]),
        np.concatenate([np.zeros(len(at), np.int64), np.ones(len(up), np.int64)]),
        np.concatenate([everyone, up]),
    )
    units = np.concatenate([g_owner, g_owner[up]])
    probing = differ > 0
    chosen = (ranks <= differ[units]) & probing[units]
    looked, raised = chosen[: len(at)], np.zeros(len(at), bool)
    raised[up] = chosen[len(at) :]
    available = np.bincount(units, minlength=len(sizes))
    lacking = np.flatnonzero(wanted & probing & (available <= differ))

    flags = np.where(looked, PROBE, 0) | (0 if lower else INDEX)
    keep = flags > 0
    out = [(exact[keep], g_owner[keep], flags[keep])]
    if not lower:
        listed = deletable[group]
        out.append((shorter[listed] ^ other, owner[listed], np.full(int(listed.sum()), INDEX)))
    out.append((exact[raised] ^ other, g_owner[raised], np.full(int(raised.sum()), PROBE)))
    less = raised[group]
    out.append((shorter[less], owner[less], np.full(int(less.sum()), PROBE)))
    found = [np.concatenate(parts) for parts in zip(*out)]
    return found[0].astype(U64), found[1], found[2], lacking


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most so many rows and, but for single rows, bytes."""
    lengths = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(1)], np.int64)
    start = size = 0
    for place, length in enumerate(lengths.tolist()):
        if place > start and (size + length > BATCH_BYTES or place - start >= BATCH_ROWS):
            yield batch.slice(start, place - start)
            start, size = place, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)


class Sets:
    """The shingle sets of a slice: one entry per distinct set, with its least id."""

    def __init__(self, batch: pa.RecordBatch):
        ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        tokens, owner = shingles(batch.column(1), WORDS)
        self.ids, self.sizes = ids, np.bincount(owner, minlength=len(ids)).astype(np.int64)
        self.tokens, self.owner = tokens, owner
        bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        parts = [np.add.reduceat(mix(tokens ^ U64(s)), bounds[:-1][self.sizes > 0]) if len(tokens) else tokens
                 for s in (0x1234_5678_9ABC, 0xFEDC_BA98_7654)]
        self.key = np.zeros((len(ids), 2), U64)
        for column, part in enumerate(parts):
            self.key[self.sizes > 0, column] = mix(part + self.sizes[self.sizes > 0].astype(U64))
        self.bounds = bounds

    def once(self) -> np.ndarray:
        """The places of one row per distinct non-empty set, that with the least id."""
        order = np.lexsort((self.ids, self.key[:, 1], self.key[:, 0]))
        order = order[self.sizes[order] > 0]
        keys = self.key[order]
        new = np.ones(len(order), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        return np.sort(order[new])


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc"), F.col(text_column).alias("text"))
    return rows.where("doc IS NOT NULL")


# --- first pass: sizes, keys, frequent shingles --------------------------------------------


def _counted(pending: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that occur often enough in the window, and how often."""
    window = np.concatenate(pending) if pending else np.zeros(0, U64)
    pending.clear()  # a window is large: it is sorted in place, and only what is reported is copied
    window.sort()
    values = np.unique(window[REPORTED - 1 :][window[REPORTED - 1 :] == window[: len(window) - REPORTED + 1]])
    return values, np.searchsorted(window, values, "right") - np.searchsorted(window, values, "left")


def described(texts: DataFrame) -> DataFrame:
    """``doc, n, high, low`` of every row, and ``token, count`` of shingles repeated in a window; stored."""

    def rows_of(sets: Sets | None, values: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        n, t = len(sets.ids) if sets else 0, len(values)
        none = pa.nulls(t, pa.int64())
        held = [sets.ids, sets.sizes, *sets.key.view(np.int64).T] if sets else [np.zeros(0, np.int64)] * 4
        counted = [values.view(np.int64), counts.astype(np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(np.ascontiguousarray(c)), none]) for c in held]
            + [pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(c)]) for c in counted],
            names=["doc", "n", "high", "low", "token", "count"],
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, held = [], 0
        for batch in batches:
            for part in slices(batch):
                sets = Sets(part)
                alone = np.zeros(len(sets.ids), bool)
                alone[sets.once()] = True
                pending.append(sets.tokens[alone[sets.owner]])
                held += len(pending[-1])
                full = held >= WINDOW
                yield rows_of(sets, *_counted(pending if full else []))
                if full:
                    pending, held = [], 0
        yield rows_of(None, *_counted(pending))

    schema = "doc bigint, n bigint, high bigint, low bigint, token bigint, count bigint"
    return stored(texts.mapInArrow(scan, schema), "sets")


def frequent(info: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts; at most ``most``, of whole steps of frequency."""
    step = F.floor(8 * F.log2("count")).cast("int")
    counts = info.where("token IS NOT NULL").groupBy("token").agg(F.sum("count").alias("count"))
    counts = stored(counts.withColumn("step", step), "counts")
    least, listed = 1 << 20, 0
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():  # a few hundred at most
        listed += row["count"]
        if listed > most:
            break
        least = row["step"]
    rows = counts.where(F.col("step") >= least).select("token", "count").toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(U64)
    order = np.argsort(tokens)
    return tokens[order], rows["count"].to_numpy(np.int64)[order]


# --- second pass: segment hashes that are repeated -------------------------------------------

PACKED = "bucket int, hashes binary, places binary, high binary, lacking int"


def packed(texts: DataFrame, common: tuple[np.ndarray, np.ndarray], shift: int, wider: int) -> DataFrame:
    """Segment hashes of all sets, packed by bucket: their bits above ``shift``."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(common)
    keep = ~U64((1 << max(0, shift - 8 * HASH_BYTES)) - 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        turn = 0
        for batch in batches:
            for part in slices(batch):
                sets = Sets(part)
                once = sets.once()
                if not len(once):
                    continue
                place = np.full(len(sets.ids), -1, np.int64)
                place[once] = np.arange(len(once))
                inside = place[sets.owner] >= 0
                tokens, owner = sets.tokens[inside], place[sets.owner[inside]]
                sizes = sets.sizes[once]
                frequency = np.zeros(len(tokens), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
                    frequency = np.where(known[at] == tokens, counts[at], 0)
                made = [signatures(tokens, owner, sizes, frequency, low, wider) for low in (False, True)]
                hashes, owners, flags, lacking = [np.concatenate(x) for x in zip(*made)]
                hashes &= keep
                order = np.argsort(hashes, kind="stable")
                hashes, entries = hashes[order], (owners[order] | (flags[order] << 13)).astype(np.uint16)
                new = np.ones(len(hashes), bool)
                new[1:] = hashes[1:] != hashes[:-1]
                at = np.flatnonzero(new)
                often = np.repeat(np.diff(np.append(at, len(hashes))) >= COMMON, np.diff(np.append(at, len(hashes))))
                # Common ones go around the buckets; their first entry tells the bucket so.
                entries[new & often] |= COMMON_FLAG << 13
                stay = ~often | new
                bucket = (hashes >> U64(shift)).astype(np.int64)
                sent = [(b, s) for b, s in _parts(bucket, stay)]
                turn += 1
                around = np.flatnonzero(often)
                if len(around) or len(lacking):
                    spread = int(mix(np.array([sets.ids[0] * 31 + turn]).astype(U64))[0] % U64(1 << (64 - shift)))
                    sent.append((-1 - spread, around))
                yield _packed(sent, hashes, entries, sets, once, len(lacking), shift)

    return texts.mapInArrow(scan, PACKED)


def _parts(bucket: np.ndarray, stay: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    places = np.flatnonzero(stay)
    kept = bucket[places]
    at = np.flatnonzero(np.append(True, kept[1:] != kept[:-1])) if len(kept) else []
    for start, end in zip(at, [*at[1:], len(kept)]):
        yield int(kept[start]), places[start:end]


def _short(hashes: np.ndarray, shift: int) -> bytes:
    """The ``HASH_BYTES`` bytes below the bits that name the bucket."""
    below = hashes << U64(64 - shift)
    return below.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def _long(data: pa.Buffer, bucket: int, shift: int) -> np.ndarray:
    """Hashes with the bits of their bucket in front; the bits that did not travel are 0."""
    wide = np.zeros((len(data) // HASH_BYTES, 8), np.uint8)
    wide[:, :HASH_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, HASH_BYTES)
    return (wide.view(">u8").ravel().astype(U64) >> U64(64 - shift)) | U64(bucket) << U64(shift)


def _packed(sent, hashes, entries, sets, once, lacking, shift) -> pa.RecordBatch:
    rows = []
    for number, places in sent:
        inside = entries[places]
        used, renamed = np.unique(inside & 0x1FFF, return_inverse=True)
        rows.append(
            (
                number,
                _short(hashes[places], shift) if number >= 0 else hashes[places].tobytes(),
                ((inside & 0xE000) | renamed.astype(np.uint16)).tobytes(),
                sets.key[once[used], 0].tobytes(),
                lacking,
            )
        )
    columns = list(zip(*rows)) or [[]] * 5
    types = [pa.int32(), *[pa.binary()] * 3, pa.int32()]
    names = [field.split()[0] for field in PACKED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


REPEATED = "hash bigint, high bigint, flags int, lacking int"


def _unpacked(table: pa.Table, bucket: int, shift: int) -> dict[str, np.ndarray]:
    out: dict[str, list] = {name: [] for name in ("hash", "flags", "high")}
    for found, places, high in zip(table["hashes"], table["places"], table["high"]):
        entries = np.frombuffer(places.as_buffer(), np.uint16)
        place = entries & 0x1FFF
        found = found.as_buffer()
        out["hash"].append(np.frombuffer(found, U64) if bucket < 0 else _long(found, bucket, shift))
        out["flags"].append((entries >> 13).astype(np.int32))
        out["high"].append(np.frombuffer(high.as_buffer(), U64)[place])
    return {name: np.concatenate(parts) for name, parts in out.items()}


def repeated_in_bucket(table: pa.Table, shift: int) -> pa.Table:
    """The entries of the segment hashes that two different sets of the bucket share."""
    bucket = table["bucket"][0].as_py()
    rows = _unpacked(table, bucket, shift)
    if bucket >= 0:
        order = np.argsort(rows["hash"], kind="stable")
        rows = {name: column[order] for name, column in rows.items()}
        h = rows["hash"]
        same = h[1:] == h[:-1]
        apart = same & (rows["high"][1:] != rows["high"][:-1])
        new = np.append(True, ~same)
        at = np.flatnonzero(new)
        shared = np.append(False, apart).astype(np.int64) + ((rows["flags"] & COMMON_FLAG) > 0)
        probes = ((rows["flags"] & PROBE) > 0).astype(np.int64)
        several = np.add.reduceat(shared, at) > 0
        looked = (np.add.reduceat(probes, at) > 0) | (np.add.reduceat((rows["flags"] & COMMON_FLAG > 0).astype(np.int64), at) > 0)
        keep = np.repeat(several & looked, np.diff(np.append(at, len(h))))
        rows = {name: column[keep] for name, column in rows.items()}
    rows["flags"] &= INDEX | PROBE
    columns = [rows["hash"].view(np.int64), rows["high"].view(np.int64), rows["flags"], np.zeros(len(rows["hash"]), np.int32)]
    if bucket < 0 and max(table["lacking"].to_pylist()) > 0:  # a row that only says so
        columns = [np.append(column, column.dtype.type(says)) for column, says in zip(columns, (0, 0, 0, 1))]
    return pa.table([pa.array(column) for column in columns], names=["hash", "high", "flags", "lacking"])


def repeated(texts: DataFrame, least: DataFrame, common, total: int, wider: int = 1) -> DataFrame:
    """``hash, doc, n, flags, lacking`` for segment hashes that several sets share; stored.

    A set travels as half of its key; ``least`` (``high, low, n, least``, stored) tells its size and the least
    id that names it.
    """
    buckets = 1 << max(3, math.ceil(math.log2(max(1, total * 0.75 / BUCKET))))
    shift = 64 - (buckets.bit_length() - 1)
    rows = packed(texts, common, shift, wider).groupBy("bucket")
    rows = rows.applyInArrow(lambda table: repeated_in_bucket(table, shift), REPEATED)
    # The rows of one set and hash may come from several batches.
    merged = rows.groupBy("hash", "high").agg(F.bit_or("flags").alias("flags"), F.max("lacking").alias("lacking"))
    names = least.select(F.col("high").alias("h"), F.col("n").cast("int"), F.col("least").alias("doc"))
    named = merged.join(names, F.col("high") == F.col("h"), "left")
    # A row that only says that some set lacks segments has no set.
    told = {"doc": F.coalesce("doc", F.lit(-1)), "n": F.coalesce("n", F.lit(0))}
    return stored(named.withColumns(told).select("hash", "doc", "n", "flags", "lacking"), "repeated")


# --- verification -----------------------------------------------------------------------


def _described(texts: DataFrame, wanted: DataFrame, column: str, kind: str, describe) -> DataFrame:
    """``doc, n`` and ``describe`` of the shingles of the wanted documents; stored."""
    listed = flagged(texts, "doc", wanted, "wanted").where("wanted")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = Sets(part)
                use = np.flatnonzero(sets.sizes > 0)
                data = [describe(sets.tokens[sets.bounds[i] : sets.bounds[i + 1]]) for i in use]
                arrow = pa.array(data, pa.binary() if kind == "binary" else pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sets.ids[use]), pa.array(sets.sizes[use]), arrow], names=["doc", "n", column]
                )

    made = listed.select("doc", "text").mapInArrow(scan, f"doc bigint, n bigint, {column} {kind}")
    return stored(made, column)


def sketches(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``doc, n, parity`` of the wanted documents."""
    return _described(texts, wanted, "parity", "array<bigint>", _parity)


class TokenSets:
    """The shingles of the documents that verification has needed so far."""

    def __init__(self, texts: DataFrame):
        self.texts = texts
        self.held = texts.sparkSession.createDataFrame([], "doc bigint, n bigint, tokens binary")

    def of(self, pairs: DataFrame) -> DataFrame:
        """``doc, n, tokens`` of the documents in ``a`` and ``b``; only new ones are read from texts."""
        docs = pairs.select(F.col("a").alias("doc")).unionByName(pairs.select(F.col("b").alias("doc")))
        docs = stored(docs.distinct(), "compared")
        needed = stored(docs.join(self.held.select("doc"), "doc", "left_anti"), "needed")
        if not needed.isEmpty():
            more = _described(self.texts, needed, "tokens", "binary", lambda t: t.tobytes())
            self.held = self.held.unionByName(more)
        return flagged(self.held, "doc", docs, "use").where("use").drop("use")


def _parity(tokens: np.ndarray) -> np.ndarray:
    """The sketch: whether an odd number of shingles falls on each of its bits."""
    odd = np.bincount((tokens % U64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def near(pairs: DataFrame, drawn: DataFrame) -> DataFrame:
    """``a, b, apart`` of the distinct pairs that sizes and sketches allow to be similar; stored."""
    rows = pairs
    for side in ("a", "b"):
        one = drawn.select(
            F.col("doc").alias(f"d_{side}"), F.col("n").alias(f"n_{side}"), F.col("parity").alias(f"p_{side}")
        )
        rows = rows.join(one, F.col(side) == F.col(f"d_{side}"))
    differing = F.zip_with("p_a", "p_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    rows = rows.where(4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b")).withColumn(
        "apart", F.aggregate(differing, F.lit(0), lambda total, x: total + x)
    )
    return stored(rows.where(7 * F.col("apart") <= F.col("n_a") + F.col("n_b")).select("a", "b", "apart"), "near")


def similar(pairs: DataFrame, held: TokenSets) -> DataFrame:
    """Those of the stored pairs ``a, b`` that are similar, compared shingle by shingle; stored."""
    sets = held.of(pairs)
    for side in ("a", "b"):
        one = sets.select(F.col("doc").alias(f"d_{side}"), F.col("tokens").alias(f"t_{side}"))
        pairs = pairs.join(one, F.col(side) == F.col(f"d_{side}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one = np.frombuffer(x.as_buffer(), U64)
                two = np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([one, two])
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                good.append(100 * shared >= 75 * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    compared = pairs.select("a", "b", "t_a", "t_b").mapInArrow(compare, "a bigint, b bigint")
    return stored(compared, "similar")


# --- components ----------------------------------------------------------------------------


def spanning(lists: DataFrame) -> DataFrame:
    """The lists that hold several components, stored."""
    ends = lists.groupBy(F.col("hash").alias("same")).agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.bit_or("flags").alias("roles")
    )
    open_lists = ends.where("low <> high AND roles = 3").select("same")
    return stored(lists.join(stored(open_lists, "open"), F.col("hash") == F.col("same"), "left_semi"), "lists")


def relabelled(rows: DataFrame, labels: DataFrame, node: str, into: str) -> DataFrame:
    """``rows`` with ``into``, the component of the column ``node``."""
    side = labels.select(F.col("node").alias("_node"), F.col("label").alias("_found"))
    joined = rows.drop(into).join(side, F.col(node) == F.col("_node"), "left")
    return joined.withColumn(into, F.coalesce("_found", node)).drop("_node", "_found")


def pivots(lists: DataFrame) -> DataFrame:
    """``same, pivot`` (its doc and label): of each list the node that is in the most lists; stored."""
    spread = stored(lists.groupBy(F.col("doc").alias("node")).agg(F.count("*").alias("lists")), "spread")
    ranked = lists.join(spread, F.col("doc") == F.col("node"))
    central = F.max_by(F.struct("label", "doc"), F.struct("lists", -F.col("doc"))).alias("pivot")
    return stored(ranked.groupBy(F.col("hash").alias("same")).agg(central), "pivots")


def by_difference(lists: DataFrame, sets: TokenSets) -> DataFrame:
    """``a, b``: pairs of different components in the same list that may be similar, all similar ones included.

    A node x is its difference D(x) from the list's pivot, of d(x) shingles. For a similar pair, x and y differ
    in at most H = (a + b) / 7, at most a third of either size, so d(x) and d(y) differ by at most H, too.
    If d(x) + d(y) <= H, both are similar to the node with the least 7 d - n, so every node is paired with
    that one. Else D(x) and D(y) have at least (d(x) + d(y) - H) / 2 shingles in common, and the first of those,
    in any order, has at most (d(x) - d(y) + H) / 2 before it in D(x), and likewise in D(y). The order is: shingles
    that the pivot lacks, those in the fewest differences first, then its own. Most of the first are in one only;
    they take up places in the order, but nothing can be met through them, so they are counted and not listed. At
    least one of a pair lies outside the largest component, whose nodes need list only what differences as large
    as those can meet.
    """
    chosen = lists.join(pivots(lists), F.col("hash") == F.col("same"))
    chosen = stored(chosen.select(F.col("doc").alias("a"), F.col("pivot.doc").alias("b"), "label").distinct(), "from-pivots")
    held = sets.of(chosen)
    rows = chosen
    for side in ("a", "b"):
        one = held.select(F.col("doc").alias(f"d_{side}"), F.col("tokens").alias(f"t_{side}"))
        rows = rows.join(one, F.col(side) == F.col(f"d_{side}"))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part, sizes, apart, first, rest = batch.slice(start, 1024), [], [], [], []
                for x, y in zip(part.column(3), part.column(4)):
                    own, base = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                    sizes.append(len(own))
                    added = np.setdiff1d(own, base, assume_unique=True)
                    lost = np.sort(np.setdiff1d(base, own, assume_unique=True))
                    apart.append(len(added) + len(lost))
                    first.append(added.view(np.int64))
                    rest.append(lost[: max(0, len(own) // 3 + 1 - len(added))].view(np.int64))
                made = [pa.array(x, pa.int64()) for x in (sizes, apart)] + [pa.array(x, pa.list_(pa.int64())) for x in (first, rest)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *made], names=["doc", "pivot", "label", "n", "d", "added", "lost"]
                )

    schema = "doc bigint, pivot bigint, label bigint, n bigint, d bigint, added array<bigint>, lost array<bigint>"
    nodes = stored(rows.select("a", "b", "label", "t_a", "t_b").mapInArrow(differ, schema), "differences")
    closest = nodes.groupBy(F.col("pivot").alias("same")).agg(
        F.min_by(F.struct("doc", "label"), F.struct(7 * F.col("d") - F.col("n"), "doc")).alias("center")
    )
    to_center = nodes.join(stored(closest, "centers"), F.col("pivot") == F.col("same")).where(
        F.col("label") != F.col("center.label")
    )
    counts = stored(nodes.groupBy(F.col("pivot").alias("same"), "label").agg(F.count("*").alias("size"), F.min("d").alias("d")), "counts")
    main = counts.groupBy("same").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    least = counts.join(stored(main.withColumnRenamed("same", "group"), "main"), F.col("same") == F.col("group")).groupBy("same").agg(
        F.min("main").alias("main"), F.min(F.when(F.col("label") != F.col("main"), F.col("d"))).alias("least")
    )
    placed = nodes.join(stored(least.where("least IS NOT NULL"), "least"), F.col("pivot") == F.col("same"))
    placed = placed.withColumn("minor", F.col("label") != F.col("main"))
    # Twice the rank that a shingle may have: at most a third of the size more than d is above its partner's.
    reach = F.when(F.col("minor"), 2 * F.floor(F.col("n") / 3)).otherwise(F.col("d") - F.col("least") + F.floor(F.col("n") / 3))
    placed = placed.withColumn("reach", reach).where("reach >= 0")
    columns = ["doc", "pivot", "label", "n", "d", "minor"]
    spread = placed.select(*columns, "reach", F.size("added").alias("more"), F.explode("added").alias("token"))
    shared = spread.groupBy(F.col("pivot").alias("same"), F.col("token").alias("often")).agg(F.count("*").alias("count"))
    shared = stored(shared.where("count > 1"), "shared")
    met = spread.join(shared, (F.col("pivot") == F.col("same")) & (F.col("token") == F.col("often")))
    own = Window.partitionBy("pivot", "doc")
    before = F.col("more") - F.count("*").over(own) + F.row_number().over(own.orderBy("count", "token")) - 1
    pivots_own = placed.select(*columns, "reach", F.size("added").alias("more"), F.posexplode("lost").alias("place", "token"))
    pivots_own = pivots_own.withColumn("rank", (F.col("more") + F.col("place")).cast("bigint"))
    listed = met.withColumn("rank", before.cast("bigint")).select(*columns, "reach", "rank", "token")
    listed = listed.unionByName(pivots_own.select(*columns, "reach", "rank", "token")).where("2 * rank <= reach")
    listed = stored(listed.drop("reach"), "prefixes")
    low, high = (
        rows.select("pivot", "token", *[F.col(c).alias(f"{c}_{side}") for c in ("doc", "label", "n", "d", "minor", "rank")])
        for side, rows in (("a", listed.where("2 * rank <= floor(n / 3)")), ("b", listed))
    )
    most = "floor((n_a + n_b) / 7)"
    met = low.join(high, ["pivot", "token"]).where(
        f"d_a <= d_b AND label_a <> label_b AND (minor_a OR minor_b) AND 4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)"
        f" AND 2 * rank_a <= d_a - d_b + {most} AND 2 * rank_b <= d_b - d_a + {most}"
    )
    return met.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b")).unionByName(
        to_center.select(F.col("doc").alias("a"), F.col("center.doc").alias("b"))
    )


def clustered(lists: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, label`` of all documents that are linked with another."""
    spark = lists.sparkSession
    lists = spanning(lists.select("hash", "doc", "n", "flags").withColumn("label", F.col("doc")))
    if lists.isEmpty():
        return spark.createDataFrame([], "node bigint, label bigint")
    drawn = sketches(texts, stored(lists.select("doc").distinct(), "wanted"))
    sets = TokenSets(texts)
    links = spark.createDataFrame([], "a bigint, b bigint")
    tested = links
    done, more = 0, True
    while done < ROUNDS or more:
        done += 1
        met = lists.join(pivots(lists), F.col("hash") == F.col("same"))
        met = met.where(F.col("label") != F.col("pivot.label"))
        votes = met.groupBy(F.col("doc").alias("a"), F.col("pivot.doc").alias("b")).agg(F.count("*").alias("votes"))
        votes = votes.join(tested, ["a", "b"], "left_anti")
        best = votes.groupBy("a").agg(F.max(F.struct("votes", (-F.col("b")).alias("less"))).alias("best"))
        chosen = stored(best.select("a", (-F.col("best.less")).alias("b")), "chosen")
        tested = tested.unionByName(chosen)
        found = similar(near(chosen, drawn).select("a", "b"), sets)
        more = found.count() * WORTH >= chosen.count() > 0
        links = stored(links.unionByName(found), "linked")
        labels = stored(labelled(links), "labels")
        lists = spanning(relabelled(lists, labels, "doc", "label"))
        if lists.isEmpty():
            return labels
    # What still lies apart: in each list, all outside its largest component against all, or by differences.
    lengths = stored(lists.groupBy(F.col("hash").alias("same")).agg(F.count("*").alias("k")), "lengths")
    measured = stored(lists.join(lengths, F.col("hash") == F.col("same")).drop("same"), "measured")
    long, lists = (measured.where(f"k {sign} {SHORT}").drop("k") for sign in (">", "<="))
    counts = lists.groupBy("hash", "label").agg(F.count("*").alias("size"))
    largest = counts.groupBy(F.col("hash").alias("same")).agg(F.max(F.struct("size", "label")).alias("most"))
    minor = lists.join(stored(largest, "largest"), F.col("hash") == F.col("same")).where(
        F.col("label") != F.col("most.label")
    )
    one, two = (
        rows.select("hash", *[F.col(c).alias(f"{c}_{side}") for c in ("doc", "n", "label", "flags")])
        for side, rows in (("a", minor), ("b", lists))
    )
    met = stored(one, "minor").join(two, "hash").where(
        "label_a <> label_b AND (flags_a | flags_b) = 3 AND 4 * least(n_a, n_b) >= 3 * greatest(n_a, n_b)"
    )
    pairs = met.select(F.col("doc_a").alias("a"), F.col("doc_b").alias("b"))
    if not long.isEmpty():
        pairs = pairs.unionByName(by_difference(long, sets))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = pairs.join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    left = near(stored(pairs, "pairs"), drawn)
    if left.isEmpty():
        return labels
    # Each node's closest pairs first, more in each round: most others then lie within one component.
    most = 1
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
        best = first_rows(ends, ["a"], ["apart", "b"], most)
        chosen = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        chosen = stored(chosen, "closest")
        links = links.unionByName(similar(chosen, sets))
        labels = stored(labelled(links), "labels")
        left = left.join(chosen, ["a", "b"], "left_anti")
        left = relabelled(relabelled(left, labels, "a", "l_a"), labels, "b", "l_b")
        left = stored(left.where("l_a <> l_b").select("a", "b", "apart"), "left")
        most *= 8
    return labels


def components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    nameless = docs.where(F.col(id_column).isNull()).select(F.lit(0).cast("bigint").alias("doc"), F.col(text_column).alias("text"))
    texts = _texts(docs, id_column, text_column)
    info = described(texts)
    rows = info.where("token IS NULL").drop("token", "count")
    total = rows.agg(F.sum("n")).first()[0] or 0
    common = frequent(info)
    sets = rows.where("n > 0").groupBy("high", "low").agg(F.max("n").alias("n"), F.min("doc").alias("least"))
    sets = stored(sets, "distinct")
    lists = repeated(texts, sets, common, total)
    wide, wider = lists, 1
    while wide.where("lacking > 0").count():
        # Some set has too few filled segments: again with eight times as many, until none has.
        wider *= 8
        wide = repeated(texts, sets, common, total, wider)
        lists = lists.unionByName(wide)
    labels = stored(clustered(lists, texts), "labels")
    classes = sets.join(labels, F.col("least") == F.col("node"), "left").select(
        F.col("high").alias("h"), F.col("low").alias("l"), F.coalesce("label", "least").alias("component")
    )
    known = rows.join(
        stored(classes, "classes"),
        (F.col("n") > 0) & (F.col("high") == F.col("h")) & (F.col("low") == F.col("l")),
        "left",
    ).select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )
    if nameless.isEmpty():
        return known
    nothing = F.lit(None).cast("bigint")
    others = described(nameless).where("token IS NULL").select(
        nothing.alias("doc_id"), F.col("n").alias("n_shingles"), nothing.alias("component_id")
    )
    return known.unionByName(others)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with only the least id of each component; rows with a NULL id stay."""
    found = components(docs, id_column, text_column)
    extra = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return without(docs, id_column, stored(extra, "near-copies"))
