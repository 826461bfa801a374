"""Importance resampling of documents by hashed n-gram models.

Two bag-of-n-grams models over the same hash buckets are counted: one of the target text (documents
labelled as good), one of all raw documents. A document's importance is the log-ratio of its
probabilities under the two, per n-gram and scaled by ``SHARPNESS`` (a plain sum would let length
decide). The sample is drawn without replacement by the Gumbel trick: noise from a hash of the id is
added to the log-weight, and the highest ``share`` of all documents is taken.

Scale: word and word-pair hashes are counted into ``BUCKETS`` numbers per task before anything is
shuffled, whatever the frequency of a word. All documents are counted, and the two models the driver
holds are of fixed size. The threshold of the sample is found by radix selection over 16 bits of
the sort key at a time, each step one aggregation to at most 65,536 rows; no global sort.

Defined results: NULL and empty texts have no n-grams and weight 0. Documents without a label only
count as raw; a document with several labels counts as target if any is good. Without target texts
all weights are 0. Ties, such as repeated rows, are broken by the stored row number, so exactly the
asked number is selected. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import stored
from tillflow.llm.exact import flagged
from tillflow.llm.hashing import mix, word_hashes

BUCKETS = 1 << 16
#: Added to every bucket of both models.
SMOOTHING = 1.0
SHARPNESS = 30.0
SEED = 11
BATCH_BYTES = 4 << 20
U64 = np.uint64
PAIR = U64(0xD6E8_FEB8_6659_FD93)


def buckets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word and each pair of neighbouring words, and the text it is from."""
    words, owner = word_hashes(texts)
    inside = owner[1:] == owner[:-1]
    pairs = mix(words[:-1] * PAIR + words[1:])[inside]
    shift = U64(64 - (BUCKETS.bit_length() - 1))
    hashed = (np.concatenate([words, pairs]) >> shift).astype(np.int64)
    return hashed, np.concatenate([owner, owner[1:][inside]])


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, pa.Array]]:
    """Bounded runs of rows of a batch, each with its first row's place."""
    texts = batch.column(column)
    sizes = [len(t.as_buffer()) if t.is_valid else 0 for t in texts]
    start = held = 0
    for place, size in enumerate(sizes):
        if place > start and held + size > BATCH_BYTES:
            yield start, texts.slice(start, place - start)
            start, held = place, 0
        held += size
    if start < len(sizes):
        yield start, texts.slice(start)


def counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts per bucket of the target rows and of all rows of ``text, is_target``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            target = np.array(batch.column(1).to_pylist(), bool)
            for start, texts in _parts(batch, 0):
                hashed, owner = buckets_of(texts)
                sums[1] += np.bincount(hashed, minlength=BUCKETS)
                sums[0] += np.bincount(hashed[target[start + owner]], minlength=BUCKETS)
        used = np.flatnonzero(sums[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(sums[0][used]), pa.array(sums[1][used])], names=["bucket", "target", "raw"]
        )

    made = rows.select("text", "is_target").mapInArrow(scan, "bucket bigint, target bigint, raw bigint")
    table = made.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).toPandas()
    target, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    target[table["bucket"]] = table["target"]
    raw[table["bucket"]] = table["raw"]
    return target, raw


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Per bucket, the log of its probability in the target over that in the raw text."""
    if not target.sum():
        return np.zeros(len(target))
    p = (target + SMOOTHING) / (target + SMOOTHING).sum()
    q = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    return np.log(p) - np.log(q)


def weighed(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``doc_id, n_ngrams, log_weight`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _parts(batch, 1):
                hashed, owner = buckets_of(texts)
                n = np.bincount(owner, minlength=len(texts))
                sums = np.bincount(owner, shared.value[hashed], len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array(n.astype(np.int64)),
                        pa.array(SHARPNESS * sums / np.maximum(n, 1)),
                    ],
                    names=["doc_id", "n_ngrams", "log_weight"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    return rows.mapInArrow(scan, "doc_id bigint, n_ngrams bigint, log_weight double")


def highest(rows: DataFrame, keys: list[str], count: int) -> tuple[int, ...] | None:
    """The least of the ``count`` highest rows by the long columns ``keys``, which tell all rows apart.

    Finds 16 bits of a key at a time, from the top; each step counts the rows per value.
    """
    if count <= 0:
        return None
    found: list[int] = []
    for key in keys:
        value, rows_left = 0, rows
        for shift in (48, 32, 16, 0):
            # Flipping the sign bit makes the order of the longs that of their unsigned bits.
            digit = F.shiftrightunsigned(F.col(key).bitwiseXOR(F.lit(-(1 << 63))), shift).bitwiseAND(65535)
            table = rows_left.groupBy(digit.alias("digit")).count().orderBy(F.desc("digit")).collect()
            for row in table:
                if count <= row["count"]:
                    break
                count -= row["count"]
            value = value << 16 | row["digit"]
            rows_left = rows_left.where(digit == row["digit"])
        found.append(value - (1 << 63))
        rows = rows_left
    return tuple(found)


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """``doc_id, n_ngrams, log_weight, gumbel_key, kept`` of every document.

    The target is what ``labels`` calls good (``quality`` 1) and not toxic. ``share`` of all
    documents are drawn; by default the share of good ones among the labelled.
    """
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    named = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(good, F.lit(False)).cast("int")).alias("good")
    )
    named = stored(named, "labels")
    if share is None:
        share = named.agg(F.avg("good")).first()[0] or 0.0
    target = stored(named.where("good = 1").select(F.col("doc_id").alias("of")), "target")
    told = flagged(docs.select("doc_id", "text"), "doc_id", target, "is_target").select("text", "is_target")
    ratio = log_ratio(*counts(told))
    rows = weighed(docs, ratio).withColumn("row", F.monotonically_increasing_id())
    mark = F.xxhash64(F.coalesce("doc_id", "row"), F.lit(SEED))
    uniform = (F.shiftrightunsigned(mark, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    gumbel = -F.log(-F.log(uniform))
    key = F.col("log_weight") + gumbel
    # The key in steps of 2**-32, which leaves room for any weight.
    rows = rows.withColumn("gumbel_key", key).withColumn("step", F.round(key * float(1 << 32)).cast("bigint"))
    rows = stored(rows, "weights")
    total = rows.count()
    least = highest(rows, ["step", "row"], min(total, math.floor(share * total + 0.5)))
    if least is None:
        kept = F.lit(False)
    else:
        step, row = least
        kept = (F.col("step") > step) | ((F.col("step") == step) & (F.col("row") >= row))
    return rows.select("doc_id", "n_ngrams", "log_weight", "gumbel_key", kept.alias("kept"))
