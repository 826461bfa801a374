"""Exact copies by two passes of a Bloom filter; DataFrame functions only.

The first pass hashes every text and counts, in a table of cells, how often each of two cells of
a hash is hit. Cells hit twice or more form the filter. In the second pass a row whose two cells
are both in the filter is *possibly repeated*; all other rows are certainly alone and pass
straight through. Only the possibly repeated rows are shuffled, by their full hash.

The filter has 16 bits a row and never more than ``MOST_BITS`` (64 MB), so it may be broadcast at
any size of the input. With more rows than that it lets more single rows through to the exact
step, which stays right.

Defined results: NULL is an empty text. A NULL id loses to any other. Of rows that agree in id and
text, one stays. An empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, stored

BITS_A_ROW = 16
MOST_BITS = 1 << 29


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; NULL is empty."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    spelled = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(spelled)


def text_hash(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the normalised text in UTF-8."""
    return F.sha2(lower_ascii(text), 256)


def cells(hash_column: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(hash_column, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def repeat_filter(hashes: DataFrame, hash_column: str, rows: int, bits_a_row: int = BITS_A_ROW):
    """First pass: ``(bucket, bits)`` bitmaps of the cells hit at least twice, and the cell count."""
    bits = min(max(rows * bits_a_row, 1 << 15), MOST_BITS)
    hit = hashes.select(F.explode(F.array(*cells(hash_column, bits))).alias("cell"))
    twice = hit.groupBy("cell").count().where("count > 1")
    bitmaps = twice.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")
    )
    return stored(bitmaps, "repeat-filter"), bits


def bit_of(bitmap: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10)
    shifted = F.call_function("shiftright", byte.cast("int"), F.pmod(place, F.lit(8)).cast("int"))
    return shifted.bitwiseAND(1) == 1


def in_bitmap(bitmap: Column, cell: Column) -> Column:
    return bit_of(bitmap, F.bitmap_bit_position(cell))


def maybe_repeated(
    df: DataFrame, hash_column: str, bitmaps: DataFrame, bits: int, into: str
) -> DataFrame:
    """Second pass: add the boolean ``into``. The bitmaps hold at most ``MOST_BITS`` bits."""
    columns, hits = df.columns, []
    for number, cell in enumerate(cells(hash_column, bits)):
        bucket, found = fresh(df, f"_bucket{number}", f"_bits{number}")
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(bucket), F.col("bits").alias(found)))
        df = df.join(side, F.bitmap_bucket_number(cell) == F.col(bucket), "left")
        hits.append(F.coalesce(in_bitmap(F.col(found), cell), F.lit(False)))
    return df.select(*columns, (hits[0] & hits[1]).alias(into))


def maybe_among(df: DataFrame, id_column: str, ids: DataFrame, into: str) -> DataFrame:
    """Add whether the id may be in ``ids`` (one column, stored, distinct), by a bitmap."""
    name = ids.columns[0]
    bits = min(max(ids.count() * BITS_A_ROW, 1 << 15), MOST_BITS)
    cell = lambda column: F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(bits))
    bitmaps = ids.groupBy(F.bitmap_bucket_number(cell(name)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(cell(name))).alias("bits")
    )
    bucket, found = fresh(df, "_bucket", "_bits")
    side = stored(bitmaps, "id-filter").withColumnsRenamed({"bucket": bucket, "bits": found})
    joined = df.join(F.broadcast(side), F.bitmap_bucket_number(cell(id_column)) == F.col(bucket), "left")
    hit = F.coalesce(in_bitmap(F.col(found), cell(id_column)), F.lit(False))
    return joined.select(*df.columns, hit.alias(into))


def flagged(df: DataFrame, id_column: str, ids: DataFrame, into: str) -> DataFrame:
    """Add the boolean ``into``: is the id in ``ids`` (one column, stored, distinct)?

    Whole-number ids that lie close make a small exact bitmap, which is broadcast if it has at most
    ``MOST_BITS``. For others, rows that a hashed bitmap can't clear meet a join.
    """
    name = ids.columns[0]
    of, found, same = fresh(df, "_bucket", "_bits", "_same")
    bucket = lambda column: F.bitmap_bucket_number(F.col(column).cast("bigint"))
    place = lambda column: F.bitmap_bit_position(F.col(column).cast("bigint"))
    known = ids.where(F.col(name).isNotNull())
    bitmaps = stored(
        known.groupBy(bucket(name).alias(of)).agg(F.bitmap_construct_agg(place(name)).alias(found)), "ids"
    )
    if bitmaps.count() << 15 <= MOST_BITS:
        joined = df.join(F.broadcast(bitmaps), bucket(id_column) == F.col(of), "left")
        hit = F.coalesce(bit_of(F.col(found), place(id_column)), F.lit(False))
        return joined.select(*df.columns, hit.alias(into))
    marked = maybe_among(df, id_column, known, into)
    side = known.select(F.col(name).alias(same))
    met = marked.where(F.col(into)).join(side, F.col(id_column) == F.col(same), "left")
    met = met.select(*df.columns, F.col(same).isNotNull().alias(into))
    return marked.where(~F.col(into)).unionByName(met)


def without(docs: DataFrame, id_column: str, ids: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``ids`` (one column, stored, distinct)."""
    (listed,) = fresh(docs, "_listed")
    return flagged(docs, id_column, ids, listed).where(~F.col(listed)).select(docs.columns)


def resolve(
    rows: DataFrame, id_column: str, hash_column: str, row_column: str, names: tuple[str, str, str]
) -> DataFrame:
    """Add the kept id, the group's size and whether this row stays to rows stored with numbers."""
    keep, size, kept = names
    side_hash, top = fresh(rows, "_same", "_top")
    groups = rows.groupBy(F.col(hash_column).alias(side_hash)).agg(
        F.max(F.struct(F.col(id_column).alias("id"), F.col(row_column).alias("row"))).alias(top),
        F.count("*").alias(size),
    )
    groups = stored(groups.where(F.col(size) > 1), "copy-groups")
    joined = rows.join(groups, F.col(hash_column) == F.col(side_hash), "left")
    alone = F.col(top).isNull()
    return joined.select(
        *rows.columns,
        F.when(alone, F.col(id_column)).otherwise(F.col(f"{top}.id")).alias(keep),
        F.coalesce(F.col(size), F.lit(1).cast("bigint")).alias(size),
        (alone | (F.col(f"{top}.row") == F.col(row_column))).alias(kept),
    )


def find_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    prints = stored(
        docs.select(
            F.col(id_column).alias("doc_id"),
            text_hash(F.col(text_column)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "prints",
    )
    bitmaps, bits = repeat_filter(prints, "text_sha256", prints.count())
    marked = maybe_repeated(prints, "text_sha256", bitmaps, bits, "maybe")
    alone = marked.where(~F.col("maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    seen = resolve(
        marked.where("maybe"), "doc_id", "text_sha256", "row", ("keep_id", "group_size", "kept")
    )
    return alone.unionByName(seen.select(alone.columns))


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that repeat a text; rows that are alone are never shuffled."""
    sha, row, maybe, keep, size, kept = fresh(docs, "_sha", "_row", "_maybe", "_keep", "_size", "_kept")
    hashed = docs.withColumn(sha, text_hash(F.col(text_column)))
    prints = stored(hashed.select(sha), "prints")
    bitmaps, bits = repeat_filter(prints, sha, prints.count())
    marked = maybe_repeated(hashed, sha, bitmaps, bits, maybe)
    doubtful = marked.where(F.col(maybe)).withColumn(row, F.monotonically_increasing_id())
    seen = resolve(stored(doubtful, "doubtful"), id_column, sha, row, (keep, size, kept))
    alone = marked.where(~F.col(maybe)).select(docs.columns)
    return alone.unionByName(seen.where(F.col(kept)).select(docs.columns))
