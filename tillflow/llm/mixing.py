"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is shuffled and cut into blocks of equal numbers of words. A schedule of slots is
laid out by golden-ratio points: the point of slot ``i`` is mapped through the cumulative shares
of the sources, so every stretch of the schedule holds the sources near their shares. The slots
of a source are numbered in order and take its blocks in turn, at most ``REPEATS`` times each.

Scale: texts are read once, for their sizes, and never shuffled. Shuffles hold some numbers per
document, slot or source. Sums and ranks within a large source run over pieces of bounded size and
one row per piece, so no task holds a source.

Defined results: NULL text has size 0. NULL source is a source of its own, after all others.
Documents without words are never taken. Sources are weighed whether they have words or not;
those without have target 0. The order of shuffling follows from the id alone (for NULL ids, from
the place of the row), so reruns agree. Repeated rows count separately. An empty table gives an
empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, stored, sums_before, word_count

WEIGHTS = (5, 2, 1)
#: How often a document may be taken.
REPEATS = 3
#: Words of a block, and the least number of blocks of a source that has so many words.
BLOCK_WORDS, LEAST_BLOCKS = 8192, 1000
#: Golden-ratio points are multiples of GOLDEN modulo 2**31 (odd, nearest to 2**31 / 1.618...).
SPACE, GOLDEN = 1 << 31, 1_327_217_885
CELLS = 4096
#: Rows, or slots, that are summed or numbered together.
PIECE = 4096
SEED = 20_240_817


def sized(docs: DataFrame, carry: list[str], text: str = "text", source: str = "source") -> DataFrame:
    """``carry``, ``source``, ``size`` and a number for each row, stored."""
    return stored(
        docs.select(
            *carry,
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )


def weighed(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight, place`` with sources by code point, NULL last; stored.

    The place of a source is its rank in a range-partitioned sort, counted by partition.
    """
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    order = [F.col("source").isNull(), F.col("source")]
    parts = sizes.repartitionByRange(8, *order).withColumn("part", F.spark_partition_id())
    parts = stored(parts, "sources")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    counts = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = parts.withColumn("inside", inside).join(starts, "part")
    place = F.col("start") + F.col("inside") - 1
    cycle = F.array(*[F.lit(w) for w in weights])
    return stored(
        placed.select(
            "source",
            "source_size",
            "rows",
            place.alias("place"),
            F.get(cycle, F.pmod(place, F.lit(len(weights))).cast("int")).alias("weight"),
        ),
        "weights",
    )


def with_targets(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Add ``target``: shares of all words by weight, none above ``repeats`` times its source.

    What a full source can't take is shared again among the others by weight. Each round is one
    sum over the sources; it ends when no further source is full.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = math.inf, -1
    while True:
        # A source is full when its weight would give it its limit or more at this level.
        over = F.col("source_size") * repeats <= F.col("weight") * F.lit(level)
        over = F.col("source_size") < 0 if level == math.inf else over
        n, held, weight = sources.agg(
            F.count_if(over),
            F.coalesce(F.sum(F.when(over, F.col("source_size") * repeats)), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
        ).first()
        if n == full or not weight:
            break
        full, level = n, (total - held) / weight
    limit = (F.col("source_size") * repeats).cast("double")
    share = F.col("weight") * F.lit(float(0 if level == math.inf else level))
    return sources.withColumn("target", F.least(limit, share))


def with_blocks(sources: DataFrame, words: int = BLOCK_WORDS, least: int = LEAST_BLOCKS) -> DataFrame:
    """Add ``blocks``, the number of equal blocks a source is cut into."""
    wanted = F.greatest(F.ceil(F.col("source_size") / words), F.lit(least))
    return sources.withColumn("blocks", F.least(wanted, F.col("source_size")).cast("bigint"))


def schedule(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """The slots: ``slot, source place, rank, block, epoch`` in the order of the mix; stored.

    ``sources`` is small beside the slots: one row per source with ``target`` and ``blocks``.
    """
    spark = sources.sparkSession
    # In slots (here by 1024), a source's share is its target over the words of one of its blocks.
    shares = sources.where("source_size > 0").withColumn(
        "slots", F.round(F.col("target") * F.col("blocks") / F.col("source_size") * 1024).cast("bigint")
    )
    upto = stored(sums_before(shares, ["place"], {"before": "slots"}), "shares")
    total = upto.agg(F.sum("slots")).first()[0] or 0
    slots, scale = round(total / 1024), SPACE / max(total, 1)
    low, high = F.round(F.col("before") * scale), F.round((F.col("before") + F.col("slots")) * scale)
    width = SPACE // CELLS
    spans = upto.select(
        "place", "blocks", low.cast("bigint").alias("low"), high.cast("bigint").alias("high")
    ).where("high > low")
    spans = spans.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("high") - 1) / width)))
    )
    point = F.pmod(F.pmod("slot", F.lit(SPACE)) * GOLDEN, F.lit(SPACE))
    laid = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    laid = laid.withColumn("cell", F.floor(F.col("point") / width))
    hit = laid.join(spans, "cell").where("point >= low AND point < high")
    hit = stored(hit.select("slot", "place", "blocks", F.floor(F.col("slot") / PIECE).alias("piece")), "slots")
    counts = hit.groupBy("place", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("place", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("place", "piece").orderBy("slot")) - 1
    ranked = hit.withColumn("inside", inside).join(starts, ["place", "piece"])
    rank = F.col("start") + F.col("inside")
    return ranked.select(
        "slot",
        "place",
        rank.alias("rank"),
        F.pmod(rank, F.col("blocks")).alias("block"),
        F.floor(rank / F.col("blocks")).alias("epoch"),
    ).where(F.col("epoch") < repeats)


def shuffled(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with words with ``at``, the words before it in its shuffled source."""
    known = F.when(F.col("id").isNull(), F.xxhash64(F.col("row"), F.lit(SEED))).otherwise(
        F.xxhash64(F.col("id"), F.lit(SEED))
    )
    sides = sources.select(F.col("source").alias("same"), "place", "rows")
    rows = rows.where("size > 0").withColumn("mark", known)
    rows = rows.join(sides, F.col("source").eqNullSafe(F.col("same"))).drop("same")
    # Pieces of a source are equal ranges of the marks, some PIECE rows each.
    pieces = F.ceil(F.col("rows") / PIECE)
    rows = rows.withColumn("piece", F.floor((F.col("mark") / 2.0**64 + 0.5) * pieces))
    sums = rows.groupBy("place", "piece").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("place").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("place", "piece", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    inside = (
        Window.partitionBy("place", "piece").orderBy("mark", "row").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    starts = stored(starts, "starts")
    return local.join(starts, ["place", "piece"]).withColumn("at", F.col("start") + F.col("inside"))


def pieces_of_blocks(placed: DataFrame, sources: DataFrame) -> DataFrame:
    """The part of each row that lies in each block: ``row, place, block, from, to`` in its words.

    Block ``b`` of ``n`` holds the words from ``floor(b * size / n)`` of the shuffled source.
    """
    sides = sources.select("place", "source_size", "blocks")
    cut = placed.join(sides, "place")
    size, blocks = F.col("source_size"), F.col("blocks")
    start = lambda b: F.floor(b * size / blocks)
    # The last block that starts at or before a word; divisions in doubles may miss by one.
    def block_of(word: Column) -> Column:
        guess = F.greatest(F.floor(word * blocks / size) - 1, F.lit(0))
        step = lambda b: F.when((b + 1 < blocks) & (start(b + 1) <= word), b + 1).otherwise(b)
        return step(step(step(guess)))

    first, last = block_of(F.col("at")), block_of(F.col("at") + F.col("size") - 1)
    cut = cut.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(start(F.col("block")) - F.col("at"), F.lit(0))
    end = F.least(
        F.when(F.col("block") + 1 < blocks, start(F.col("block") + 1)).otherwise(size) - F.col("at"),
        F.col("size"),
    )
    return cut.select("row", "place", "block", begin.alias("from"), end.alias("to")).where("to > from")


def mixed(docs: DataFrame, carry: list[str], id_column: str = "doc_id") -> dict[str, DataFrame]:
    """The mix: ``rows`` (carry, id, source, size, row), ``sources`` with targets, ``slots`` (the
    schedule), ``pieces`` (which words of which row each block holds) and ``taken`` (words by row).
    """
    (id_name,) = fresh(docs, "id")
    rows = sized(docs.withColumn(id_name, F.col(id_column)), [*carry, F.col(id_name).alias("id")])
    sources = stored(with_blocks(with_targets(weighed(rows.select("source", "size")))), "targets")
    slots = stored(schedule(sources), "schedule")
    placed = shuffled(rows.select("id", "row", "source", "size"), sources)
    pieces = pieces_of_blocks(placed, sources)
    uses = slots.groupBy("place", "block").agg(F.count("*").alias("uses"))
    words = (F.col("to") - F.col("from")) * F.col("uses")
    taken = pieces.join(uses, ["place", "block"]).groupBy("row").agg(F.sum(words).alias("taken"))
    return {"rows": rows, "sources": sources, "slots": slots, "pieces": pieces, "taken": taken}


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    parts = mixed(docs.select("doc_id", "text", "source"), [])
    sources = parts["sources"].select(F.col("source").alias("same"), "source_size", "target")
    rows = parts["rows"].join(sources, F.col("source").eqNullSafe(F.col("same")), "left")
    return rows.join(parts["taken"], "row", "left").select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )


def repeat_rows(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, to the nearest whole number."""
    times, row = fresh(docs, "_times", "row")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    light = numbered.select(F.col(id_column).alias("doc_id"), "text", "source", F.col(row).alias("number"))
    parts = mixed(light, ["number"])
    sizes = parts["rows"].select("row", "number", "size")
    taken = sizes.join(parts["taken"], "row").select(
        F.col("number").alias(f"{row}_of"), F.round(F.col("taken") / F.col("size")).cast("int").alias(times)
    )
    taken = stored(taken.where(F.col(times) > 0), "times")
    joined = numbered.join(taken, F.col(row) == F.col(f"{row}_of"))
    again = joined.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times))))
    return again.select(docs.columns)
