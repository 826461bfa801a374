"""Records of large CSV files whose quoted fields hold line breaks, found in parallel.

Spark reads such a file in one task, since a split can't know whether it begins inside quotes. Here the
file is read as lines, in as many splits as its size asks for. To a reader that is outside or inside
quotes a line is a function of that state: it may set it, keep it or flip it. The functions of a split's
lines, put together, are again one of these, so the state at the start of every split is a prefix over
one row per split, and the state of every line a prefix within its split. Lines that begin outside
quotes begin a record; the few that lie in records of several lines are put together by the record's
first line, across splits too. No task sees more than a split, or a record.

The grammar is that of Spark's own reader with ``""`` for a quote inside quotes: a quote opens a field
only at its start, and text after a closing quote belongs to the field up to the next comma.

Every file must begin with its header. Lines end in a line feed, with or without a carriage return
before it. A file that ends inside quotes ends its last record. Empty lines between records are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The rest of a quoted field up to, not including, its closing quote.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
#: Fields that end in a comma, then a quoted field that the line does not close.
_OPENS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+"{_INSIDE}\z'
#: Lines after which a reader outside (inside) quotes is inside.
OPENS = rf"\A{_OPENS}"
STAYS = rf'\A{_INSIDE}(?:\z|"[^,]*+,{_OPENS})'

SPLIT = ["_file", "_block"]


def odd(count: Column) -> Column:
    return F.pmod(count, F.lit(2)) == 1


def lines_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``_line, _file, _block, _at`` with what each line does: ``_flip`` (0 or 1), ``_fixed`` (or NULL)."""
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("value").alias("_line"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    quoted = F.contains("_line", F.lit('"'))
    opens, stays = quoted & F.rlike("_line", F.lit(OPENS)), ~quoted | F.rlike("_line", F.lit(STAYS))
    lines = lines.withColumns({"_opens": opens, "_stays": stays})
    return lines.withColumns(
        {
            "_flip": (F.col("_opens") & ~F.col("_stays")).cast("int"),
            "_fixed": F.when(F.col("_opens") == F.col("_stays"), F.col("_opens")),
        }
    )


def state_before(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add the state before each row: ``_set``, or NULL and whether a start state is flipped, ``_odd``."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    counted = df.withColumn("_flips", F.coalesce(F.sum("_flip").over(before), F.lit(0)))
    last = F.last(F.when(F.col("_fixed").isNotNull(), F.struct("_fixed", "_flips")), True).over(before)
    found = counted.withColumn("_last", last).withColumns(
        {"_set": F.col("_last._fixed") != odd(F.col("_flips") - F.col("_last._flips")), "_odd": odd(F.col("_flips"))}
    )
    return found.drop("_last")


def split_starts(lines: DataFrame) -> DataFrame:
    """Per split whether it begins inside quotes, and the last record that begins in a split before it."""
    fixed = F.col("_fixed").isNotNull()
    starts = {
        name: F.count_if(~F.coalesce(F.col("_set"), F.col("_odd") != F.lit(inside)))
        for name, inside in (("_outside", False), ("_inside", True))
    }
    splits = lines.groupBy(*SPLIT).agg(
        F.sum("_flip").alias("_total"),
        F.max_by(F.struct("_fixed", "_flips"), F.when(fixed, F.col("_at"))).alias("_end"),
        *[count.alias(name) for name, count in starts.items()],
    )
    whole = splits.withColumns(
        {
            "_fixed": F.col("_end._fixed") != odd(F.col("_total") - F.col("_end._flips")),
            "_flip": F.when(F.col("_end").isNull(), F.pmod(F.col("_total"), F.lit(2)).cast("int")).otherwise(0),
        }
    )
    # A file begins outside quotes.
    begun = state_before(whole, ["_file"], "_block").withColumn("_from", F.coalesce("_set", "_odd"))
    count = F.when(F.col("_from"), F.col("_inside")).otherwise(F.col("_outside"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col("_count") > 0, F.struct(F.col("_block"), F.col("_count").alias("_record")))
    owned = begun.withColumn("_count", count).withColumn("_owner", F.last(own, True).over(before))
    return owned.select(F.col("_file").alias("_f"), F.col("_block").alias("_b"), "_from", "_owner")


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``record, is_header`` of every record of the CSV files in ``path``, in no certain order."""
    lines = state_before(lines_of(spark, path), SPLIT, "_at")
    splits = split_starts(lines)
    same = (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b"))
    inside = F.coalesce(F.col("_set"), F.col("_from") != F.col("_odd"))
    after = F.when(F.col("_before"), F.col("_stays")).otherwise(F.col("_opens"))
    so_far = Window.partitionBy(*SPLIT).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.join(splits, same).withColumn("_before", inside)
    placed = placed.withColumns(
        {"_after": after, "_number": F.sum((~F.col("_before")).cast("bigint")).over(so_far)}
    )
    own = F.struct(F.col("_block"), F.col("_number").alias("_record"))
    placed = placed.withColumn("_key", F.when(F.col("_number") > 0, own).otherwise(F.col("_owner")))
    alone = ~F.col("_before") & ~F.col("_after")
    whole = placed.where(alone).select("_key", F.col("_line").alias("record"))
    parts = placed.where(~alone).groupBy("_file", "_key").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_at", "_line"))).alias("_lines")
    )
    joined = parts.select("_key", F.array_join(F.col("_lines._line"), "\n").alias("record"))
    first = (F.col("_key._block") == 0) & (F.col("_key._record") == 1)
    found = whole.unionAll(joined).select(
        F.regexp_replace("record", r"\r\z", "").alias("record"), first.alias("is_header")
    )
    return found.where("record <> ''")


def parsed(
    spark: SparkSession, path: str | list[str], names: list[str], corrupt: str | None = None, **options: str
) -> DataFrame:
    """The fields of every record as text, by the header's ``names``; another header is an error.

    ``corrupt`` names a further column for the text of records that have too few or too many fields.
    """
    text = ", ".join(f"`{name}` string" for name in names)
    kinds = text + (f", `{corrupt}` string" if corrupt else "")
    reading = {"multiLine": "true", "escape": '"', **options}
    found = records(spark, path)
    fields = F.from_csv("record", F.lit(text), {"multiLine": "true", "escape": '"'})
    wanted = F.lit(",".join(names).lower())
    header = F.lower(F.concat_ws(",", *[fields[name] for name in names]))
    fine = F.when(header == wanted, False).otherwise(
        F.raise_error(F.concat(F.lit(f"a file has another header than {names}: "), F.col("record"))).cast("boolean")
    )
    rows = found.where(F.when(F.col("is_header"), fine).otherwise(True))
    if corrupt:
        reading["columnNameOfCorruptRecord"] = corrupt
    return rows.select(F.from_csv("record", F.lit(kinds), reading).alias("_row")).select("_row.*")
