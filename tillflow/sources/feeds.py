"""CSV feeds with embedded JSON, and their typed (bronze) form.

A quoted field may span lines. Files of at most one split are read by Spark's own reader, one task each;
larger ones are cut into records in parallel (``records``). Schemas are given by name, which saves the
extra pass of type inference. ``checked`` gives the typed rows with what typing lost of each, and
``quarantined`` lists the lost values.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow import schemas
from tillflow.functions import from_micros, parse_json
from tillflow.session import shuffles_dropped
from tillflow.sources import quarantine, records

NULL_TEXT = "null"
ROWS_PER_FILE = 200_000
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def _fields(schema: str) -> dict[str, str]:
    """Names and types of a schema whose types hold no commas."""
    return {name.strip("`"): kind for name, kind in (f.split(None, 1) for f in schema.split(", "))}


def _header(spark: SparkSession, path: str | list[str], schema: str, **options) -> dict[str, str]:
    """The header's names in their order, each with its declared type, or text if it has none.

    A declared column that the header lacks is an error.
    """
    wanted = {name.lower(): kind for name, kind in _fields(schema).items()}
    names = spark.read.options(header=True, **options).csv(path).columns
    missing = [name for name in _fields(schema) if name.lower() not in {n.lower() for n in names}]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; its header is {', '.join(names)}")
    return {name: wanted.get(name.lower(), "string") for name in names}


def splittable(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether a file of ``path`` is larger than a split; only the listing is read."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", spark.conf.get(SPLIT_BYTES).lower()).groups()
    most = int(number) << 10 * " kmgt".index(unit or " ")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(F.col("length") > most).limit(1).count() > 0


def read_text(
    spark: SparkSession,
    path: str | list[str],
    names: list[str],
    null_text: str | None = NULL_TEXT,
    multi_line: bool = True,
    corrupt: str | None = None,
) -> DataFrame:
    """All columns of CSV files as text; ``names`` must be the header of every file.

    ``corrupt`` names a further column for the text of records with another number of fields.
    """
    nulls = {} if null_text is None else {"nullValue": null_text}
    if multi_line and splittable(spark, path):
        return records.parsed(spark, path, names, corrupt, **nulls)
    text = ", ".join(f"`{name}` string" for name in names)
    # Not enforced: the header of every file is compared with these names.
    reader = spark.read.options(header=True, enforceSchema=False, multiLine=multi_line, escape='"', **nulls)
    if corrupt:
        text += f", `{corrupt}` string"
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(text).csv(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: str | None,
    null_text: str | None = NULL_TEXT,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header, ``""`` for a quote inside quotes, and a text that means NULL.

    Columns are found by their name in the header, in any order and beside others, which are left
    out; all files of a path must have the same header. Text that does not fit its type is NULL.
    Without ``schema`` the types are inferred; ``null_text=None`` keeps such text.
    """
    options = {"multiLine": multi_line, "escape": '"'}
    nulls = {} if null_text is None else {"nullValue": null_text}
    if not schema:
        return spark.read.options(header=True, inferSchema=True, **options, **nulls).csv(path)
    names = _header(spark, path, schema, **options)
    columns = [F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in _fields(schema).items()]
    return read_text(spark, path, list(names), null_text, multi_line).select(*columns)


def read_feed(spark: SparkSession, folder: str, feed: str, multi_line: bool = True) -> DataFrame:
    """``multi_line=False`` lets Spark split large files; only for feeds without line breaks in fields."""
    return read_csv(spark, f"{folder}/{feed}.csv", schemas.FEEDS[feed], multi_line=multi_line)


def read_raw(
    spark: SparkSession, folder: str, feed: str, multi_line: bool = True, infer: bool = False
) -> DataFrame:
    """A feed as delivered: every column as text, and the text ``null`` kept.

    ``infer`` takes one more pass to give the columns types instead.
    """
    text = ", ".join(f"{name} string" for name in _fields(schemas.FEEDS[feed]))
    return read_csv(
        spark, f"{folder}/{feed}.csv", None if infer else text, null_text=None, multi_line=multi_line
    )


def csv_table(
    spark: SparkSession, name: str, path: str, schema: str, multi_line: bool = True
) -> DataFrame:
    """Declare a table over CSV files in SQL, its columns in the header's order, and read it."""
    options = {"multiLine": multi_line, "escape": '"'}
    names = _header(spark, path, schema, **options)
    columns = ", ".join(f"`{column}` {kind}" for column, kind in names.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv OPTIONS (path :path, header 'true', "
        f"multiLine '{str(multi_line).lower()}', escape '\"', enforceSchema 'false')",
        args={"path": path},
    )
    return spark.table(name)


def write_feed(
    df: DataFrame, folder: str, feed: str, rows_per_file: int = ROWS_PER_FILE, compression: str | None = None
) -> None:
    """Write a feed in the form ``read_feed`` reads, as files that one task each can read.

    Compressed files can't be split by readers.
    """
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
    with shuffles_dropped(df.sparkSession):
        writer.options(header=True, escape='"', nullValue=NULL_TEXT).csv(
            f"{folder}/{feed}.csv", compression=compression
        )


#: JSON columns and epoch columns of the feeds.
NESTED = {
    "events": {"items": schemas.ITEMS, "geo": schemas.GEO, "ecommerce": schemas.ECOMMERCE},
    "sales": {"items": schemas.ITEMS},
}
MOMENTS = {
    "events": ["event_timestamp", "event_previous_timestamp", "user_first_touch_timestamp"],
    "sales": ["transaction_timestamp"],
    "users": ["user_first_touch_timestamp"],
}


def typed_events(feed: DataFrame) -> DataFrame:
    return parse_json(feed, NESTED["events"]).withColumns({m: from_micros(m) for m in MOMENTS["events"]})


def typed_sales(feed: DataFrame) -> DataFrame:
    return parse_json(feed, NESTED["sales"]).withColumns({m: from_micros(m) for m in MOMENTS["sales"]})


def typed_users(feed: DataFrame) -> DataFrame:
    return feed.withColumns({m: from_micros(m) for m in MOMENTS["users"]})


def typed_products(feed: DataFrame) -> DataFrame:
    return feed


TYPED = {
    "users": typed_users,
    "products": typed_products,
    "sales": typed_sales,
    "events": typed_events,
}


def bronze(spark: SparkSession, folder: str, feed: str, multi_line: bool = True) -> DataFrame:
    """A typed feed straight from its CSV files."""
    return TYPED[feed](read_feed(spark, folder, feed, multi_line))


def _texts(
    spark: SparkSession, path: str | list[str], feed: str, multi_line: bool
) -> tuple[DataFrame, list[str]]:
    """A feed's declared columns as text, with the text of records that don't fit the header."""
    schema = schemas.FEEDS[feed]
    names = _header(spark, path, schema, multiLine=multi_line, escape='"')
    text = read_text(spark, path, list(names), multi_line=multi_line, corrupt=quarantine.CORRUPT)
    declared = list(_fields(schema))
    return text.select(*[F.col(f"`{n}`").alias(n) for n in declared], quarantine.CORRUPT), declared


def _lost(feed: str) -> Column:
    scalars = {n: kind for n, kind in _fields(schemas.FEEDS[feed]).items() if kind != "string"}
    return quarantine.lost_values(scalars, NESTED.get(feed, {}), MOMENTS.get(feed, []), quarantine.CORRUPT)


def checked(
    spark: SparkSession, folder: str, feed: str, multi_line: bool = True, files: list[str] | None = None
) -> DataFrame:
    """A typed feed, or some files of it, with the values of each row that were lost in ``_lost``."""
    text, _ = _texts(spark, files or f"{folder}/{feed}.csv", feed, multi_line)
    found = text.withColumn(quarantine.LOST, _lost(feed)).drop(quarantine.CORRUPT)
    kinds = {n: F.col(n).try_cast(kind) for n, kind in _fields(schemas.FEEDS[feed]).items() if kind != "string"}
    return TYPED[feed](found.withColumns(kinds) if kinds else found)


def quarantined(
    spark: SparkSession, folder: str, feed: str, multi_line: bool = True, files: list[str] | None = None
) -> DataFrame:
    """``source, column, raw, reason, record``: one row per value that ``checked`` loses."""
    text, names = _texts(spark, files or f"{folder}/{feed}.csv", feed, multi_line)
    return quarantine.lost_rows(text, _lost(feed), names, feed)
