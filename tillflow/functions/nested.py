"""JSON text and the nested ``items`` array."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_json(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Replace JSON text columns by typed ones; malformed text gives NULL."""
    return df.withColumns({name: F.from_json(name, kind) for name, kind in types.items()})


def item_rows(df: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per array element with every item field; no row for NULL or empty arrays."""
    return df.select(*keep, F.inline("items"))


def each_item(df: DataFrame, fields: list[str], *keep: Column | str) -> DataFrame:
    """As ``item_rows``, for some item fields only.

    Zipping the wanted fields lets a columnar scan skip the other ones; a plain
    explode of the array reads them all.
    """
    return df.select(*keep, F.inline(F.arrays_zip(*[F.col(f"items.{f}") for f in fields])))
