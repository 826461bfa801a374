"""What is in each table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, count``, counted when the result is read."""
    counts = [
        df.agg(F.count("*").alias("count")).select(F.lit(name).alias("table"), "count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def table_schemas(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, position, column, type, filled``: the schema and the non-null values."""

    def columns(name: str, df: DataFrame) -> DataFrame:
        filled = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
        lines = [
            F.struct(
                F.lit(name).alias("table"),
                F.lit(i + 1).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col(f"_{i}").alias("filled"),
            )
            for i, field in enumerate(df.schema.fields)
        ]
        return filled.select(F.inline(F.array(*lines)))

    return reduce(DataFrame.unionAll, [columns(name, df) for name, df in tables.items()])
