"""The operators over the supplied tables: name -> function of session and folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillflow.llm import (
    bitplane,
    chunking,
    exact,
    jaccard,
    langid,
    licenses,
    mixing,
    outliers,
    packing,
    resampling,
    vafile,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_importance_resampling(spark, folder):
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op2_warc_chunks(spark, folder):
    return warc.round_trip(spark, table(spark, folder, "pages"))


@query
def op3_gear_chunks(spark, folder):
    return chunking.deduplicated(table(spark, folder, "documents"))


@query
def op4_bit_planes(spark, folder):
    docs = table(spark, folder, "documents")
    return bitplane.round_trip(spark, docs, vocabulary("byte_bpe_50k.json"))


@query
def op5_sum_of_squares(spark, folder):
    return packing.pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op6_robust_outliers(spark, folder):
    return outliers.rate(table(spark, folder, "documents"))


@query
def op7_jaccard_join(spark, folder):
    return jaccard.components(table(spark, folder, "documents"))


@query
def op8_golden_ratio_mix(spark, folder):
    return mixing.mix(table(spark, folder, "documents"))


@query
def op9_kneser_ney(spark, folder):
    return langid.identify(table(spark, folder, "documents"))


@query
def op10_exact_dedup(spark, folder):
    return exact.find_copies(table(spark, folder, "documents"))


@query
def op11_chebyshev_whitening(spark, folder):
    return whitening.whitened_components(table(spark, folder, "embeddings"))


@query
def op12_license_scan(spark, folder):
    return licenses.scan_licenses(table(spark, folder, "documents"))


@query
def op13_va_file(spark, folder):
    return vafile.clustered(table(spark, folder, "embeddings"))
