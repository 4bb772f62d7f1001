"""Accident GeoJSON scans.

``document_features`` parses a document, one JSON value, in one task and spreads the features at once.
``split_features`` lets many tasks read one file, whatever its layout.  Both number features by their position among all
elements of the array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.functions.payload import is_object
from tarmac.sources.json_blocks import array_elements

_FEATURES = "features array<variant>"


def features_of(document: Column) -> Column:
    """Feature array of a document; a wrapping array stands for its first element.

    Features become one VARIANT each: a VARIANT of the whole document would hit the type's size limit.
    """
    plain = F.from_json(document, _FEATURES)["features"]
    wrapped = F.get(F.from_json(document, f"array<struct<{_FEATURES.replace(' ', ':', 1)}>>"), F.lit(0))
    mixed = F.get(F.from_json(document, "array<variant>"), F.lit(0))
    mixed_features = F.try_variant_get(mixed, "$.features", "array<variant>")
    in_array = F.ltrim(document).startswith("[")
    return F.when(in_array, F.coalesce(wrapped["features"], mixed_features)).otherwise(plain)


def explode_features(documents: DataFrame, document: str, *keep: str) -> DataFrame:
    """One row per object feature with its position; other elements and shapes give no row."""
    return documents.select(
        *keep, F.posexplode(features_of(F.col(document))).alias("ordinal", "payload")
    ).where(is_object(F.col("payload"))).withColumn("ordinal", F.col("ordinal").cast("bigint"))


def document_features(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, ordinal, payload`` of whole-document files, spread over tasks after the parse."""
    documents = spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("document")
    )
    return explode_features(documents, "document", "path").hint("rebalance")


def split_features(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, ordinal, payload`` of files of any layout, each read by as many tasks as it has blocks.

    An element that does not parse stops the job, so no feature is ever passed over.
    """
    broken = F.raise_error(F.concat(F.lit("unreadable feature in "), F.col("path"))).cast("variant")
    payload = F.coalesce(F.try_parse_json("text"), broken)
    return array_elements(spark, paths, "features").select("path", "ordinal", payload.alias("payload")).where(
        is_object(F.col("payload"))
    )
