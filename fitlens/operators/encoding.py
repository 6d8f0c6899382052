"""Features as numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.functions.text import degree_code
from fitlens.operators.positions import global_positions

FEATURES = [
    "top_university", "volunteering", "average_months_of_experience", "degree_feature", "organization_types_feature",
]


def string_index(df: DataFrame, column: str, out: str, nulls: str = "keep") -> DataFrame:
    """Index of each string, the most frequent first and ties in alphabetical order.

    NULL has the index after all strings, or with ``nulls="skip"`` its rows are dropped. The distinct strings are
    sorted by ranges, so neither the driver nor one task holds them all: only the sizes of the ranges are summed up in one place.
    """
    seen = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    order = [F.desc("_n"), F.col(column)]
    placed = global_positions(seen.select(column, "_n"), order, "_place")
    index = placed.select(F.col(column).alias("_string"), F.col("_place").cast("double").alias(out))
    if nulls == "skip":
        return df.join(index, F.col(column) == F.col("_string")).drop("_string")
    last = index.agg(F.count("*").cast("double").alias("n")).scalar()
    joined = df.join(index, F.col(column) == F.col("_string"), "left").drop("_string")
    return joined.withColumn(out, F.coalesce(out, last))


def encode(df: DataFrame) -> DataFrame:
    """Fill unknown tenure with -1, number the degrees and index the organisation types."""
    coded = df.withColumn("degree_feature", degree_code(F.col("degree"))).fillna(
        -1, subset=["average_months_of_experience"]
    )
    return string_index(coded, "organization_types", "organization_types_feature")


def assemble(df: DataFrame, features: Sequence[str] = FEATURES, out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)
