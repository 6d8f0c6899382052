"""Joins on keys that may be heavily skewed.

No join carries a hint. Rule tables are literal relations of known size, so the planner's own
size threshold broadcasts them; large sides meet in a sort-merge join that adaptive execution
splits where one key holds too many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal names where NULL meets NULL; the names of the left side stay."""
    renamed = right.withColumnsRenamed({n: f"__{n}" for n in names})
    on = F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"__{n}"))
    return left.join(renamed, on, how).drop(*[f"__{n}" for n in names])


def attach(df: DataFrame, extra: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join that adds the columns of a table with unique keys."""
    return df.join(extra, on, "left")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(key).alias("n")).filter("n > 1")


def drop_ambiguous(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs once (or is NULL)."""
    return df.join(repeated_keys(df, key).select(key), key, "left_anti")


def ambiguous_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs more than once."""
    return df.join(repeated_keys(df, key).select(key), key, "left_semi")


def bridge_full_outer(current: DataFrame, past: DataFrame) -> DataFrame:
    """Distinct ``(company_name, id)`` of two tables by a full outer join.

    The pair is the join key, so a large employer spreads over all tasks and no list of
    employees is built. The flags tell which side knew the pair.
    """
    a = current.dropna(subset=["company_name"]).distinct().withColumn("is_current", F.lit(1))
    b = past.dropna(subset=["company_name"]).distinct().withColumn("is_past", F.lit(1))
    return a.join(b, ["company_name", "id"], "full_outer").select(
        "company_name",
        "id",
        F.coalesce("is_current", F.lit(0)).alias("is_current"),
        F.coalesce("is_past", F.lit(0)).alias("is_past"),
    )
