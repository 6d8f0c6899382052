"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.functions.arrays import size0


def rich_profiles(df: DataFrame, **more_than: int) -> DataFrame:
    """Rows whose array columns each hold more items than asked."""
    for column, n in more_than.items():
        df = df.filter(size0(F.col(column)) > n)
    return df


def with_all_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.dropna(subset=list(columns))


def for_company(df: DataFrame, name: str, column: str = "company_name") -> DataFrame:
    """Rows of one company; the test reaches the Parquet scan."""
    return df.filter(F.col(column) == name)
