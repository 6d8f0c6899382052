"""Top rows and ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitlens.constants import ALPHA


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows per key. The literal limit lets each task drop the rest before the shuffle."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(by)).filter(F.col(rank) <= k)


def top_per_section(
    df: DataFrame, keys: Sequence[str], section: str, order: Sequence[Column | str], limits: Mapping[str, int]
) -> DataFrame:
    """First rows per key and section, each section with its own limit."""
    ranked = top_per_group(df, [*keys, section], order, max(limits.values()))
    allowed = F.lit(0)
    for name, k in limits.items():
        allowed = F.when(F.col(section) == name, k).otherwise(allowed)
    return ranked.filter(F.col("rank") <= allowed)


def rank_features(tests: DataFrame, alpha: float = ALPHA, only_higher: bool = False, key: str = "company_name") -> DataFrame:
    """Significant features per company, the smallest p-value first.

    Rows that bring ``log_p`` are ranked by it: p-values of strong traits are all zero, their logarithms are not.
    A company has as many rows as there are tests, so its window is bounded.
    """
    hits = tests.filter(F.col("p_value") < alpha)
    if only_higher:
        hits = hits.filter(F.col("direction") == 1)
    by_p = Window.partitionBy(key).orderBy("log_p" if "log_p" in tests.columns else "p_value", "feature")
    return hits.withColumn("rank", F.row_number().over(by_p))


def known_sources_first(matches: DataFrame, keys: Sequence[str], sources: Sequence[str], item: str) -> DataFrame:
    """Rank the matches of each pair by the number of known sources, then by item.

    A pair has at most one match per core value, so its window is bounded.
    """
    known = sum((F.col(s).isNotNull().cast("int") for s in sources), F.lit(0))
    by_known = Window.partitionBy(*keys).orderBy(F.desc("known"), item)
    return matches.withColumn("known", known).withColumn("rank", F.row_number().over(by_known))
