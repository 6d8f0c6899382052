"""Aggregates per group and whole-group values put next to each row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fitlens.functions.arrays import flags_to_names
from fitlens.functions.text import md5_number
from fitlens.operators.joins import null_safe_join

CHUNK = 10_000


def ids_by(df: DataFrame, key: str, value: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """Distinct values per key as sorted lists of about ``chunk`` items at most.

    A key with more values gets several rows, numbered by ``part``; values are dealt to the
    parts by hash. A key with up to ``chunk`` values has the single part 0.
    """
    pairs = df.select(key, value).dropna(subset=[value]).distinct()
    sizes = pairs.groupBy(key).agg(F.ceil(F.count("*") / F.lit(chunk)).alias("_parts"))
    dealt = null_safe_join(pairs, sizes, [key]).withColumn("part", md5_number(F.col(value)) % F.col("_parts"))
    return dealt.groupBy(key, "part").agg(F.sort_array(F.collect_list(value)).alias(out))


def pack_rows(df: DataFrame, key: str, out: str, chunk: int = CHUNK) -> DataFrame:
    """All rows of each key as structs with all their columns, ``(key, part, out)``.

    A key with more than ``chunk`` rows gets several parts of about that size; rows are dealt to them by hash, equal rows in turn, so
    a part stays small however large a key is and however often a row repeats. Rows of a part are in order.
    """
    same = df.select(F.struct("*").alias("_row")).groupBy("_row").agg(F.count("*").alias("_n"))
    sizes = df.groupBy(key).agg(F.ceil(F.count("*") / F.lit(chunk)).alias("_parts"))
    dealt = null_safe_join(same.select(F.col(f"_row.{key}").alias(key), "_row", "_n"), sizes, [key])
    first = F.xxhash64("_row")
    copies = dealt.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_copy"))
    placed = copies.withColumn("part", F.pmod(first + F.col("_copy"), F.col("_parts")))
    return placed.groupBy(key, "part").agg(F.sort_array(F.collect_list("_row")).alias(out))


def counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def eligible(bridge: DataFrame, n: int, key: str = "company_name", member: str = "id") -> DataFrame:
    """Keys with at least ``n`` distinct members, and how many there are."""
    return (
        bridge.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count_distinct(member).alias("n_members"))
        .filter(F.col("n_members") >= n)
    )


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order. Each task keeps one row per key before the shuffle."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(first)).filter("_row = 1").drop("_row")


def moments(df: DataFrame, key: str, x: str) -> DataFrame:
    """Count, mean and sample variance per key and over all rows (``is_all`` = 1), in one scan."""
    return (
        df.rollup(key)
        .agg(
            F.grouping(key).cast("int").alias("is_all"),
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            F.var_samp(x).alias("variance"),
        )
    )


def beside(df: DataFrame, part: str, aggregates: Sequence[Column]) -> DataFrame:
    """Put aggregates over each partition next to its rows, as an unordered window would.

    The rows are summed up per key first and the result is joined back, so no partition has to
    fit one task. How the two sides meet is chosen at run time by the size of the sums.
    """
    return null_safe_join(df, df.groupBy(part).agg(*aggregates), [part])


def collect_over(df: DataFrame, part: str, x: str, domain: Sequence[str], out: str) -> DataFrame:
    """Distinct values of ``x`` over each partition next to its rows.

    The values come from a known finite ``domain``, so the state per partition is one flag each.
    """
    flags = [(name, F.coalesce(F.bool_or(F.col(x) == name), F.lit(False))) for name in sorted(domain)]
    return beside(df, part, [flags_to_names(flags).alias(out)])


def pct_over(df: DataFrame, part: str, flags: Mapping[str, str]) -> DataFrame:
    """Percentage of rows with each flag set, per partition; ``flags`` maps output to flag."""
    return beside(df, part, [(F.avg(flag) * 100).alias(out) for out, flag in flags.items()])


def moments_over(df: DataFrame, part: str, x: str, mean: str, variance: str) -> DataFrame:
    return beside(df, part, [F.avg(x).alias(mean), F.var_samp(x).alias(variance)])


def cond_counts_over(df: DataFrame, part: str, conditions: Mapping[str, Column]) -> DataFrame:
    return beside(df, part, [F.count_if(test).alias(out) for out, test in conditions.items()])
