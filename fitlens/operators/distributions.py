"""Counts per category, histograms and densities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.constants import HISTOGRAM_BINS
from fitlens.session import stored


def category_counts(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """Rows per category with the place of the category in ``order``; others come last."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(c) for c in order]), F.col(column)), F.lit(0)), F.lit(len(order) + 1))
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.withColumn("place", place.cast("int"))


def histogram(df: DataFrame, x: str, bins: int = HISTOGRAM_BINS, lo: float = 0.0, hi: float = 300.0) -> DataFrame:
    """Equal-width bins over the range of the data; those that reach into ``lo``…``hi`` are shown.

    The last bin holds its right edge. Empty bins are kept.
    """
    values = df.select(F.col(x).cast("double").alias("x")).filter("x is not null")
    ends = values.agg(F.struct(F.min("x").alias("a"), F.max("x").alias("b"))).scalar()
    a, b = ends["a"], ends["b"]
    place = F.coalesce(F.floor(F.try_divide((F.col("x") - a) * bins, b - a)), F.lit(0))
    counted = values.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"))
    edges = df.sparkSession.range(bins).select(
        F.col("id").alias("bin"),
        (a + (b - a) * F.col("id") / bins).alias("left"),
        (a + (b - a) * (F.col("id") + 1) / bins).alias("right"),
    )
    shown = edges.filter((F.col("left") <= hi) & (F.col("right") >= lo))
    return shown.join(counted, "bin", "left").select("bin", "left", "right", F.coalesce("n", F.lit(0)).alias("n"))


def density(df: DataFrame, key: str, x: str, grid: Sequence[float]) -> DataFrame:
    """Gaussian density of ``x`` on a grid per key and over all rows (key NULL, ``is_all`` = 1).

    The bandwidth is Scott's, ``n^(-1/5) s``; groups without spread are left out. Equal values
    are counted once and each grid point is a map-side sum, so no group meets in one task. Squares
    are taken about the mean of the group, so that large values do not cancel out.
    """
    values = df.select(F.col(key).alias("k"), F.col(x).cast("double").alias("x")).filter("x is not null and k is not null")
    values = stored(values.groupBy("k", "x").agg(F.count("*").alias("c")))
    n, mean = F.sum("c").alias("n"), (F.sum(F.col("c") * F.col("x")) / F.sum("c")).alias("mean")
    squares = F.sum(F.col("c") * F.pow(F.col("x") - F.col("mean"), F.lit(2.0)))
    width = F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.sqrt(squares / (F.col("n") - 1))
    centres = values.groupBy("k").agg(n, mean, F.min("x").alias("lo"), F.max("x").alias("hi")).filter("lo < hi")
    per_key = values.join(centres, "k").groupBy("k", "n").agg(width.alias("bw"))
    whole = values.groupBy("x").agg(F.sum("c").alias("c"))
    centre = values.agg(F.struct(n, mean, F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    centred = whole.select("x", "c", centre["n"].alias("n"), centre["mean"].alias("mean")).filter(centre["lo"] < centre["hi"])
    bandwidth = centred.groupBy("n").agg(width.alias("bw")).select(F.struct("n", "bw")).scalar()
    points = F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("point")

    def curve(rows: DataFrame) -> DataFrame:
        u = (F.col("point") - F.col("x")) / F.col("bw")
        kernel = F.col("c") * F.exp(u * u * -0.5) / (F.col("n") * F.col("bw") * F.sqrt(F.lit(2.0) * F.pi()))
        return rows.select("is_all", "k", "x", "c", "n", "bw", points).groupBy("is_all", "k", "point").agg(F.sum(kernel).alias("density"))

    one = values.join(per_key, "k").withColumn("is_all", F.lit(0))
    everybody = whole.withColumns(
        {"is_all": F.lit(1), "k": F.lit(None).cast(df.schema[key].dataType), "n": bandwidth["n"], "bw": bandwidth["bw"]}
    ).filter("bw is not null")
    return curve(one).unionByName(curve(everybody)).withColumnRenamed("k", key)
