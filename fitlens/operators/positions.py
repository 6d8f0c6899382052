"""Row positions and running sums that split a hot group over many tasks.

A plain ``row_number`` over a key puts all rows of that key in one task. Here each group is
cut into ordered buckets first. Buckets are counted with a map-side aggregate, their totals
are summed up over the few buckets of a group, and only rows of one bucket share a window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fitlens.operators.joins import null_safe_join
from fitlens.session import stored

BUCKETS = 4096
# Rows of a bucket of running sums, such buckets of a group at most, and accuracy of the sketches that cut them.
SHARE, BUCKETS_OF_SUMS, SKETCH = 10_000, 256, 10_000


def bucket_positions(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column],
    out: str = "pos",
    size: str | None = None,
) -> DataFrame:
    """0-based place of each row in its group; ``bucket`` must not decrease along ``order``.

    ``size`` names an optional column with the number of rows of the group.
    """
    group = [*keys, "_bucket"]
    marked = df.withColumn("_bucket", bucket)
    counts = marked.groupBy(*group).agg(F.count("*").alias("_rows"))
    over_group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = over_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *group,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(over_group).alias("_size"),
    )
    within = Window.partitionBy(*group).orderBy(*order)
    ranked = marked.withColumn("_row", F.row_number().over(within))
    placed = null_safe_join(ranked, starts, group).withColumn(out, F.col("_start") + F.col("_row") - 1)
    if size:
        placed = placed.withColumn(size, F.col("_size"))
    return placed.drop("_bucket", "_row", "_start", "_size")


def hash_positions(
    df: DataFrame,
    keys: Sequence[str],
    ids: Sequence[str],
    seed: int,
    out: str = "pos",
    size: str | None = None,
    digits: int = 3,
) -> DataFrame:
    """Place of each row when its group is shuffled by ``md5(seed | ids)``.

    The order is fixed by the seed and the ids (which must be unique in the group), so a
    task that runs again gives the same rows. Hash prefixes make even buckets by nature.
    """
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]))
    placed = bucket_positions(
        df.withColumn("_hash", digest),
        keys,
        F.substring("_hash", 1, digits),
        [F.col("_hash"), *[F.col(c) for c in ids]],
        out,
        size,
    )
    return placed.drop("_hash")


def running_sums(
    df: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str], share: int = SHARE, most: int = BUCKETS_OF_SUMS
) -> DataFrame:
    """Add ``run_<c>`` (sum up to and with the row) and ``all_<c>`` for each summed column.

    ``order`` must be numeric and unique within the group, NULL comes first. A group is cut at quantiles of ``order``, from sketches
    that merge on the map side, into a bucket for each ``share`` rows and at most ``most``. So buckets are even however the values
    lie, and a group of usual size has one.
    """
    cuts = F.percentile_approx(order, [i / most for i in range(1, most)], SKETCH).alias("_cuts")
    ends = df.groupBy(*keys).agg(cuts, F.least(F.lit(most), F.ceil(F.count("*") / F.lit(share))).alias("_buckets"))
    # Of the cuts that all groups have, as many are kept as part the group into its buckets.
    kept = F.filter("_cuts", lambda _, i: F.floor((i + 1) * F.col("_buckets") / most) > F.floor(i * F.col("_buckets") / most))
    ends = ends.select(*keys, F.array_distinct(F.coalesce(kept, F.array().cast("array<double>"))).alias("_cuts"))
    marked = null_safe_join(df, ends, keys).withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < F.col(order)))).drop("_cuts")
    group = [*keys, "_bucket"]
    totals = marked.groupBy(*group).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    over_group = Window.partitionBy(*keys)
    before = over_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *group,
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_s_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(over_group).alias(f"all_{c}") for c in sums],
    )
    within = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    run = marked.withColumns({f"_r_{c}": F.sum(c).over(within) for c in sums})
    out = null_safe_join(run, starts, group)
    out = out.withColumns({f"run_{c}": F.col(f"_s_{c}") + F.col(f"_r_{c}") for c in sums})
    return out.drop("_bucket", *[f"_{p}_{c}" for p in "sr" for c in sums])


def global_positions(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """The rows with their place, from 0, in a total order; the table is stored.

    Rows are sorted by ranges, so no task holds them all; only the sizes of the ranges, one row for each, are summed up in one
    place.
    """
    # The number of a row holds its range above bit 33 and its place in the range below.
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("__range", F.shiftright("_id", 33)).withColumn("__row", F.col("_id").bitwiseAND(2**33 - 1)).drop("_id")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("__range").agg(F.count("*").alias("__size"))
    starts = starts.select("__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    return placed.join(starts, "__range").withColumn(out, F.col("__start") + F.col("__row")).drop("__range", "__start", "__row")
