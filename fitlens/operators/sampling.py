"""Random rows per group, the same on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fitlens.functions.text import md5_number
from fitlens.operators.joins import null_safe_join
from fitlens.operators.positions import BUCKETS, bucket_positions, hash_positions
from fitlens.session import stored


def sample_per_group(df: DataFrame, key: str, id_col: str, limit_col: str, seed: int, buckets: int = BUCKETS) -> DataFrame:
    """As many rows per key as ``limit_col`` says (one number for a key), picked by seeded hash order.

    The order is ``md5(seed | id)``, then the id. Rows are counted by key and hash bucket; the counts tell in which bucket the limit
    of a key falls. Rows below it are taken and rows beyond it left before anything is shuffled; only the rows of that one bucket,
    one in ``buckets`` of a key, are put in order. Keys with a null limit give no rows. Rows that share an id are next to each other
    in the order; which of them are taken, if not all, is arbitrary but their number is not.
    """
    # The first 52 bits of the digest are a number that keeps its order.
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
    bucket = F.floor(F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") * F.lit(buckets / 2**52))
    marked = df.withColumn("_bucket", bucket)
    counts = marked.groupBy(key, "_bucket").agg(F.count("*").alias("_n"), F.max(limit_col).alias("_limit"))
    upto = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select(key, "_bucket", "_n", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.max("_limit").over(Window.partitionBy(key)).alias("_limit"))
    # One row for each key: the first bucket that cannot be taken whole, and how many of its rows are wanted.
    cut = F.min(F.when(F.col("_before") + F.col("_n") > F.col("_limit"), F.struct(F.col("_bucket").alias("at"), (F.col("_limit") - F.col("_before")).alias("rest"))))
    cuts = sums.filter("_limit IS NOT NULL").groupBy(key).agg(cut.alias("_cut"))
    met = null_safe_join(marked, cuts, [key])
    own = df.columns
    whole = met.filter("_cut IS NULL OR _bucket < _cut.at").select(*own)
    edge = met.filter("_bucket = _cut.at AND _cut.rest > 0").withColumn("_digest", digest)
    place = F.row_number().over(Window.partitionBy(key).orderBy("_digest", id_col))
    return whole.union(edge.withColumn("_place", place).filter("_place <= _cut.rest").select(*own))


def negatives(positives: DataFrame, key: str, id_col: str, seed: int) -> DataFrame:
    """Per key, as many members of other keys as it has members, drawn at random.

    All members are shuffled once into a circle. A key starts at a place of its own and takes
    the first ``n`` members on the circle that are not its own; of ``2 n`` places in a row at
    most ``n`` are its own, so ``2 n`` places (or the whole circle) always suffice. Each member
    row of a key brings in two of these places, so the work is linear in the rows, a large key
    is spread over all tasks, and the pairs of all members with all keys are never formed.
    """
    own = stored(positives.select(key, id_col).distinct())
    circle = hash_positions(own.select(id_col).distinct(), [], [id_col], seed, "_place")
    around = own.agg(F.count_distinct(id_col)).scalar()
    numbered = hash_positions(own, [key], [id_col], seed, "_r", "_n")
    steps = (
        numbered.select(key, "_n", F.explode(F.array(F.col("_r"), F.col("_r") + F.col("_n"))).alias("_step"))
        .withColumn("_all", around)
        .filter(F.col("_step") < F.col("_all"))
    )
    start = md5_number(F.lit(str(seed)), F.col(key)) % F.col("_all")
    drawn = steps.withColumn("_place", (start + F.col("_step")) % F.col("_all")).join(circle, "_place")
    others = drawn.join(own, [key, id_col], "left_anti")
    bucket = F.floor(F.col("_step") * F.lit(BUCKETS) / (F.col("_n") * 2))
    first = bucket_positions(others, [key], bucket, [F.col("_step")], "_pos")
    return first.filter(F.col("_pos") < F.col("_n")).select(key, id_col)
