"""Approximate nearest neighbours by inner product: probed lists, scanned with adaptive dimensions.

Vectors get one more coordinate that gives all the same length, so the largest inner product is the smallest distance. A random
rotation spreads the distance evenly over the columns; then the distance in the first columns estimates the whole, and a
hypothesis test drops a candidate as soon as the part seen is too large for the query's nearest so far. The first block of
columns is one matrix product for all candidates, later blocks are looked at only for the survivors.

Equal vectors are one class, whatever their number: no more of a class than its smallest ids can be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fitlens.llm.registry import query, table
from fitlens.session import stored

# The index is fitted on so many classes of equal vectors at most: those with the smallest hash.
SAMPLE = 20_000
# Lists by the number of classes, and the share of them that a query probes. Without structure in the vectors (random
# directions in 64 dimensions) recall needs this share; for clustered vectors a smaller one will do.
LEAST_LISTS, MOST_LISTS, PROBED = 32, 512, 0.85
# Rows of a list, and queries, that meet in one task at a time.
BLOCK, QUERIES_AT_ONCE, CHUNK = 1024, 1024, 512
# Columns of the first block and of the later ones; strictness of the test.
FIRST, LATER, EPSILON = 32, 16, 2.1
SPARE = 20


def usable(vec: Column) -> Column:
    """All components finite, and not all zero."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


class Index:
    """Centres of lists and the rotation, for vectors of length at most ``norm``."""

    def __init__(self, sample: np.ndarray, lists: int, norm: float, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.norm = norm
        width = sample.shape[1] + 1
        self.rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
        points = self.lengthened(sample)
        centres = points[rng.choice(len(points), min(lists, len(points)), replace=False)]
        for _ in range(10):
            near = self._nearest(points, centres)
            counts = np.bincount(near, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, near, points)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        self.centres = centres

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that makes them as long as the longest."""
        return np.concatenate([x, np.sqrt(np.maximum(0, self.norm**2 - (x**2).sum(1, keepdims=True)))], 1)

    @staticmethod
    def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return (points @ centres.T - 0.5 * (centres**2).sum(1)).argmax(1)

    def list_of(self, x: np.ndarray) -> np.ndarray:
        return self._nearest(self.lengthened(x), self.centres)

    def probes(self, q: np.ndarray, n: int, sizes: np.ndarray, needed: np.ndarray) -> list[np.ndarray]:
        """The n lists nearest to each query, as one that is as long as it is, without the added coordinate; more of them until
        their sizes add up to what the query needs."""
        points = np.concatenate([q, np.zeros((len(q), 1))], 1)
        order = np.argsort(-(points @ self.centres.T - 0.5 * (self.centres**2).sum(1)), 1, kind="stable")
        enough = (sizes[order].cumsum(1) < needed[:, None]).sum(1) + 1
        return [lists[: max(n, m)] for lists, m in zip(order, enough)]

    def scan(self, queries: np.ndarray, vectors: np.ndarray, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query its place and the places of the nearest vectors, ``keep`` at least if there are as many."""
        width = len(self.rotation)
        q = (np.concatenate([queries, np.zeros((len(queries), 1))], 1) @ self.rotation).astype(np.float32)
        v = (self.lengthened(vectors) @ self.rotation).astype(np.float32)
        steps = [0, *range(min(FIRST, width), width, LATER), width]
        limit = np.full(len(q), np.inf, np.float32)
        best_d = np.full((len(q), keep), np.inf, np.float32)
        best_i = np.full((len(q), keep), -1)
        for start in range(0, len(v), CHUNK):
            part = v[start : start + CHUNK]
            a, b = q[:, : steps[1]], part[:, : steps[1]]
            seen = (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * (a @ b.T)
            rows, columns = np.nonzero(seen <= self._bound(limit, steps[1], width)[:, None])
            d = seen[rows, columns]
            for low, high in zip(steps[1:], steps[2:]):
                gap = q[rows, low:high] - part[columns, low:high]
                d += np.einsum("ij,ij->i", gap, gap)
                alive = d <= self._bound(limit, high, width)[rows]
                rows, columns, d = rows[alive], columns[alive], d[alive]
            # The survivors, and the nearest so far, of each query side by side.
            counts = np.bincount(rows, minlength=len(q))
            most = counts.max(initial=0)
            if not most:
                continue
            place = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
            new_d = np.full((len(q), most), np.inf, np.float32)
            new_i = np.full((len(q), most), -1)
            new_d[rows, place], new_i[rows, place] = d, columns + start
            all_d, all_i = np.concatenate([best_d, new_d], 1), np.concatenate([best_i, new_i], 1)
            order = np.argpartition(all_d, keep - 1, 1)[:, :keep]
            best_d, best_i = np.take_along_axis(all_d, order, 1), np.take_along_axis(all_i, order, 1)
            limit = best_d.max(1)
        for i in range(len(q)):
            yield i, best_i[i][best_i[i] >= 0]

    @staticmethod
    def _bound(limit: np.ndarray, seen: int, width: int) -> np.ndarray:
        """Most that a distance in ``seen`` columns may be; of all columns the limit itself, with room for rounding."""
        share = 1.0 if seen == width else seen / width * (1 + EPSILON / seen**0.5) ** 2
        return (limit * np.float32(share) + np.float32(1e-5)).astype(np.float32)


def nearest_neighbours(
    vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id", vec: str = "embedding", probed: float = PROBED
) -> DataFrame:
    """``(query_id, rank, key, score)``: for each row whose id is divisible by ``every`` its k nearest others.

    score: inner product of the given vectors in double precision. Nearest first, equal scores by id. Rows with a null id, and
    vectors that are null, zero or have components that are null or not finite, take no part; nor do vectors of another length
    than most (of equally many the shorter). Rows of one id are the query's own, and are one candidate if their vectors are
    equal. Extra columns do not matter.
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    rows = stored(rows.filter(F.col("id").isNotNull() & usable(F.col("vec"))))
    schema = f"query_id long, rank int, `{key}` long, score double"
    width = rows.groupBy(F.size("vec").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    if width is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.filter(F.size("vec") == width["width"])
    # Classes of equal vectors with the ids that can be among the nearest: k, and the query's own. Spark keeps that many rows
    # of a class in every task before the shuffle.
    # Rows that repeat are one before that, so that none of them fills a class or a task.
    by_vec = Window.partitionBy("vec").orderBy("id")
    few = rows.distinct().withColumn("place", F.row_number().over(by_vec)).filter(F.col("place") <= k + 1)
    classes = stored(few.groupBy("vec").agg(F.array_sort(F.collect_set("id")).alias("ids")).select(F.get("ids", F.lit(0)).alias("rep"), "vec", "ids").withColumn("class", F.xxhash64("vec")))
    facts = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)).alias("square")).first()
    lists = int(min(MOST_LISTS, max(LEAST_LISTS, facts["n"] ** 0.5 / 8)))
    sample = classes.orderBy("class", "rep").limit(SAMPLE).select("vec").toPandas()["vec"]
    index = Index(np.array(sample.tolist(), float), lists, facts["square"] ** 0.5)
    probes = max(1, round(probed * len(index.centres)))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(list=index.list_of(np.array(batch["vec"].tolist(), float)))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                needed = batch["own"].to_numpy() + k
                yield batch.assign(lists=index.probes(np.array(batch["vec"].tolist(), float), probes, ids_of, needed)).drop(columns="own")

    listed = stored(classes.select("rep", "vec", "ids").mapInPandas(assign, "rep long, vec array<double>, ids array<long>, list long"))
    asked = rows.filter(F.col("id") % every == 0).select("id", "vec").distinct()
    # Every query with the class of its vector.
    mine = stored(asked.join(classes.select("vec", "rep"), "vec").select("id", "rep"))
    # A query needs k candidates besides its own vectors, if there are as many.
    ids_of = np.zeros(len(index.centres))
    for row in listed.groupBy("list").agg(F.sum(F.size("ids")).alias("n")).collect():  # at most MOST_LISTS rows
        ids_of[row["list"]] = row["n"]
    own = mine.join(asked.groupBy("id").agg(F.count("*").alias("own")), "id").groupBy("rep").agg(F.max("own").alias("own"))
    asking = classes.select("rep", "vec").join(own, "rep")
    probing = asking.mapInPandas(probe, "rep long, vec array<double>, lists array<long>").select("rep", "vec", F.explode("lists").alias("list"))
    probing = stored(probing)
    # A list is cut into blocks of rows and of queries, and every block of the one meets every block of the other.
    blocks = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
    sizes = listed.groupBy("list").agg(blocks(F.count("*"), BLOCK).alias("rows")).join(
        probing.groupBy("list").agg(blocks(F.count("*"), QUERIES_AT_ONCE).alias("queries")), "list"
    )
    sizes = F.broadcast(sizes)  # one row for each of at most MOST_LISTS lists
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every_part = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = probing.join(sizes, "list").select("list", part("queries").alias("query_part"), every_part("rows").alias("row_part"), "rep", "vec")
    right = listed.join(sizes, "list").select("list", every_part("queries").alias("query_part"), part("rows").alias("row_part"), "rep", "vec", "ids")
    cell = ["list", "query_part", "row_part"]

    def scan(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"rep": pd.Series(dtype="int64"), "near": pd.Series(dtype=object)})
        q, v = np.array(queries["vec"].tolist(), float), np.array(found["vec"].tolist(), float)
        ids = found["ids"].tolist()
        out = []
        for i, places in index.scan(q, v, k + 1 + SPARE):
            scores = (v[places] * q[i]).sum(1)
            near = sorted((-s, int(x)) for s, p in zip(scores.tolist(), places.tolist()) for x in ids[p])[: k + 1]
            out.append([{"score": -s, "id": x} for s, x in near])
        return pd.DataFrame({"rep": queries["rep"], "near": out})

    near = left.groupBy(cell).cogroup(right.groupBy(cell)).applyInPandas(scan, "rep long, near array<struct<score:double,id:long>>")
    best = near.select("rep", F.inline("near"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy(F.desc("score"), "id"))
    best = best.withColumn("place", place).filter(F.col("place") <= k + 1)
    best = best.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("place", "score", "id"))).alias("near"))
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("query")), 1, k)
    answers = mine.withColumnRenamed("id", "query").join(best, "rep").select("query", F.posexplode(others).alias("rank", "x"))
    return answers.select(F.col("query").alias("query_id"), (F.col("rank") + 1).alias("rank"), F.col("x.id").alias(key), F.col("x.score").alias("score"))


@query("op2_adaptive_scan")
def op2_adaptive_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest others of every twentieth vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
