"""Mean vectors, cosine matches and dominant vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.constants import COSINE_THRESHOLD, DOMINANT_VECTORS
from fitlens.session import drop_stored, stored, stored_in_files

# Vectors that cut space into cells, rows of a block, and scores and components of scored pairs in memory at once.
PIVOTS, BLOCK_ROWS, MAX_BLOCK_SCORES, MAX_COMPONENTS = 64, 2048, 1_000_000, 4_000_000
# Components of a block, blocks that are sorted by cell together, blocks in a file, blocks of either side in a task, and parts at least.
BLOCK_COMPONENTS, SORTED_BLOCKS, BLOCKS_IN_FILE, TASK_BLOCKS, LEAST_PARTS = 1 << 18, 16, 8, 48, 4


def mean_vector(df: DataFrame, key: str, vec: str, out: str = "mean") -> DataFrame:
    """Mean of the vectors of each key, summed up on the map side; NULL vectors do not count."""
    rows = df.filter(F.col(vec).isNotNull()).select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    return rows.groupBy(key).agg(Summarizer.mean(F.col("_v")).alias("_m")).select(key, vector_to_array("_m").alias(out))


def _components(lists: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length ``dim`` in the precision given, nulls as NaN, and where they stand; others are left out."""
    at = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(lists), dim), False).to_numpy(zero_copy_only=False))
    return lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim), at


def _unit(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and where they stand; zero and broken rows are left out."""
    block = block.astype(float)
    length = np.linalg.norm(block, axis=1)
    good = np.isfinite(length) & (length > 0)
    return (block[good].T / length[good]).T, np.flatnonzero(good)


def _angles(unit: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))


def _near_pairs(ours: np.ndarray, theirs: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places and cosines of the pairs of unit vectors above the threshold, scored a bounded number at a time.

    A product in single precision finds the candidates: the margin is twice what rounding can take away. Double precision decides.
    """
    step, pairs = max(1, MAX_BLOCK_SCORES // len(theirs)), max(1, MAX_COMPONENTS // ours.shape[1])
    x, y, least = ours.astype(np.float32), theirs.astype(np.float32), np.float32(threshold - (ours.shape[1] + 8) * 2.0**-23)
    for start in range(0, len(ours), step):
        near = np.flatnonzero(x[start : start + step] @ y.T > least)  # many times faster than places by row and column
        for at in range(0, len(near), pairs):
            a, b = np.divmod(near[at : at + pairs], len(theirs))
            a += start
            cosine = (ours[a] * theirs[b]).sum(1)
            above = cosine > threshold
            yield a[above], b[above], cosine[above]


def _sorted_blocks(batches: Iterator[pa.RecordBatch], centres: np.ndarray, size: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, components and angles to the pivots of at most ``size`` rows at a time, neighbours in space side by side."""

    def cut() -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        ids, block, angles = pa.concat_arrays([h[0] for h in held]), np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        order = np.argsort(angles.argmin(1), kind="stable")
        for start in range(0, len(order), size):
            at = order[start : start + size]
            yield ids.take(pa.array(at)), block[at], angles[at]

    held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
    for batch in batches:
        block, at = _components(batch.column(1), centres.shape[1])
        unit, good = _unit(block)
        if len(good):
            held.append((batch.column(0).take(pa.array(at[good])), block[good], _angles(unit, centres)))
        if sum(len(h[0]) for h in held) >= SORTED_BLOCKS * size:
            yield from cut()
            held = []
    if held:
        yield from cut()


def _in_reach(cells: np.ndarray, near: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Stretches of a block's rows with the places of the anchors they are compared with.

    ``cells`` has the cell of each row, in order, ``near`` the cells that each anchor reaches. A stretch is the rows of one cell, or
    all rows if most of the pairs are in reach anyway.
    """
    kinds, starts, counts = np.unique(cells, return_index=True, return_counts=True)
    reached = near[:, kinds]
    if reached.mean(0) @ counts > 0.5 * len(cells):
        yield 0, len(cells), np.flatnonzero(reached.any(1))
    else:
        for i, (start, n) in enumerate(zip(starts, counts)):
            yield start, start + n, np.flatnonzero(reached[:, i])


def _parts(blocks: DataFrame) -> int:
    n = blocks.count()
    return max(-(-n // TASK_BLOCKS), min(n, LEAST_PARTS))


def _dealt(left: DataFrame, right: DataFrame) -> DataFrame:
    """Tasks of a part of the left blocks and a part of the right ones, as rows of a partition with the right ones first."""
    n, m = _parts(left), _parts(right)
    part = lambda k: F.pmod(F.monotonically_increasing_id(), F.lit(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    ours = left.withColumn("i", part(n)).select("*", every(m).alias("j"), F.lit(True).alias("is_left"))
    theirs = right.withColumn("j", part(m)).select("*", every(n).alias("i"), F.lit(False).alias("is_left"))
    both = ours.unionByName(theirs, allowMissingColumns=True).withColumn("task", F.col("i") * m + F.col("j"))
    return both.repartitionById(n * m, "task").sortWithinPartitions("task", "is_left")


def _one_row(**columns: pa.Array | np.ndarray | bytes) -> pa.RecordBatch:
    """A row of binary values and lists."""
    lists = {k: x if isinstance(x, (bytes, pa.Array)) else pa.array(x) for k, x in columns.items()}
    return pa.RecordBatch.from_pydict(
        {k: pa.array([x], pa.binary()) if isinstance(x, bytes) else pa.ListArray.from_arrays([0, len(x)], x) for k, x in lists.items()}
    )


def cosine_join(
    vecs: DataFrame,
    anchors: DataFrame,
    id_col: str,
    vec: str,
    anchor_id: str,
    anchor_vec: str,
    threshold: float = COSINE_THRESHOLD,
    pivots: int = PIVOTS,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """``(id, anchor, cosine)`` of the pairs with a cosine above ``threshold``.

    Angles between vectors obey the triangle inequality. Up to ``pivots`` of the vectors, drawn by hash, cut space into cells: each
    vector belongs to its nearest pivot. An anchor reaches the cells where it may have a match, those whose pivot is no
    farther from it than the cell's radius and the threshold's angle together, nor than its own nearest pivot and twice that angle.
    So no match is lost, and clustered vectors meet few anchors. Both sides are stored once as blocks of at most ``block`` rows. A
    task takes a part of each, ``TASK_BLOCKS`` blocks, holds those of the anchors and lets the others pass, so a block is copied
    once for each part of the other side, not for each block or cell. Each pair of blocks in reach is a matrix product, cell by cell; pairs near the threshold or above it are scored one by one, a bounded
    number at a time. Only the pivots and two numbers for each cell pass through the driver.

    Null and zero vectors, vectors with null or non-finite components and those of another length than the pivots match nothing.
    """
    reach = math.acos(max(-1.0, min(1.0, threshold))) + 1e-7
    vectors, ours_as = _given(vecs, id_col, vec)
    targets, theirs_as = _given(anchors, anchor_id, anchor_vec)
    kinds = {"id": vectors.dtypes[0][1], "anchor": targets.dtypes[0][1]}
    out = f"`{id_col}` {kinds['id']}, `{anchor_id}` {kinds['anchor']}, cosine double"
    spark = vecs.sparkSession
    by_hash = F.xxhash64("id", F.col("v").cast("array<double>"))
    drawn = vectors.filter(F.exists("v", lambda x: x != 0)).orderBy(by_hash).limit(pivots).select("v").toPandas()["v"]
    dim = len(drawn.iloc[0]) if len(drawn) else 0
    centres, _ = _unit(_components(pa.array(drawn, pa.list_(pa.float64())), dim)[0])
    if not len(centres):
        return spark.createDataFrame([], out)
    size = max(1, min(block, BLOCK_COMPONENTS // dim))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block, angles in _sorted_blocks(batches, centres, size):
            cells = angles.argmin(1).astype(np.int32)
            yield _one_row(ids=ids, v=block.tobytes(), cells=cells, angles=angles.min(1))

    left = stored_in_files(vectors.mapInArrow(locate, f"ids array<{kinds['id']}>, v binary, cells array<int>, angles array<double>"), BLOCKS_IN_FILE)
    located = stored(left.select(F.explode(F.arrays_zip(F.col("cells").alias("cell"), F.col("angles").alias("angle"))).alias("x")).select("x.*"))
    cells = located.groupBy("cell").agg(F.max("angle").alias("radius")).toPandas()
    radius = np.full(len(centres), -np.inf)
    radius[cells["cell"]] = cells["radius"]

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block, angles in _sorted_blocks(batches, centres, size):
            near = (angles <= radius + reach) & (angles <= angles.min(1)[:, None] + 2 * reach)
            yield _one_row(anchors=ids, w=block.tobytes(), near=np.packbits(near, axis=1).tobytes())

    def in_cells(near: pa.Scalar) -> np.ndarray:
        return np.unpackbits(np.frombuffer(near.as_buffer(), np.uint8).reshape(-1, -(-len(centres) // 8)), axis=1, count=len(centres)).astype(bool)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for near in batch.column(0):
                yield pa.RecordBatch.from_pydict({"cell": np.nonzero(in_cells(near))[1].astype(np.int32)})

    # Anchors are copied for the cells they reach by the number of the cell only.
    right = stored_in_files(targets.mapInArrow(copy, f"anchors array<{kinds['anchor']}>, w binary, near binary"), BLOCKS_IN_FILE)
    copied = stored(right.select("near").mapInArrow(copies, "cell int"))
    if copied.isEmpty():
        return spark.createDataFrame([], out)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, []
        for batch in batches:
            for number, is_left, ids, v, cells, anchors, w, near in zip(*batch.columns):
                if number.as_py() != task:
                    task, held = number.as_py(), []
                if not is_left.as_py():
                    # The vectors as a copy, which does not keep the batch.
                    held.append((anchors.values, np.frombuffer(w.as_py(), theirs_as).reshape(-1, dim), in_cells(near)))
                    continue
                ours, _ = _unit(np.frombuffer(v.as_buffer(), ours_as).reshape(-1, dim))
                for names, block, reached in held:
                    for start, end, at in _in_reach(cells.values.to_numpy(), reached):
                        if not len(at):
                            continue
                        theirs, _ = _unit(block[at])
                        for a, b, cosine in _near_pairs(ours[start:end], theirs, threshold):
                            if len(cosine):
                                found = [ids.values.take(pa.array(a + start)), names.take(pa.array(at[b])), pa.array(cosine)]
                                yield pa.RecordBatch.from_arrays(found, [id_col, anchor_id, "cosine"])

    dealt = _dealt(left.drop("angles"), right)
    return dealt.select("task", "is_left", "ids", "v", "cells", "anchors", "w", "near").mapInArrow(match, out)


def _given(df: DataFrame, key: str, vec: str) -> tuple[DataFrame, type]:
    """``(id, v)`` of the vectors that are not null, with components in single precision if given so, and their type in numpy."""
    rows = df.select(F.col(key).alias("id"), F.col(vec).alias("v")).filter("v is not null")
    if rows.dtypes[1][1] == "array<float>":
        return rows, np.float32
    return rows.withColumn("v", F.col("v").cast("array<double>")), np.float64


def semantic_values(hits: DataFrame, meanings: DataFrame, id_col: str, anchor_id: str) -> DataFrame:
    """Distinct ``(id, value)`` from cosine hits and the ``(anchor, value)`` table."""
    return hits.select(id_col, anchor_id).join(meanings, anchor_id).select(id_col, "value").distinct()


def dominant_vectors(df: DataFrame, key: str, vec: str, k: int = DOMINANT_VECTORS, rounds: int = 100, tolerance: float = 1e-4) -> DataFrame:
    """``k`` cluster centres per key by k-means, for all keys at once.

    Each round joins the vectors with the centres of their key, sums up the nearest vectors of
    each centre on the map side and stores the new centres, which cuts the lineage. A key of
    any size is spread over all tasks. Centres start at the mean plus and minus the spread of
    the widest dimension, so runs agree. It ends when in no key the squared moves of the
    centres add up to more than ``tolerance`` times the mean variance of its dimensions, or after ``rounds`` rounds;
    ``converged`` says for each key which it was.
    """
    rows = df.filter(F.col(vec).isNotNull()).select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    rows = stored(rows)
    stats = rows.groupBy(key).agg(Summarizer.metrics("mean", "variance").summary(F.col("_v")).alias("s"))
    stats = stats.select(key, vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("v"))
    wide = F.array_position("v", F.array_max("v")) - 1
    spread = F.sqrt(F.array_max("v"))
    shifts = [0.0] if k == 1 else [2.0 * i / (k - 1) - 1.0 for i in range(k)]

    def start(shift: float) -> F.Column:
        return F.transform("m", lambda x, i: F.when(i == wide, x + shift * spread).otherwise(x))

    enough = F.aggregate("v", F.lit(0.0), lambda s, x: s + x) / F.size("v") * tolerance
    centres = stored(stats.select(key, F.array(*[start(s) for s in shifts]).alias("centres"), enough.alias("enough")))
    centres = centres.withColumn("step", F.lit(float("inf")))
    for _ in range(rounds):
        moved = stored(_move(rows, centres.drop("step"), key, k))
        drop_stored(centres)
        centres = moved
        if moved.filter(F.col("step") > F.col("enough")).isEmpty():
            break
    done = (F.col("step") <= F.col("enough")).alias("converged")
    return centres.select(key, done, F.posexplode("centres").alias("cluster", "centre"))


def colour_text(centre: F.Column) -> F.Column:
    """A centre in whole numbers as text, like ``[12, 240, 7]``."""
    return F.concat(F.lit("["), F.array_join(F.transform(centre, lambda x: F.round(x).cast("int").cast("string")), ", "), F.lit("]"))


def _squared_gap(a: F.Column, b: F.Column) -> F.Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)


def _move(rows: DataFrame, centres: DataFrame, key: str, k: int) -> DataFrame:
    """Centres after one round and the sum of their squared moves; one without vectors stays."""
    here = centres.select(F.col(key).alias("_k"), "centres")
    near = rows.join(here, F.col(key).eqNullSafe(F.col("_k"))).withColumn("_x", vector_to_array("_v"))
    gaps = F.transform("centres", lambda c: _squared_gap(F.col("_x"), c))
    near = near.select(key, "_v", (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int").alias("_c"))
    means = near.groupBy(key, "_c").agg(Summarizer.mean(F.col("_v")).alias("m"))
    # At most k rows per key from here on.
    found = means.groupBy(F.col(key).alias("_k")).agg(
        *[F.max(F.when(F.col("_c") == i, vector_to_array("m"))).alias(f"_m{i}") for i in range(k)]
    )
    both = centres.join(found, F.col(key).eqNullSafe(F.col("_k")))
    new = F.array(*[F.coalesce(F.col(f"_m{i}"), F.get("centres", i)) for i in range(k)])
    step = F.aggregate(
        F.zip_with("centres", "new", _squared_gap), F.lit(0.0), lambda s, x: s + x
    )
    return both.select(key, "centres", "enough", new.alias("new")).select(key, F.col("new").alias("centres"), "enough", step.alias("step"))
