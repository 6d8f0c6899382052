"""Which features tell the members of a group from others."""

from __future__ import annotations

import hashlib
import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from fitlens.constants import FOREST_TREES
from fitlens.functions.text import md5_number
from fitlens.operators.encoding import assemble
from fitlens.operators.joins import null_safe_join
from fitlens.operators.positions import running_sums
from fitlens.session import drop_stored, stored
from fitlens.sources.io import literal_rows

MAX_BINS = 32
MAX_DEPTH = 5
# Draws are numbers below this prime.
FIELD = 2**31 - 1
# Rows that are numbered, or counted, in one go.
BLOCK = 10_000
TASK_BLOCKS = 4
# Gains that differ by less are equal.
DIGITS = 12


def rf_importance(
    df: DataFrame, features: Sequence[str], label: str, trees: int = FOREST_TREES, seed: int = 0, depth: int = MAX_DEPTH, bagging: bool = True
) -> DataFrame:
    """``(feature, importance, rank)`` of one forest over the whole table.

    Training reads the rows several times, so they are stored first. Without ``bagging`` every tree takes all rows and features.
    """
    rows = stored(df.select(*features, F.col(label).cast("double").alias(label)))
    vectors = assemble(rows, features)
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed)
    if not bagging:
        forest = forest.setBootstrap(False).setFeatureSubsetStrategy("all")
    found = sorted(zip(features, forest.fit(vectors).featureImportances.toArray().tolist()), key=lambda r: (-r[1], r[0]))
    drop_stored(rows)
    return literal_rows(
        df.sparkSession,
        {"feature": [r[0] for r in found], "importance": [r[1] for r in found], "rank": range(1, len(found) + 1)},
        {"feature": pa.string(), "importance": pa.float64(), "rank": pa.int32()},
    )


def bin_borders(df: DataFrame, key: str, features: Sequence[str], bins: int = MAX_BINS) -> DataFrame:
    """``(key, _borders)``: for each feature the largest value of each of its bins within the key, in order.

    A feature with up to ``bins`` values has a bin for each; of more values, bins of about equal numbers of rows.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(c).alias("x")) for i, c in enumerate(features)]))
    values = df.select(key, pairs.alias("p")).groupBy(key, "p.f", "p.x").agg(F.count("*").alias("n"), F.lit(1).alias("one"))
    run = running_sums(stored(values), [key, "f"], "x", ["n", "one"])
    place = F.when(F.col("all_one") <= bins, F.col("run_one")).otherwise(F.floor((F.col("run_n") - F.col("n")) * bins / F.col("all_n")))
    highest = run.groupBy(key, "f", place.alias("bin")).agg(F.max("x").alias("x"))
    each = [F.sort_array(F.collect_list(F.when(F.col("f") == i, F.col("x")))) for i in range(len(features))]
    return highest.groupBy(key).agg(F.array(*each).alias("_borders"))


def _seeded(*parts: object) -> random.Random:
    return random.Random(int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:15], 16))


def tree_factors(trees: int, seed: int) -> list[tuple[int, int]]:
    """Factor and summand that turn the number of a row into its draw in each tree."""
    draw = _seeded(seed, "rows")
    return [(draw.randrange(1, FIELD), draw.randrange(FIELD)) for _ in range(trees)]


def poisson_steps() -> list[int]:
    """Draws from which on a row counts once, twice, ... in a tree, so that its count has the Poisson distribution of mean 1."""
    total, term, out = 0.0, math.exp(-1.0), []
    for n in range(1, 11):
        total += term
        term /= n
        out.append(int(total * FIELD))
    return out


def tried_features(features: int, trees: int, level: int, seed: int) -> list[list[int]]:
    """The features that each node of a level tries: the square root of their number, drawn anew for each tree and node."""
    draw = _seeded(seed, "features", level)
    return [sorted(draw.sample(range(features), math.ceil(math.sqrt(features)))) for _ in range(trees << level)]


def _gini(pos: Column, n: Column) -> Column:
    rate = F.try_divide(pos.cast("double"), n)
    return F.coalesce(F.lit(2.0) * rate * (F.lit(1.0) - rate), F.lit(0.0))


def _numbered(df: DataFrame, key: str, names: Sequence[str], label: str, id_col: str | None, seed: int) -> DataFrame:
    """Rows with a number ``_r`` below ``FIELD`` each, from their id or else from what they hold and which of their equals they are."""
    if id_col is not None:
        return df.withColumn("_r", md5_number(F.lit(seed), F.col("_id")) % FIELD).drop("_id")
    same = df.groupBy(key, *names, label).agg(F.count("*").alias("_n"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / BLOCK))).alias("_block")
    blocks = same.select("*", block).repartition(key, *names, label, "_block")
    first = F.col("_block") * BLOCK
    rows = blocks.select("*", F.explode(F.sequence(first, F.least(first + BLOCK, F.col("_n")) - 1)).alias("_i"))
    number = (md5_number(F.lit(seed), F.to_json(F.struct(*names, label))) % FIELD + F.col("_i") * 1_000_003) % FIELD
    return rows.select(key, *names, label, number.alias("_r"))


def _blocks(binned: DataFrame, key: str) -> DataFrame:
    """``(key, _part, _label, _r, _m, _bins)``: the rows of a key in blocks of about ``BLOCK``, dealt by hash; _m counts equal rows.

    Columns are arrays with an element for each row, _bins with one for each row and feature.
    """
    same = binned.groupBy(key, "_label", "_r", "_bins").agg(F.count("*").alias("_m"))
    sizes = same.groupBy(key).agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("_parts"))
    dealt = null_safe_join(same, sizes, [key]).withColumn("_part", F.pmod(F.xxhash64("_label", "_r", "_bins"), F.col("_parts")))
    packed = dealt.groupBy(key, "_part").agg(F.collect_list(F.struct("_label", "_r", "_m", "_bins")).alias("_rows"))
    return packed.select(key, "_part", *[F.col(f"_rows.{c}").alias(c) for c in ("_label", "_r", "_m")], F.flatten("_rows._bins").alias("_bins"))


def _counts(
    bins: np.ndarray, label: np.ndarray, draw: np.ndarray, times: np.ndarray, above: Sequence[np.ndarray], tried: np.ndarray, factors: Sequence[tuple[int, int]], bagging: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Weighted numbers of rows, and of those with label 1, by node of a level (of all trees), feature and bin, for one block."""
    nodes, features = tried.shape
    width, steps = nodes // len(factors), np.array(poisson_steps())
    n, pos = np.zeros((2, nodes, features, MAX_BINS))
    for tree, (a, b) in enumerate(factors):
        weight = np.searchsorted(steps, (draw * a + b) % FIELD, side="right") * times if bagging else times
        at = np.flatnonzero(weight)
        code = np.full(len(at), tree)
        for splits in above:
            split = splits[code]
            at, code, split = (x[split >= 0] for x in (at, code, split))
            code = code * 2 + (bins[at, split // 64] > split % 64)
        place, own = slice(tree * width, (tree + 1) * width), code - tree * width
        for f in range(features):
            some = tried[code, f]
            row = at[some]
            cell = own[some] * MAX_BINS + bins[row, f]
            n[place, f] = np.bincount(cell, weight[row], width * MAX_BINS).reshape(width, MAX_BINS)
            pos[place, f] = np.bincount(cell, weight[row] * label[row], width * MAX_BINS).reshape(width, MAX_BINS)
    return n, pos


def _grown(blocks: DataFrame, forest: DataFrame, key: str, level: int, features: int, factors: Sequence[tuple[int, int]], seed: int, bagging: bool) -> DataFrame:
    """``(key, code, f, bin, n, pos)``: weighted counts of the rows in the open nodes of a level, by the bins of features that they try.

    code numbers the nodes of all trees: tree * 2 ** level + place in the level. forest: for each key and level before, by code the
    split ``feature * 64 + bin`` or -1. Splits meet whole blocks and each block is counted in one go, so what is shuffled grows with
    the blocks and not with rows times trees.
    """
    tried = tried_features(features, len(factors), level, seed) if bagging else [range(features)] * (len(factors) << level)
    tries = np.array([[f in some for f in range(features)] for some in tried])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                numbers = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in batch.schema.names[2:]}
                bins = numbers["_bins"].reshape(-1, features)
                above = [numbers[f"_s{j}"] for j in range(level)]
                n, pos = _counts(bins, numbers["_label"], numbers["_r"], numbers["_m"], above, tries, factors, bagging)
                at = np.nonzero(n)
                cells = [pa.array(x, pa.int32()) for x in at] + [pa.array(x[at], pa.int64()) for x in (n, pos)]
                same_key = batch.column(key).take(pa.array(np.full(len(at[0]), i)))
                yield pa.RecordBatch.from_arrays([same_key, *cells], [key, "code", "f", "bin", "n", "pos"])

    # A few blocks for each task, whatever their keys: there is more to count in them than their size tells.
    met = null_safe_join(blocks, forest, [key]).repartition(math.ceil(blocks.count() / TASK_BLOCKS) or 1, key, "_part")
    kinds = [blocks.schema[key], *[StructField(c, IntegerType()) for c in ("code", "f", "bin")], *[StructField(c, LongType()) for c in ("n", "pos")]]
    found = met.select(key, "_part", "_label", "_r", "_m", "_bins", *[f"_s{j}" for j in range(level)]).mapInArrow(count, StructType(kinds))
    return found.groupBy(key, "code", "f", "bin").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))


def best_splits(counts: DataFrame, key: str) -> DataFrame:
    """``(key, code, f, bin, gain, total)``: the split of highest Gini gain of each node, if any; ties by feature and bin."""
    node = Window.partitionBy(key, "code", "f")
    left = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = counts.select(
        key, "code", "f", "bin",
        F.sum("n").over(left).alias("nl"), F.sum("pos").over(left).alias("pl"), F.sum("n").over(node).alias("n"), F.sum("pos").over(node).alias("pos"),
    )
    n, pos, nl, pl = (F.col(c) for c in ("n", "pos", "nl", "pl"))
    gain = _gini(pos, n) - (nl * _gini(pl, nl) + (n - nl) * _gini(pos - pl, n - nl)) / n
    ways = sums.filter("nl < n").withColumn("gain", F.round(gain, DIGITS)).filter(f"gain > 1e-{DIGITS}")
    first = F.min(F.struct((-F.col("gain")).alias("less"), "f", "bin", "n")).alias("b")
    return ways.groupBy(key, "code").agg(first).select(key, "code", "b.f", "b.bin", (-F.col("b.less")).alias("gain"), F.col("b.n").alias("total"))


def _by_code(splits: DataFrame, key: str, width: int, out: str) -> DataFrame:
    """Splits of a level as one array for each key, -1 where a node has none."""
    coded = F.struct(F.col("code").alias("code"), (F.col("f") * 64 + F.col("bin")).cast("int").alias("split"))
    listed = splits.groupBy(key).agg(F.sort_array(F.collect_list(coded)).alias("l"))
    none = lambda n: F.array_repeat(F.lit(-1), n.cast("int"))
    # The list is the one element of an array, so that it is put in order once.
    filled = F.transform(
        F.array("l"),
        lambda x: F.concat(
            F.flatten(F.transform(x, lambda s, i: F.concat(none(s["code"] - 1 - F.coalesce(F.get(x, i - 1)["code"], F.lit(-1))), F.array(s["split"])))),
            none(F.lit(width - 1) - F.element_at(x, -1)["code"]),
        ),
    )[0]
    return listed.select(key, filled.alias(out))


def rf_importance_by_group(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    trees: int = FOREST_TREES,
    seed: int = 0,
    depth: int = MAX_DEPTH,
    bagging: bool = True,
    id_col: str | None = None,
) -> DataFrame:
    """``(key, feature, importance, rank)`` of one forest per key on all its rows, all keys and trees level by level.

    Rows are put in blocks once. Each level counts the rows of all open nodes by bins of the features that they try, block by block
    with numpy, sums up the counts and takes the best split of each node. So a key of any size is spread over all tasks; only
    splits, a bounded number for each key, are kept between levels. A row counts in a tree as often as a Poisson variable of mean 1 says, drawn from its id (unique within
    the key) or else from its values and its number among equal rows; so results do not depend on how rows are dealt out. Without
    ``bagging`` every tree takes all rows and features.

    Importances are gains weighted by rows, as shares within each tree, and means over the trees that split. A key with one label
    only has zero importances. NULL features are below all values; rows with a NULL label are left out.
    """
    names = [f"_f{i}" for i in range(len(features))]
    values = [F.coalesce(F.col(f).cast("double"), F.lit(float("-inf"))).alias(n) for f, n in zip(features, names)]
    ids = [F.col(id_col).alias("_id")] if id_col is not None else []
    rows = stored(df.filter(F.col(label).isNotNull()).select(F.col(key).alias("_key"), *values, F.col(label).cast("int").alias("_label"), *ids))
    borders = bin_borders(rows, "_key", names)

    def bin_of(i: int, name: str) -> Column:
        return F.size(F.filter(F.get("_borders", i), lambda border: border < F.col(name))).cast("byte").alias(name)

    place = [bin_of(i, n) for i, n in enumerate(names)]
    binned = null_safe_join(rows, borders, ["_key"]).select("_key", *place, "_label", *(["_id"] if ids else []))
    binned = _numbered(binned, "_key", names, "_label", id_col, seed).select("_key", "_label", "_r", F.array(*names).alias("_bins"))
    blocks = stored(_blocks(binned, "_key"))
    factors = tree_factors(trees, seed)
    keys = forest = stored(blocks.select("_key").distinct())
    gains = []
    for level in range(depth):
        splits = stored(best_splits(_grown(blocks, forest, "_key", level, len(names), factors, seed, bagging), "_key"))
        gains.append(splits.select("_key", F.floor(F.col("code") / 2**level).alias("tree"), "f", (F.col("gain") * F.col("total")).alias("gain")))
        if level == depth - 1:
            break
        width = trees << level
        arrays = null_safe_join(forest, _by_code(splits, "_key", width, f"_s{level}"), ["_key"], "left")
        forest = arrays.withColumn(f"_s{level}", F.coalesce(f"_s{level}", F.array_repeat(F.lit(-1), width)))
    every = gains[0]
    for more in gains[1:]:
        every = every.union(more)
    by_tree = every.groupBy("_key", "tree", "f").agg(F.sum("gain").alias("gain"))
    share = F.col("gain") / F.sum("gain").over(Window.partitionBy("_key", "tree"))
    found = by_tree.select("_key", "tree", "f", share.alias("share")).groupBy("_key", "f").agg(F.sum("share").alias("share"))
    part = F.col("share") / F.sum("share").over(Window.partitionBy("_key"))
    found = found.select("_key", "f", part.alias("importance"))
    all_features = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.lit(c).alias("feature")) for i, c in enumerate(features)])).alias("p")
    out = null_safe_join(keys.select("_key", all_features).select("_key", "p.*"), found, ["_key", "f"], "left")
    out = out.withColumn("importance", F.coalesce("importance", F.lit(0.0)))
    # Rounded, so that sums that were added up in another order rank alike.
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(F.desc(F.round("importance", 9)), "feature"))
    return out.select(F.col("_key").alias(key), "feature", "importance", rank.alias("rank"))


def ranked_feature_names(ranked: DataFrame, key: str) -> DataFrame:
    """``(key, features_importance)``: feature names by falling importance; one entry per feature."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "feature")))
    return ranked.groupBy(key).agg(F.transform(ordered, lambda r: r["feature"]).alias("features_importance"))


def stump_gain(df: DataFrame, key: str, features: Sequence[str], label: str) -> DataFrame:
    """``(key, feature, gain)``: Gini gain of the best single split of each feature.

    Values are counted first; the running counts along a feature are bucketed sums, so
    one large key or a feature with many values spreads over many tasks.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])
    )
    long = df.select(key, F.col(label).cast("int").alias("y"), pairs.alias("p")).select(key, "y", "p.feature", "p.x")
    values = long.groupBy(key, "feature", "x").agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("pos"))
    run = running_sums(stored(values), [key, "feature"], "x", ["n", "pos"])
    n, pos, nl, pl = (F.col(c) for c in ("all_n", "all_pos", "run_n", "run_pos"))
    nr, pr = n - nl, pos - pl
    gain = _gini(pos, n) - (nl * _gini(pl, nl) + nr * _gini(pr, nr)) / n
    return run.groupBy(key, "feature").agg(F.max(gain).alias("gain"))
