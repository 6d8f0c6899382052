"""Operators on hand-made rows, and against brute force where no SQL checks them."""

from __future__ import annotations

import hashlib
import itertools
import random
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from fitlens.constants import CORE_VALUES, DEGREES
from fitlens.operators import distributions as ds
from fitlens.operators import encoding as en
from fitlens.operators import forest as fr
from fitlens.operators import groups as g
from fitlens.operators import joins as j
from fitlens.operators import keywords as kw
from fitlens.operators import positions as po
from fitlens.operators import ranking as rk
from fitlens.operators import rows as rw
from fitlens.operators import sampling as sa
from fitlens.operators import vectors as vc
from fitlens.session import shared_folder
from fitlens.sources import io


# --- sources -------------------------------------------------------------------------------


def test_clustered_table(spark, tmp_path):
    """Files of a folder hold ranges of their own, a large folder has several, and one folder can be replaced."""
    import glob

    import pyarrow.parquet as pq

    path = str(tmp_path / "t")
    df = spark.range(40_000).selectExpr("cast(hash(id) as long) as x", "if(id % 10 < 8, 'hot', 'b') as k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.write_table(df, path, ["k"], ["x"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = {}
    for folder in ("k=hot", "k=b"):
        files = [pq.read_table(f, partitioning=None)["x"].to_pylist() for f in glob.glob(f"{path}/{folder}/*.parquet")]
        assert all(x == sorted(x) for x in files)
        ranges[folder] = sorted((x[0], x[-1]) for x in files)
        assert all(a[1] <= b[0] for a, b in itertools.pairwise(ranges[folder]))
    assert len(ranges["k=hot"]) > 2
    io.write_table(spark.createDataFrame([(1, "b", 7)], "x long, k string, id long"), path, ["k"], ["x"], only_partitions=True)
    back = io.read_table(spark, path)
    assert {r["k"]: r["count"] for r in back.groupBy("k").count().collect()} == {"hot": 32_000, "b": 1}


def test_tables_and_csv(spark, tmp_path, frame):
    df = frame([("A", "line one\nline \"two\", end"), ("B", None), ("B", "x, y")], "company_name string, scraped_data string")
    io.write_table(df, str(tmp_path / "t"), ["company_name"])
    io.write_table(df, str(tmp_path / "t"))
    assert rows(io.read_table(spark, str(tmp_path / "t"))) == rows(df)
    io.append_scraped(df, str(tmp_path / "c"))
    io.append_scraped(frame([("C", "more")], "company_name string, scraped_data string"), str(tmp_path / "c"))
    back = io.read_scraped(spark, str(tmp_path / "c"))
    assert rows(back) == rows(df.union(frame([("C", "more")], "company_name string, scraped_data string")))
    assert rows(io.clean_scraped(back, ["scraped_data"])) == [("line one\nline \"two\", end",), ("more",), ("x, y",)]


def test_lexicon_rows(spark):
    df = io.lexicon_df(spark, CORE_VALUES)
    assert df.select("value").distinct().count() == 26
    assert df.filter("word = 'diversity'").first()["value"] == "Diversity"
    assert df.filter("priority = 1").count() == 4


@pytest.mark.parametrize("lo,hi", [(0, 3), (3, 7), (3, None), (0, None), (9, 20), (5, 5), (0, 0)])
def test_slice_rows(frame, lo, hi):
    data = [(i % 3, i) for i in range(10)]
    got = io.slice_rows(frame(data, "a int, b int"), ["a", "b"], lo, hi)
    assert rows(got) == sorted(sorted(data)[lo:hi], key=repr)


# --- filters, joins, groups ----------------------------------------------------------------


def test_filters(frame):
    df = frame([(1, ["a"], None), (2, None, "x"), (3, ["a", "b"], "y")], "i int, l array<string>, t string")
    assert rows(rw.rich_profiles(df, l=0).select("i")) == [(1,), (3,)]
    assert rows(rw.with_all_text(df, ["t"]).select("i")) == [(2,), (3,)]
    assert rows(rw.for_company(df, "y", "t").select("i")) == [(3,)]


def test_ambiguous(frame):
    df = frame([("X", 1), ("X", 2), ("Y", 3), (None, 4)], "name string, i int")
    assert rows(j.drop_ambiguous(df, "name")) == [("Y", 3), (None, 4)]
    assert rows(j.ambiguous_rows(df, "name")) == [("X", 1), ("X", 2)]


def test_bridge_full_outer(frame):
    now = frame([("A", 1), (None, 2), ("C", 3), ("A", 1)], "company_name string, id int")
    past = frame([("B", 1), ("A", 1), (None, 1), ("A", 2)], "company_name string, id int")
    assert rows(j.bridge_full_outer(now, past)) == [("A", 1, 1, 1), ("A", 2, 0, 1), ("B", 1, 0, 1), ("C", 3, 1, 0)]


def test_ids_by_splits_large_keys(frame):
    data = [("hot", i) for i in range(500)] + [("hot", 3), ("cold", 1), (None, 7), ("cold", None)]
    lists = g.ids_by(frame(data, "k string, v int"), "k", "v", "ids", chunk=20).collect()
    assert max(len(r["ids"]) for r in lists) < 60
    together = defaultdict(list)
    for r in lists:
        together[r["k"]] += r["ids"]
    assert sorted(together["hot"]) == list(range(500)) and together["cold"] == [1] and together[None] == [7]


def test_eligible_counts_distinct(frame):
    df = frame([("A", 1), ("A", 1), ("A", 2), ("B", 1), (None, 1), (None, 2)], "company_name string, id int")
    assert rows(g.eligible(df, 2)) == [("A", 2)]


def test_beside_matches_window(frame):
    df = frame([("a", 3.0, 1), ("b", 1.0, 0), ("b", 2.0, 1), (None, 5.0, 1), (None, 7.0, 0)], "k string, x double, f int")
    got = g.beside(df, "k", [F.avg("x").alias("m"), F.var_samp("x").alias("v")])
    assert {(r["k"], r["m"], r["v"]) for r in got.collect()} == {("a", 3.0, None), ("b", 1.5, 0.5), (None, 6.0, 2.0)}
    assert got.count() == 5
    assert {r["p"] for r in g.pct_over(df, "k", {"p": "f"}).collect()} == {100.0, 50.0}


def test_collect_over(frame):
    df = frame([("n", "Master"), ("n", "Bachelor"), ("n", "Master"), ("m", None)], "name string, d string")
    got = {(r["name"], tuple(r["all"])) for r in g.collect_over(df, "name", "d", DEGREES, "all").collect()}
    assert got == {("n", ("Bachelor", "Master")), ("m", ())}


def test_strong_traits_are_ranked_by_logarithms(frame):
    """All p-values are zero; by name the weakest would come first."""
    from fitlens.functions.stats import log_normal_two_sided

    df = frame([("X", "a", 60.0), ("X", "b", 80.0), ("X", "c", 100.0), ("X", "d", 0.1)], "company_name string, feature string, z double")
    tests = df.withColumn("log_p", log_normal_two_sided(F.col("z"))).withColumn("p_value", F.exp("log_p"))
    got = {r["feature"]: (r["rank"], r["p_value"]) for r in rk.rank_features(tests, 0.05).collect()}
    assert got == {"c": (1, 0.0), "b": (2, 0.0), "a": (3, 0.0)}


def test_rank_features(frame):
    data = [("A", "x", 0.04, 1), ("A", "y", 0.01, -1), ("A", "z", 0.2, 1), ("B", "x", 0.05, 1)]
    df = frame(data, "company_name string, feature string, p_value double, direction int")
    assert rows(rk.rank_features(df, 0.05).select("feature", "rank")) == [("x", 2), ("y", 1)]
    assert rows(rk.rank_features(df, 0.05, only_higher=True).select("feature", "rank")) == [("x", 1)]


# --- positions and sampling ----------------------------------------------------------------


def skewed(n=600):
    """A third of all rows under one key, the rest over many."""
    return [("hot" if i % 3 == 0 else f"k{i % 50}", i) for i in range(n)]


@pytest.mark.parametrize("digits", [1, 3])
def test_hash_positions_are_a_permutation(frame, digits):
    got = po.hash_positions(frame(skewed(), "k string, i int"), ["k"], ["i"], 1, "pos", "size", digits).collect()
    groups = defaultdict(list)
    for r in got:
        groups[r["k"], r["size"]].append(r["pos"])
    assert sum(size for _, size in groups) == 600
    assert all(sorted(pos) == list(range(size)) for (_, size), pos in groups.items())


def test_hash_positions_do_not_depend_on_partitions(frame):
    df = frame(skewed(), "k string, i int")
    one = rows(po.hash_positions(df.repartition(1), ["k"], ["i"], 1))
    assert one == rows(po.hash_positions(df.repartition(7), ["k"], ["i"], 1))
    assert one != rows(po.hash_positions(df, ["k"], ["i"], 2))


@pytest.mark.parametrize(("share", "most"), [(10_000, 256), (10, 256), (1, 4)])
def test_running_sums(frame, share, most):
    rng = random.Random(3)
    data = [(k, float(x), rng.randint(1, 5)) for k in "ab" for x in rng.sample(range(1000), 80)] + [(None, 1.0, 2), ("a", 1e30, 1), ("a", -1e30, 3)]
    got = po.running_sums(frame(data, "k string, x double, n long"), ["k"], "x", ["n"], share, most)
    for r in got.collect():
        mine = [(x, n) for k, x, n in data if k == r["k"]]
        assert r["run_n"] == sum(n for x, n in mine if x <= r["x"]) and r["all_n"] == sum(n for _, n in mine)


def test_sample_per_group(frame):
    df = frame([(k, i, 5 if k == "hot" else 100) for k, i in skewed()], "k string, i int, lim int")
    picked = rows(sa.sample_per_group(df, "k", "i", "lim", 4))
    sizes = Counter(k for k, _ in skewed())
    assert Counter(r[0] for r in picked) == {k: 5 if k == "hot" else n for k, n in sizes.items()}
    assert picked == rows(sa.sample_per_group(df.repartition(5), "k", "i", "lim", 4))


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_samples_are_the_first_by_hash(frame, buckets):
    limits = {"hot": 37, "a": 0, "b": 3, None: 2, "none": None, "all": 1000}
    data = [(k, i) for k, n in (("hot", 600), ("a", 5), ("b", 40), (None, 9), ("none", 4), ("all", 30)) for i in range(n)]
    df = frame([(k, i, limits[k], 1) for k, i in data], "k string, i int, lim long, _n int").repartition(3)
    out = sa.sample_per_group(df, "k", "i", "lim", 4, buckets)
    assert out.columns == df.columns
    got = defaultdict(set)
    for r in out.collect():
        got[r["k"]].add(r["i"])
    for k, n in limits.items():
        order = sorted((hashlib.md5(f"4|{i}".encode()).hexdigest(), i) for key, i in data if key == k)
        assert got[k] == {i for _, i in order[: n or 0]}


def test_a_sample_of_equal_rows(frame):
    df = frame([("k", 1, 30)] * 100 + [("k", 2, 30)] * 7, "k string, i int, lim long")
    assert sa.sample_per_group(df, "k", "i", "lim", 1).count() == 30


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_negatives(frame, seed):
    rng = random.Random(seed)
    data = {("hot", i) for i in range(70)} | {(f"c{rng.randint(0, 9)}", rng.randint(0, 99)) for _ in range(150)}
    data |= {("all", i) for _, i in data} | {("all", i) for i in range(70)}
    people = {i for _, i in data}
    own = defaultdict(set)
    for c, i in data:
        own[c].add(i)
    drawn = rows(sa.negatives(frame(sorted(data), "company_name string, id int"), "company_name", "id", seed))
    assert len(drawn) == len(set(drawn)) and not set(drawn) & data
    got = Counter(c for c, _ in drawn)
    assert got == {c: n for c, s in own.items() if (n := min(len(s), len(people) - len(s)))}
    again = sa.negatives(frame(sorted(data, reverse=True), "company_name string, id int").repartition(3), "company_name", "id", seed)
    assert rows(again) == drawn


def test_negatives_are_spread_evenly(frame):
    data = [("a", i) for i in range(10)] + [("b", i) for i in range(10, 60)]
    hits = Counter()
    df = frame(data, "company_name string, id int")
    for seed in range(30):
        hits.update(r["id"] for r in sa.negatives(df, "company_name", "id", seed).filter("company_name = 'a'").collect())
    assert sum(hits.values()) == 300 and len(hits) > 45 and max(hits.values()) <= 18


# --- keywords ------------------------------------------------------------------------------


def test_keywords(frame):
    df = frame([(1, "The Team-work, of 3D HOT hot été - co2 don't"), (2, None), (3, "")], "id int, t string")
    assert rows(kw.keywords(df, "id", "t")) == [(1, "hot"), (1, "team-work"), (1, "été")]
    tags = frame([("hot", "JJ"), ("team-work", "VB")], "word string, tag string")
    assert rows(kw.keywords(df, "id", "t", pos_lexicon=tags)) == [(1, "hot")]


def test_keywords_many_skip_blank(frame):
    df = frame([(1, "red gear"), (1, "gear"), (1, "  "), (2, None)], "id int, t string")
    assert rows(kw.keywords_many(df, "id", "t")) == [(1, "gear"), (1, "red")]


def test_match_values(frame):
    lex = frame([(1, "Heat", "hot"), (2, "Spice", "hot"), (2, "Spice", "chili")], "priority int, value string, word string")
    words = frame([(1, "hot"), (1, "hot"), (1, "zzz")], "id int, word string")
    assert rows(kw.match_values(words, "id", lex, distinct=False)) == [(1, "Heat"), (1, "Heat")]
    assert rows(kw.match_values(words, "id", lex, distinct=True)) == [(1, "Heat")]
    assert rows(kw.invert_lexicon(lex)) == [("chili", "Spice"), ("hot", "Heat"), ("hot", "Spice")]


def test_expand_lexicon_and_lemmas(frame):
    lex = frame([(1, "Autonomy", "self driven")], "priority int, value string, word string")
    forms = frame([("driven", "drive"), ("Driven", "driv"), ("self", None)], "token string, form string")
    words = {r["word"] for r in kw.expand_lexicon(lex, forms).collect()}
    assert words == {"self driven", "drive", "driv"}
    found = frame([(1, "driven"), (1, "other")], "id int, word string")
    assert rows(kw.lemmatise(found, forms.filter("token = 'driven'"))) == [(1, "drive"), (1, "other")]


def test_phrases(frame, spark):
    lexicon = io.lexicon_df(spark, {"Environment": ["green", "long-term viability"], "Autonomy": ["self driven", "Driven", "self"], "Late": ["self driven"], "Long": ["a b c", "b", "b c"]})
    texts = [(1, "Self  DRIVEN, and driven! long-term\nviability; long-term"), (1, "self-driven driven"), (2, None), (3, ""), (None, "a b c b"), (4, "self " * 3 + "driven")]
    out = kw.match_phrases(frame([(i, t, "x", 0) for i, t in texts], "id int, text string, value string, place int"), "id", "text", lexicon)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([
        (1, "self driven", "Autonomy", 0, 2), (1, "driven", "Autonomy", 3, 1), (1, "long-term viability", "Environment", 4, 2), (1, "driven", "Autonomy", 1, 1),
        (None, "a b c", "Long", 0, 3), (None, "b", "Long", 3, 1), (4, "self", "Autonomy", 0, 1), (4, "self", "Autonomy", 1, 1), (4, "self driven", "Autonomy", 2, 2),
    ], key=repr)
    core = kw.match_phrases(frame([(1, "long-term viability by self driven people")], "id int, text string"), "id", "text", io.lexicon_df(spark, CORE_VALUES))
    assert rows(core.select("value")) == [("Autonomy",), ("Environment",)]


def test_texts_are_cut_into_tokens_once(frame, spark):
    found = kw.match_phrases(frame([(1, "self driven people")], "id int, text string"), "id", "text", io.lexicon_df(spark, {"A": ["self driven", "driven"]}))
    assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert rows(found.select("phrase", "place")) == [("self driven", 0)]


def test_ids_by_of_a_large_key(frame):
    df = frame([("k", i) for i in range(20_001)] + [("few", 1)], "k string, v int")
    lists = g.ids_by(df, "k", "v", "ids").collect()
    assert sorted(v for r in lists if r["k"] == "k" for v in r["ids"]) == list(range(20_001))
    assert sorted((r["k"], r["part"]) for r in lists) == [("few", 0), ("k", 0), ("k", 1), ("k", 2)]


def test_labels_above(frame):
    df = frame([(1, "Power: resources", 0.6), (1, "Face", 0.59)], "id int, label string, score double")
    assert rows(kw.labels_above(df, 0.6)) == [(1, "Power", 0.6)]


# --- vectors -------------------------------------------------------------------------------


def vectors(seed, n, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim))
    return [(i, [float(x) for x in centres[i % 5] + rng.normal(scale=0.4, size=dim)]) for i in range(n)]


@pytest.mark.parametrize("threshold", [-0.5, 0.0, 0.5, 0.85, 0.99])
@pytest.mark.parametrize(("pivots", "block"), [(64, 8192), (4, 10)])
def test_cosine_join_against_brute_force(frame, threshold, pivots, block):
    left, right = vectors(1, 60) + [(60, [0.0] * 6)], vectors(2, 12)
    got = vc.cosine_join(
        frame(left, "id int, v array<double>"), frame(right, "a int, w array<double>"), "id", "v", "a", "w", threshold, pivots, block
    )
    expected = set()
    for i, v in left:
        for a, w in right:
            norm = np.linalg.norm(v) * np.linalg.norm(w)
            if norm and np.dot(v, w) / norm > threshold:
                expected.add((i, a))
    found = [(r["id"], r["a"]) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == expected


def test_cosine_join_in_blocks(frame, monkeypatch):
    args = (frame(vectors(1, 40), "id int, v array<double>"), frame(vectors(2, 7), "a int, w array<double>"), "id", "v", "a", "w", 0.3)
    whole = rows(vc.cosine_join(*args).drop("cosine"))
    monkeypatch.setattr(vc, "MAX_BLOCK_SCORES", 15)
    assert rows(vc.cosine_join(*args).drop("cosine")) == whole and whole
    assert rows(vc.cosine_join(*args, pivots=3, block=4).drop("cosine")) == whole


def test_near_pairs_are_scored_in_bounded_memory():
    """A million pairs of 64 components, all near: their products would be half a gigabyte."""
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(1000, 64)) * 0.01 + 1
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    tracemalloc.start()
    found = sum(len(a) for a, _, _ in vc._near_pairs(unit, unit, 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == 1_000_000 and peak < 150e6


def test_cosine_join_of_odd_vectors(frame):
    left = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0]), (5, [float("nan"), 1.0]), (None, [2.0, 0.1]), (6, [1.0, None]), (1, [1.0, 0.0])]
    right = [("a", [3.0, 0.0]), ("b", None), ("c", [0.0, 1.0]), (None, [1.0, 0.0]), ("d", [1.0])]
    got = vc.cosine_join(frame(left, "id int, v array<double>"), frame(right, "a string, w array<double>"), "id", "v", "a", "w", 0.5, pivots=100)
    assert sorted(((r["id"], r["a"]) for r in got.collect()), key=repr) == sorted([(1, "a"), (1, "a"), (1, None), (1, None), (None, "a"), (None, None)], key=repr)


def test_clustered_vectors_meet_few_anchors(frame, monkeypatch):
    """60 tight clusters in 20 dimensions: nearly all anchors of other clusters stay away, and one cluster has most rows."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 20))
    near = lambda c: (centres[c] + rng.normal(scale=0.02, size=20)).tolist()
    left = [(i, near(0 if i % 3 else i % 60)) for i in range(900)]
    right = [(i, near(i % 60)) for i in range(300)]
    met = []
    real = vc.stored
    monkeypatch.setattr(vc, "stored", lambda df: (met.append(real(df)), met[-1])[1])
    got = vc.cosine_join(frame(left, "id int, v array<double>"), frame(right, "a int, w array<double>"), "id", "v", "a", "w", 0.95, block=100)
    x, y = (np.array([v for _, v in some]) for some in (left, right))
    cosines = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
    assert {(r["id"], r["a"]) for r in got.collect()} == set(zip(*[i.tolist() for i in np.nonzero(cosines > 0.95)]))
    located, copied = met
    sizes = dict(located.groupBy("cell").count().collect())
    compared = sum(n * sizes[c] for c, n in copied.groupBy("cell").count().collect())
    assert compared < 0.1 * 900 * 300


def test_cosine_join_copies_vectors_for_parts_only(frame, spark):
    """All pairs of 100 or of 25 blocks are in reach: vectors are not copied for each block or cell, but four times a side and stored."""

    def on_disk():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        shuffled = [Path(files.apply(i).getPath()) for i in range(files.size())]
        found = [f for f in shuffled if f.name.startswith("shuffle_")] + list(Path(shared_folder(spark).removeprefix("file:")).rglob("*.parquet"))
        return {f: f.stat().st_size for f in found if f.exists()}

    def run(n):
        x = np.random.default_rng(n).normal(size=(n, 64)).astype(np.float32)
        left = frame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<float>")
        right = left.select(F.col("id").alias("a"), F.col("v").alias("w"))
        before = on_disk()
        got = vc.cosine_join(left, right, "id", "v", "a", "w", 0.3, block=16)
        found = {(r["id"], r["a"]): r["cosine"] for r in got.collect()}
        unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
        expected = np.argwhere(unit @ unit.T > 0.3)
        assert found.keys() == {tuple(p) for p in expected.tolist()}
        assert all(abs(c - unit[i] @ unit[a]) < 1e-12 for (i, a), c in found.items())
        return sum(size for f, size in on_disk().items() if f not in before) / x.nbytes

    few, many = run(400), run(1600)
    assert many < 12 and many < 1.5 * few


def test_cosine_join_keeps_large_ids_beside_null_ones(frame):
    left = [(2**60 + 1, [1.0, 0.0]), (None, [1.0, 0.1])]
    got = vc.cosine_join(frame(left, "id long, v array<double>"), frame([(2**60 + 3, [1.0, 0.0])], "a long, w array<double>"), "id", "v", "a", "w", 0.5)
    assert sorted(((r["id"], r["a"]) for r in got.collect()), key=repr) == [(2**60 + 1, 2**60 + 3), (None, 2**60 + 3)]


def test_cosine_join_without_anchors(frame):
    empty = frame([], "a int, w array<double>")
    assert vc.cosine_join(frame(vectors(1, 5), "id int, v array<double>"), empty, "id", "v", "a", "w", 0.5).count() == 0


def test_mean_vector(frame):
    df = frame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("a", None), ("b", [5.0, 6.0])], "k string, v array<float>")
    assert rows(vc.mean_vector(df, "k", "v")) == [("a", [2.0, 3.0]), ("b", [5.0, 6.0])]


def test_dominant_vectors(frame):
    rng = np.random.default_rng(0)
    data = []
    for k, centres in {"p": [(0, 0), (10, 10)], "q": [(-5, 3), (5, 3)]}.items():
        for c in centres:
            data += [(k, [float(c[0] + e[0]), float(c[1] + e[1])]) for e in rng.normal(scale=0.1, size=(30, 2))]
    data.append(("single", [1.0, 1.0]))
    got = defaultdict(list)
    for r in vc.dominant_vectors(frame(data, "k string, v array<double>"), "k", "v").collect():
        got[r["k"]].append(tuple(round(x) for x in r["centre"]))
        assert r["converged"]
    assert sorted(got["p"]) == [(0, 0), (10, 10)] and sorted(got["q"]) == [(-5, 3), (5, 3)]
    assert set(got["single"]) == {(1, 1)}
    stopped = vc.dominant_vectors(frame(data, "k string, v array<double>"), "k", "v", rounds=1).collect()
    assert not all(r["converged"] for r in stopped)
    text = frame([([1.4, 254.6],)], "c array<double>").select(vc.colour_text(F.col("c"))).first()[0]
    assert text == "[1, 255]"


# --- encoding and forests ------------------------------------------------------------------


def test_string_index(frame):
    df = frame([(i, s) for i, s in enumerate(["b", "a", "a", "c", "bb", "ba", "bbb"])], "i int, s string")
    got = dict(en.string_index(df, "s", "x").select("s", "x").distinct().collect())
    assert got == {"a": 0.0, "b": 1.0, "ba": 2.0, "bb": 3.0, "bbb": 4.0, "c": 5.0}


def training(n=400):
    rng = random.Random(1)
    out = []
    for i in range(n):
        y = i % 2
        out.append(("mixed" if i % 4 else "pure", y if i % 4 else 1, float(y * 10 + rng.random()), rng.random(), rng.randint(0, 3)))
    return out


def test_forest_by_group(frame):
    df = frame(training(), "k string, label int, good double, noise double, code int")
    ranked = fr.rf_importance_by_group(df, "k", ["good", "noise", "code"], "label", trees=20)
    got = {(r["k"], r["feature"]): (r["importance"], r["rank"]) for r in ranked.collect()}
    assert got["mixed", "good"][0] > 0.5 and got["mixed", "good"][1] == 1
    assert sum(v for (k, _), (v, _) in got.items() if k == "mixed") == pytest.approx(1.0)
    assert all(v == 0.0 for (k, _), (v, _) in got.items() if k == "pure")
    again = fr.rf_importance_by_group(df.repartition(5), "k", ["good", "noise", "code"], "label", trees=20)
    assert rows(again) == rows(ranked)
    names = dict(fr.ranked_feature_names(ranked, "k").collect())
    assert names["mixed"][0] == "good" and len(names["pure"]) == 3


def test_forest_agrees_with_spark_ml(frame):
    df = frame(training(), "k string, label int, good double, noise double, code int").filter("k = 'mixed'")
    ours = fr.rf_importance_by_group(df, "k", ["good", "noise", "code"], "label").orderBy("rank").first()
    theirs = fr.rf_importance(df, ["good", "noise", "code"], "label").orderBy("rank").first()
    assert ours["feature"] == theirs["feature"] == "good"
    assert ours["importance"] == pytest.approx(theirs["importance"], abs=0.15)


def grown_by_hand(rows, features, trees, seed, depth, bagging):
    """Importances of one key's rows (id, label, values), by the same draws and a plain recursive search."""
    columns = list(zip(*[r[2] for r in rows]))
    bins = []
    for column in columns:
        values = sorted(set(column))
        before = {v: sum(x < v for x in column) for v in values}
        place = {v: i if len(values) <= fr.MAX_BINS else before[v] * fr.MAX_BINS // len(column) for i, v in enumerate(values)}
        order = sorted(set(place.values()))
        bins.append([order.index(place[x]) for x in column])
    bins = list(zip(*bins))
    total = [0.0] * features
    gini = lambda p, n: 2 * (p / n) * (1 - p / n) if n else 0.0
    for t, (a, b) in enumerate(fr.tree_factors(trees, seed)):
        draws = [(a * (int(hashlib.md5(f"{seed}|{i}".encode()).hexdigest()[:15], 16) % fr.FIELD) + b) % fr.FIELD for i, _, _ in rows]
        weights = [sum(d >= s for s in fr.poisson_steps()) if bagging else 1 for d in draws]
        gains = [0.0] * features
        nodes = [(t, [i for i in range(len(rows)) if weights[i]])]
        for level in range(depth):
            tried = fr.tried_features(features, trees, level, seed)
            below = []
            for code, members in nodes:
                n, pos = sum(weights[i] for i in members), sum(weights[i] * rows[i][1] for i in members)
                ways = []
                for f in tried[code] if bagging else range(features):
                    for cut in sorted({bins[i][f] for i in members})[:-1]:
                        nl = sum(weights[i] for i in members if bins[i][f] <= cut)
                        pl = sum(weights[i] * rows[i][1] for i in members if bins[i][f] <= cut)
                        gain = round(gini(pos, n) - (nl * gini(pl, nl) + (n - nl) * gini(pos - pl, n - nl)) / n, fr.DIGITS)
                        if gain > 1e-12:
                            ways.append((-gain, f, cut))
                if ways:
                    gain, f, cut = min(ways)
                    gains[f] -= gain * n
                    below.append((code * 2, [i for i in members if bins[i][f] <= cut]))
                    below.append((code * 2 + 1, [i for i in members if bins[i][f] > cut]))
            nodes = below
        if sum(gains):
            total = [x + g / sum(gains) for x, g in zip(total, gains)]
    return [x / sum(total) if sum(total) else 0.0 for x in total]


@pytest.mark.parametrize("bagging", [True, False])
def test_forest_equals_a_recursive_search(frame, bagging):
    rng = random.Random(12)
    data = []
    for i in range(240):
        k = (None, "a", "a", "b")[i % 4]
        y = rng.random() < 0.5
        data.append((k, i, int(y), rng.gauss(y, 1), float(rng.randrange(3)), rng.choice((0.0, 0.0, 5.0)), rng.gauss(0, 1)))
    data += [("one", 900 + i, 1, 1.0, float(i), 0.0, 0.0) for i in range(4)] + [("tiny", 990, 0, 1.0, 1.0, 1.0, 1.0)]
    names = ["f", "g", "h", "e"]
    df = frame(data, "k string, i long, y int, f double, g double, h double, e double").repartition(5)
    got = fr.rf_importance_by_group(df, "k", names, "y", trees=4, seed=3, depth=3, bagging=bagging, id_col="i").collect()
    for key in (None, "a", "b", "one", "tiny"):
        mine = {r["feature"]: r["importance"] for r in got if r["k"] == key}
        want = grown_by_hand([(i, y, x) for k, i, y, *x in data if k == key], 4, 4, 3, 3, bagging)
        assert [mine[n] for n in names] == pytest.approx(want, abs=1e-9), key
        ranks = sorted((r["rank"], r["feature"]) for r in got if r["k"] == key)
        assert [n for _, n in ranks] == sorted(names, key=lambda n: (-round(mine[n], 9), n))


@pytest.mark.parametrize("seed", range(4))
def test_forest_over_many_equal_rows(frame, seed):
    """Only three features with few values, so whole combinations repeat very often; the label is one of them."""
    rng = random.Random(1)
    data = [("k", g := rng.randrange(2), float(g), float(rng.randrange(2)), float(rng.randrange(2))) for _ in range(40_000)]
    df = frame(data, "k string, y int, good double, noise1 double, noise2 double")
    got = {r["feature"]: r["importance"] for r in fr.rf_importance_by_group(df, "k", ["good", "noise1", "noise2"], "y", trees=10, seed=seed).collect()}
    assert got["good"] > 0.95


def test_rows_are_counted_in_blocks(frame, monkeypatch):
    """A level counts whole blocks: rows are not repeated for each tree, and blocks of any size give the same forest."""
    data = [(None if i % 3 else "a", i, float(i * 7 % 50), float(i % 4), int(i * 7 % 50 > 20 + i % 4)) for i in range(300)]
    df = frame(data * 2, "k string, i int, f double, g double, y int")
    grow = lambda: fr.rf_importance_by_group(df, "k", ["f", "g"], "y", 8, 3, 3, id_col="i")
    plans = []
    real = fr.best_splits
    monkeypatch.setattr(fr, "best_splits", lambda counts, key: (plans.append(counts._jdf.queryExecution().optimizedPlan().toString()), real(counts, key))[1])
    whole = rows(grow())
    assert len(plans) == 3 and not any("Generate" in p for p in plans)
    monkeypatch.setattr(fr, "BLOCK", 20)
    monkeypatch.setattr(fr, "TASK_BLOCKS", 1)
    assert rows(grow()) == whole


def test_draws_are_poisson():
    steps, draws = fr.poisson_steps(), [(a * r + b) % fr.FIELD for a, b in fr.tree_factors(40, 5) for r in range(1, 2_000_000_000, 4_000_037)]
    counts = Counter(sum(d >= s for s in steps) for d in draws)
    for n, share in enumerate((0.3679, 0.3679, 0.1839, 0.0613, 0.0153)):
        assert counts[n] / len(draws) == pytest.approx(share, abs=0.01)


def test_borders_of_bins(frame):
    data = [("a", float(i % 5), float(i)) for i in range(1000)] + [("a", 4.0, 1e9), ("b", 1.0, 2.0), (None, 3.0, 4.0)]
    got = {r["k"]: r["_borders"] for r in fr.bin_borders(frame(data, "k string, f double, g double"), "k", ["f", "g"], 8).collect()}
    assert got["a"][0] == [0.0, 1.0, 2.0, 3.0, 4.0] and got["b"] == [[1.0], [2.0]] and got[None] == [[3.0], [4.0]]
    assert len(got["a"][1]) == 8 and got["a"][1][-1] == 1e9 and all(120 <= y - x <= 130 for x, y in itertools.pairwise(got["a"][1][:-1]))


@pytest.mark.parametrize("chunk", [3, 10_000])
def test_whole_rows_packed_in_parts(frame, chunk):
    data = [(k, i, str(i)) for k, i in skewed()] + [("same", 1, "x")] * 50 + [(None, 2, None)]
    out = g.pack_rows(frame(data, "k string, i int, s string"), "k", "rows", chunk).collect()
    assert sorted(((r["k"], x["i"], x["s"]) for r in out for x in r["rows"]), key=repr) == sorted(data, key=repr)
    assert all(x["k"] == r["k"] for r in out for x in r["rows"]) and max(len(r["rows"]) for r in out) <= max(4 * chunk, 12) or chunk == 10_000


def test_stump_gain_against_brute_force(frame):
    data = [(k, y, good, noise, code) for k, y, good, noise, code in training(120)]
    got = fr.stump_gain(frame(data, "k string, y int, good double, noise double, code int"), "k", ["good", "noise", "code"], "y")

    def gini(ys):
        p = sum(ys) / len(ys) if ys else 0.0
        return 2 * p * (1 - p)

    for r in got.collect():
        at = {"good": 2, "noise": 3, "code": 4}[r["feature"]]
        mine = [(d[at], d[1]) for d in data if d[0] == r["k"]]
        ys = [y for _, y in mine]
        best = 0.0
        for cut in {x for x, _ in mine}:
            left, right = [y for x, y in mine if x <= cut], [y for x, y in mine if x > cut]
            best = max(best, gini(ys) - (len(left) * gini(left) + len(right) * gini(right)) / len(ys))
        assert r["gain"] == pytest.approx(best, abs=1e-12)


# --- distributions -------------------------------------------------------------------------


def test_histogram_against_numpy(frame):
    rng = np.random.default_rng(5)
    x = np.round(rng.exponential(60, size=500), 3)
    got = ds.histogram(frame([(float(v),) for v in x] + [(None,)], "x double"), "x", 50, 0, 1e9).orderBy("bin").collect()
    counts, _ = np.histogram(x, bins=50)
    assert [r["n"] for r in got] == counts.tolist()
    flat = ds.histogram(frame([(2.0,), (2.0,)], "x double"), "x", 4).orderBy("bin").collect()
    assert sum(r["n"] for r in flat) == 2


def test_category_counts(frame):
    df = frame([("b",), ("a",), ("a",), (None,), ("z",)], "c string")
    assert rows(ds.category_counts(df, "c", ["b", "a"])) == [("a", 2, 2), ("b", 1, 1), ("z", 1, 3)]


def test_density_against_numpy(frame):
    rng = np.random.default_rng(2)
    data = [("a", float(v)) for v in np.round(rng.normal(50, 10, 80), 1)] + [("b", float(v)) for v in np.round(rng.normal(90, 5, 40), 1)]
    data += [("flat", 3.0), ("flat", 3.0), ("a", None)]
    grid = [0.0, 40.0, 60.0, 95.0]
    got = {(r["is_all"], r["k"], r["point"]): r["density"] for r in ds.density(frame(data, "k string, x double"), "k", "x", grid).collect()}
    for key, is_all in (("a", 0), ("b", 0), (None, 1)):
        x = np.array([v for k, v in data if v is not None and (is_all or k == key)])
        bw = len(x) ** -0.2 * x.std(ddof=1)
        for p in grid:
            expected = np.exp(-0.5 * ((p - x) / bw) ** 2).sum() / (len(x) * bw * np.sqrt(2 * np.pi))
            assert got[is_all, key, p] == pytest.approx(expected, rel=1e-9)
    assert not any(k == "flat" for _, k, _ in got)


def test_density_of_large_values(frame):
    data = [("A", 1e8 + i) for i in range(5)] + [("B", 1e8 + 2.0), ("B", 1e8 + 2.0)]
    got = {(r["is_all"], r["k"]): r["density"] for r in ds.density(frame(data, "k string, x double"), "k", "x", [1e8 + 2]).collect()}
    x = np.array([v for _, v in data])
    for key, values in (((0, "A"), x[:5]), ((1, None), x)):
        bw = len(values) ** -0.2 * values.std(ddof=1)
        want = np.exp(-0.5 * ((1e8 + 2 - values) / bw) ** 2).sum() / (len(values) * bw * np.sqrt(2 * np.pi))
        assert abs(got[key] - want) < 1e-9
    assert (0, "B") not in got


def test_string_index_keeps_or_drops_nulls(frame):
    df = frame([(f"Public {i:03}",) for i in range(300)] + [("Public 007",), (None,), (None,)], "s string").repartition(5)
    kept = en.string_index(df, "s", "x").collect()
    index = {r["s"]: r["x"] for r in kept}
    order = ["Public 007"] + [f"Public {i:03}" for i in range(300) if i != 7]
    assert index == {s: float(i) for i, s in enumerate(order)} | {None: 300.0} and len(kept) == 303
    assert en.string_index(df, "s", "x", nulls="skip").count() == 301


def test_forest_with_an_outlier(frame):
    rng = np.random.default_rng(8)
    good, noise = rng.random(2000), rng.random(2000)
    noise[0] = 1e7
    data = [("k", float(a), float(b), int(a > 0.5)) for a, b in zip(good, noise)]
    out = fr.rf_importance_by_group(frame(data, "k string, good double, noise double, y int"), "k", ["good", "noise"], "y", trees=20)
    assert {r["feature"]: r["importance"] for r in out.collect()}["good"] > 0.85
