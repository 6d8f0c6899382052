"""Near-duplicate documents by an LSH forest over MinHash signatures, with links confirmed on full shingle sets.

A signature is a row of bytes, one for each of 128 hash functions. Sixteen orders sort all signatures, each from another byte
on; neighbours in an order have the longest common prefixes. How deep that prefix is follows the region by itself: deep where
many documents share it, shallow elsewhere. Nothing is paired within a group, so work stays in proportion to the rows.

Documents with equal sets are one class from the start. Class representatives that are neighbours in some order and whose
signatures agree enough become candidates; their full sets decide. Links make components by label propagation on tables.

The orders are gone through three times. At first only the likeliest neighbours of a row become candidates, which connects most of
a group of near copies. The second time it is the likeliest neighbours in other components. Rows that have more of those than they
may propose go through the orders once more and bring their full sets along, so that all such pairs are decided where they meet:
only links that join components leave a task, not pairs. Each time a row gives rise to a bounded number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fitlens.llm.registry import query, table
from fitlens.session import stored

HASHES = 128
ORDERS = 16
# Neighbours in an order that a row is compared with: so many everywhere, and up to so many where a quarter of them are alike.
NEAR, REACH = 8, 64
# How many of them, the likeliest from either side, become candidates before there are components, and across components after.
BEST, SECOND = 1, 1
# Rows from the ends of ranges that are compared in one task.
EDGES = 4096
# Rows that are copied to all tasks at most, of 8 or 16 bytes each. More of them meet the others in a shuffle.
COPIED = 1_000_000
# Standard errors below the threshold that an estimated similarity may lie.
MARGIN = 4.5
# Rounds in which each component tries one pair.
ROUNDS = 2
# Words whose hashes a worker keeps, shingles hashed at once, and hashes of full sets that are compared or given out at once.
WORDS = 1 << 17
CHUNK = 1 << 12
SETS = 1 << 20

_RNG = np.random.default_rng(20240607)
_FACTORS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_MASKS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


class Shingles:
    """Shingle sets of texts as sorted 64-bit hashes."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.words: dict[bytes, int] = {}

    def of(self, text: str | None) -> np.ndarray:
        # bytes.lower touches A-Z only, and bytes.split parts at space and \\x09-\\x0D only.
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.words) > WORDS:
            self.words.clear()
        known = self.words
        hashes = np.fromiter((known[w] if w in known else known.setdefault(w, xxhash.xxh64_intdigest(w)) for w in words), np.uint64, len(words))
        k = min(self.k, len(words))
        out = np.full(len(words) - k + 1, len(words) if k < self.k else 0, np.uint64)
        for j in range(k):
            out = _mixed(out ^ hashes[j : len(words) - k + 1 + j])
        return np.unique(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signature(shingles: np.ndarray) -> bytes:
    """One byte of the smallest value of each hash function."""
    low = shingles.astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(low), CHUNK):
        part = low[i : i + CHUNK]
        np.minimum(least, ((part ^ _MASKS[:, None]) * _FACTORS[:, None]).min(1), out=least)
    # The smallest values of large sets begin with zeros, so the byte comes from all bits.
    return (_mixed(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8).tobytes()


def sign_documents(docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """``(id, n, digest, signature)``; digest of the set, null for an empty one."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(k)
        for batch in batches:
            rows = []
            for body in batch["text"]:
                s = shingles.of(body)
                rows.append((len(s), _digest(s), signature(s)) if len(s) else (0, None, None))
            out = pd.DataFrame(rows, columns=["n", "digest", "signature"])
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    source = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    # Ids go as strings: a column with nulls would turn into floats in pandas.
    source = source.withColumn("id", F.col("id").cast("string"))
    signed = source.mapInPandas(sign, "id string, n long, digest binary, signature binary")
    return signed.withColumn("id", F.col("id").cast("long"))


def _best(key: np.ndarray, same: np.ndarray, other: np.ndarray, best: int) -> np.ndarray:
    """Which entries are among the ``best`` of their key by agreement."""
    order = np.lexsort((other, -same, key))
    keys, places = key[order], np.arange(len(key))
    heads = np.concatenate([[True], keys[1:] != keys[:-1]])[: len(key)]
    rank = places - np.maximum.accumulate(np.where(heads, places, 0))
    out = np.zeros(len(key), bool)
    out[order[rank < best]] = True
    return out


def _alike(rows: pd.DataFrame, first: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (a, b) of rows from ``first`` on and of those before them that may be similar enough, and how many bytes agree.
    Rows with the same label are no pair."""
    share = percent / 100
    least = int(HASHES * (share - MARGIN * (share * (1 - share) / HASHES) ** 0.5))
    sigs = np.frombuffer(b"".join(rows["path"]), np.uint8).reshape(len(rows), HASHES)
    order, sizes, ids = rows["order"].to_numpy(), rows["n"].to_numpy(np.int64), rows["rep"].to_numpy(np.int64)
    groups = rows["label"].to_numpy(np.int64) if "label" in rows else ids
    hits = np.zeros(len(ids), np.int64)
    found = [np.zeros((0, 3), np.int64)]
    for j in range(1, REACH + 1):
        b = np.arange(max(j, first), len(ids))
        if j > NEAR:
            b = b[hits[b] * 4 >= j]  # on only where many documents are alike
        a = b - j
        small, large = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
        may = (order[a] == order[b]) & (100 * small >= percent * large) & (ids[a] != ids[b])
        a, b = a[may], b[may]
        same = (sigs[a] == sigs[b]).sum(1)
        a, b, same = a[same >= least], b[same >= least], same[same >= least]
        hits[b] += 1
        across = groups[a] != groups[b]
        found.append(np.stack([a[across], b[across], same[across]], 1))
    return tuple(np.concatenate(found).T)


def _proposals(percent: int, best: int) -> Callable[[pd.DataFrame, int], pd.DataFrame]:
    """Pairs ``(a, b, same)`` among the ``best`` of either end, and the ids ``more`` of both ends of every other pair."""

    def work(rows: pd.DataFrame, first: int) -> pd.DataFrame:
        a, b, same = _alike(rows, first, percent)
        ids = rows["rep"].to_numpy(np.int64)
        chosen = _best(a, same, b, best) | _best(b, same, a, best)
        more = np.unique(ids[np.concatenate([a[~chosen], b[~chosen]])])
        a, b = ids[a[chosen]], ids[b[chosen]]
        pairs = pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "same": same[chosen]}).drop_duplicates()
        return pd.concat([pairs, pd.DataFrame({"more": more})])

    return work


def _pieces(sizes: np.ndarray) -> list[int]:
    """Where to cut rows with sets of these sizes, first and last place included, so that a piece has ``SETS`` hashes or ``REACH`` rows."""
    ends, cuts = np.cumsum(sizes), [0]
    while cuts[-1] < len(sizes):
        done = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(min(len(sizes), max(cuts[-1] + REACH, int(np.searchsorted(ends, done + SETS, "right")))))
    return cuts


def _links(percent: int) -> Callable[[pd.DataFrame, int], pd.DataFrame]:
    """Links ``(a, b)`` by the full sets of the rows, as many as join their labels. Pairs whose labels are joined already are
    not tried again; all others are."""
    parent: dict[int, int] = {}

    def root(label: int) -> int:
        while (up := parent.get(label, label)) != label:
            parent[label] = parent.get(up, up)
            label = up
        return label

    def work(rows: pd.DataFrame, first: int) -> pd.DataFrame:
        cuts = _pieces(np.array([len(x) for x in rows["shingles"][first:]], np.int64))
        found = []
        for start, end in zip(cuts, cuts[1:]):
            before = max(0, first + start - REACH)
            found += piece(rows[before : first + end], first + start - before)
        return pd.DataFrame(found, columns=["a", "b"])

    def piece(rows: pd.DataFrame, first: int) -> list[tuple[int, int]]:
        a, b, _ = _alike(rows, first, percent)
        order = np.argsort(b, kind="stable")
        a, b = a[order], b[order]
        sets = rows["shingles"].to_list()
        sizes = np.array([len(s) for s in sets], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        marked = np.zeros(int(number.max()) + 1, bool)
        ids, labels = rows["rep"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        out = []
        heads = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])[: len(b)])
        for i, j in zip(heads.tolist(), [*heads[1:].tolist(), len(b)]):
            own = int(b[i])
            others = np.array([x for x in a[i:j].tolist() if root(int(labels[x])) != root(int(labels[own]))], np.int64)
            if not len(others):
                continue
            mine = number[starts[own] : starts[own + 1]]
            marked[mine] = True
            ends = np.cumsum(sizes[others])
            theirs = np.arange(ends[-1]) + np.repeat(starts[others] - ends + sizes[others], sizes[others])
            both = np.add.reduceat(marked[number[theirs]].astype(np.int64), ends - sizes[others])
            marked[mine] = False
            for x in others[100 * both >= percent * (sizes[others] + sizes[own] - both)].tolist():
                if (up := root(int(labels[x]))) != (down := root(int(labels[own]))):
                    parent[max(up, down)] = min(up, down)
                    out.append((min(ids[x], ids[own]), max(ids[x], ids[own])))
        return out

    return work


def sweep(classes: DataFrame, work_of: Callable[[], Callable[[pd.DataFrame, int], pd.DataFrame]], out: dict[str, str]) -> DataFrame:
    """The distinct results ``out`` of a fresh ``work_of()`` for each task, over all stretches of the sorted orders.

    classes: ``(rep, n, signature)`` and whatever else the work reads. It gets rows in order and the place of the first one that is
    new to it; ``REACH`` rows before that one stand there again. Where two ranges meet, the rows at their ends come together in blocks.
    """
    turn = HASHES // ORDERS
    turned = F.transform(
        F.sequence(F.lit(0), F.lit(ORDERS - 1)),
        lambda t: F.struct(
            t.cast("byte").alias("order"),
            F.concat(F.substring("signature", t * turn + 1, F.lit(HASHES)), F.substring("signature", F.lit(1), t * turn)).alias("path"),
        ),
    )
    own = [c for c in classes.columns if c != "signature"]
    rows = classes.select(*own, F.inline(turned))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    columns = out | {"part": "long", "place": "long"} | kinds

    def shaped(found: pd.DataFrame) -> pd.DataFrame:
        """With all columns; those that are missing are null."""
        number = ("long", "bigint", "int", "tinyint")
        missing = {c: np.full(len(found), np.nan) if k in number else np.full(len(found), None) for c, k in columns.items() if c not in found}
        return found.assign(**missing)[list(columns)]

    def alone(few: pd.DataFrame) -> pd.DataFrame:
        """Rows that do not hold on to the memory of their batch, of which arrays are views."""
        return few.assign(**{c: few[c].map(np.copy) for c, k in kinds.items() if k.startswith("array")})

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        work, head, last, n = work_of(), [], None, 0
        for batch in batches:
            if not len(batch):
                continue
            if n < REACH:
                head.append(alone(batch[: REACH - n]))
            n += len(batch)
            first = 0 if last is None else len(last)
            some = batch if last is None else pd.concat([last, batch], ignore_index=True)
            yield shaped(work(some, first))
            last = alone(some[-REACH:])
        if last is not None:
            edge = pd.concat([*head, last]).drop_duplicates(["order", "rep"])
            yield edge.assign(part=TaskContext.get().partitionId(), place=np.arange(len(edge))).pipe(shaped)

    def at_edges(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("at", ignore_index=True)
        return work_of()(some, int((some["at"] < key[0] * EDGES).sum())).reindex(columns=list(out))

    schema = ", ".join(f"`{c}` {k}" for c, k in columns.items())
    ranged = rows.repartitionByRange("order", "path", "rep").sortWithinPartitions("order", "path", "rep")
    swept = stored(ranged.mapInPandas(within, schema))
    edges = swept.filter("part IS NOT NULL").select("part", "place", *kinds)
    # One row for each range.
    starts = edges.groupBy("part").agg(F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    at = edges.join(starts, "part").withColumn("at", F.col("start") + F.col("place")).select("at", *kinds)
    block = F.floor(F.col("at") / EDGES)
    blocks = at.select("*", F.explode(F.array(block, F.when(F.col("at") % EDGES >= EDGES - REACH, block + 1))).alias("block")).filter("block IS NOT NULL")
    met = blocks.groupBy("block").applyInPandas(at_edges, ", ".join(f"`{c}` {k}" for c, k in out.items()))
    return swept.filter("part IS NULL").select(*out).union(met).distinct()


def candidates(classes: DataFrame, percent: int, best: int = BEST) -> tuple[DataFrame, DataFrame]:
    """Stored ``(a, b, same)``: pairs of neighbours in the sorted orders with signatures that agree in ``same`` bytes, the likeliest
ones of either end; and the ids ``rep`` of both ends of all others. classes: ``(rep, n, signature)``, and ``label`` if only
    pairs of different labels count."""
    found = stored(sweep(classes, lambda: _proposals(percent, best), {"a": "long", "b": "long", "same": "long", "more": "long"}))
    more = found.filter("more IS NOT NULL").select(F.col("more").alias("rep")).distinct()
    return found.filter("a IS NOT NULL").select("a", "b", "same"), more


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    return pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")


def full_sets(pairs: DataFrame, docs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """``(id, digest, shingles)`` of the documents in the pairs."""

    def rows(ids: list[int], found: list[np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame({"id": np.array(ids, np.int64), "digest": list(map(_digest, found)), "shingles": [x.view(np.int64) for x in found]})

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(k)
        for batch in batches:
            ids, found, size = [], [], 0
            for own, text in zip(batch["id"], batch["text"]):
                ids.append(own)
                found.append(shingles.of(text))
                size += len(found[-1])
                if size >= SETS:
                    yield rows(ids, found)
                    ids, found, size = [], [], 0
            if ids:
                yield rows(ids, found)

    needed = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(_copied(needed), "id", "left_semi")
    return texts.mapInPandas(sets, "id long, digest binary, shingles array<long>")


def _copied(rows: DataFrame) -> DataFrame:
    """Stored rows with the hint to copy them to all tasks, if they are few enough."""
    return F.broadcast(rows) if rows.limit(COPIED + 1).count() <= COPIED else rows


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The stored pairs ``(a, b)`` whose full sets are similar enough."""
    few = _copied(pairs.select("a", "b"))
    left = full.join(few, F.col("id") == F.col("a")).select("a", "b", F.col("shingles").alias("left"))
    right = full.join(few, F.col("id") == F.col("b")).select("a", "b", F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    joined = left.join(right, ["a", "b"])
    joined = joined.select("a", "b", both.alias("both"), (F.size("left") + F.size("right")).alias("all"))
    return joined.filter(F.col("both") * 100 >= (F.col("all") - F.col("both")) * percent).select("a", "b").distinct()


def connected(pairs: DataFrame, full: DataFrame, bridges: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The stored links ``(a, b)`` and ``(id, label)``: the smallest id that they lead to from each id in them.

    In a group of near copies a few of its many pairs connect it. So in every round each component tries one pair only, to the
    neighbour with the smallest label; then all pairs that still lead from one component to another are tried at once.
    """
    links, labels, left = stored(bridges), None, pairs
    high = int(HASHES * percent / 100)
    for last in (False,) * ROUNDS + (True,):
        if labels is None:
            across = left.select("a", "b", "same", F.col("a").alias("la"), F.col("b").alias("lb"))
        else:
            across = left.select("a", "b", "same")
            for end, label in (("a", "la"), ("b", "lb")):
                across = across.join(labels.select(F.col("id").alias(end), F.col("label").alias(label)), end, "left")
                across = across.withColumn(label, F.coalesce(label, end))
            across = across.filter("la <> lb")
        across = stored(across.select("a", "b", "same", "la", "lb"))
        if last:
            tried = across.select("a", "b")
        else:
            first = F.min(F.struct((F.col("same") < high).alias("low"), "other", (-F.col("same")).alias("unlike"), "a", "b")).alias("first")
            ends = across.select(F.col("la").alias("own"), F.col("lb").alias("other"), "a", "b", "same").union(across.select("lb", "la", "a", "b", "same"))
            tried = stored(ends.groupBy("own").agg(first).select("first.a", "first.b").distinct())
            left = across.join(tried, ["a", "b"], "left_anti").select("a", "b", "same")
        links = stored(links.union(confirmed(tried, full, percent)))
        labels = components(links)
    return links, labels


def joined_labels(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The stored classes with the labels that they have when links ``(a, b)`` between their ids join labels."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(classes.select(F.col("rep").alias(end), F.col("label").alias(f"l{end}")).distinct(), end)
    ends = stored(ends.filter("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct())
    if ends.isEmpty():
        return classes
    joined = components(ends).select(F.col("id").alias("label"), F.col("label").alias("joined"))
    return stored(classes.join(joined, "label", "left").withColumn("label", F.coalesce("joined", "label")).select(*classes.columns))


def components(links: DataFrame) -> DataFrame:
    """``(id, label)``: the smallest id reachable from each linked id.

    Each round takes the smallest label among the neighbours, then that label's own label, so chains halve. All rounds work on
    stored tables; it ends when no label changes.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).union(links.select("b", "a"))
    both = stored(both.distinct())
    labels = stored(both.groupBy("id").agg(F.least("id", F.min("other")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("id").alias("other"), F.col("label").alias("theirs")), "other").groupBy("id").agg(F.min("theirs").alias("theirs"))
        hooked = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "theirs").alias("label"))
        far = labels.select(F.col("id").alias("label"), F.col("label").alias("beyond"))
        jumped = stored(hooked.join(far, "label", "left").select("id", "old", F.least("label", "beyond").alias("label")))
        labels = jumped.select("id", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` of every document.

    A document's set has its distinct shingles of ``k`` words (A-Z lower-cased, parted at white space); with fewer words the
    whole sequence is the one shingle; null and empty texts have an empty set and are linked with nothing. Documents are linked
    if 100 * intersection >= percent * union of their full sets (of 64-bit shingle hashes). component_id is the smallest id
    reachable, kept says that it is the own one.

    Rows with one id are one node: links of any of them count. A null id is linked with nothing, has a null component and is
    kept. Extra columns do not matter.
    """
    signed = stored(sign_documents(docs, key, text, k))
    # One class for each distinct set, named by its smallest id.
    whole = signed.filter("id IS NOT NULL AND n > 0")
    classes = stored(whole.groupBy("digest").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature")))
    # An id with several sets links them.
    several = whole.groupBy("id").agg(F.min("digest").alias("first"), F.max("digest").alias("last")).filter("first <> last").select("id")
    bridges = whole.select("id", "digest").join(several, "id", "left_semi").join(classes.select("digest", "rep"), "digest")
    bridges = bridges.filter("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    pairs, _ = candidates(classes.drop("digest"), percent)
    links, labels = connected(pairs, stored(full_sets(pairs, docs, key, text, k)), bridges, percent)
    reached = classes.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").select("digest", "rep", "n", "signature", F.coalesce("label", "rep").alias("label"))
    reached = stored(reached)
    # The second time, pairs between components: the likeliest ones of each row,
    proposed, rest = candidates(reached.drop("digest"), percent, SECOND)
    proposed, rest = stored(_untried(proposed, pairs)), stored(rest)
    if not proposed.isEmpty():
        reached = joined_labels(reached, stored(confirmed(proposed, stored(full_sets(proposed, docs, key, text, k)), percent)))
    # and where there are more, all of them, by full sets that the rows bring along.
    if not rest.isEmpty():
        ends = rest.select(F.col("rep").alias("a"), F.col("rep").alias("b"))
        sets = full_sets(ends, docs, key, text, k).select("digest", "shingles").dropDuplicates(["digest"])
        crowded = stored(reached.join(rest, "rep").join(sets, "digest").drop("digest"))
        reached = joined_labels(reached, sweep(crowded, lambda: _links(percent), {"a": "long", "b": "long"}))
    labels = reached.select(F.col("rep").alias("id"), "label").distinct()
    named = classes.select("digest", "rep").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("digest", F.coalesce("label", "rep").alias("label"))
    out = signed.select("id", "n", "digest").join(named, "digest", "left")
    component = F.coalesce("label", "id")
    return out.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def distinct_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The kept documents with their own columns; of rows that repeat an id the one with the smallest text."""
    found = stored(near_duplicates(docs, key, text, k, percent).select(F.col(key).alias("id"), "kept"))
    # The documents' own columns are one struct, so that none of them can clash with the others.
    whole = docs.select(F.struct("*").alias("row"), F.col(key).alias("own_id"), F.col(text).alias("body"))
    gone = found.filter(~F.col("kept")).select("id").distinct()
    out = whole.join(gone, F.col("own_id") == F.col("id"), "left_anti")
    repeated = found.filter("kept AND id IS NOT NULL").groupBy("id").count().filter("count > 1").select("id")
    if repeated.isEmpty():
        return out.select("row.*")
    place = F.row_number().over(Window.partitionBy("own_id").orderBy("body"))
    again = out.join(repeated, F.col("own_id") == F.col("id"), "left_semi").select("row", place.alias("place")).filter("place = 1").select("row.*")
    return out.join(repeated, F.col("own_id") == F.col("id"), "left_anti").select("row.*").union(again)


@query("op9_lsh_forest")
def op9_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share most of their word pairs."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)
