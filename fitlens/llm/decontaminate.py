"""Benchmark decontamination by winnowing, as DataFrame operations throughout.

A window of ten words holds six 5-grams; the smallest of their hashes is its fingerprint. Documents and benchmark keep the
distinct fingerprints of all their windows, so a span of ten or more words that both have is found for sure. Documents whose
fingerprints meet one of the benchmark get the windows behind it and compare them word by word at every place the fingerprint
stands; runs of equal windows extend to the whole shared span. Items shorter than a window are one window of their own length,
fingerprinted in the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import ascii_lower, query, table
from fitlens.session import stored

WINDOW = 10
GRAM = 5
# What stands between words, after A-Z have become lower case.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Fingerprints of the benchmark that go to all tasks: 16 bytes each, 16 MB in all. More of them meet the documents' in a shuffle.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    """Words of a text; of null none."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), BETWEEN), ""), F.array().cast("array<string>"))


def _grams(words: str, k: int) -> Column:
    """Hash of the k words from each place on."""
    hashes = F.transform(
        F.slice(F.col(words), 1, F.size(words) - (k - 1)), lambda w, i: F.xxhash64(w, *[F.get(F.col(words), i + j) for j in range(1, k)])
    )
    return F.when(F.size(words) >= k, hashes).otherwise(F.array().cast("array<bigint>"))


def _window_prints(words: str, grams: str, n: int) -> Column:
    """Fingerprint of the window of n words from each place on."""
    if n < GRAM:
        return _grams(words, n)
    m = n - GRAM + 1
    if m == 1:
        return F.col(grams)
    least = F.transform(
        F.slice(F.col(grams), 1, F.size(grams) - (m - 1)), lambda g, i: F.least(g, *[F.get(F.col(grams), i + j) for j in range(1, m)])
    )
    return F.when(F.size(grams) >= m, least).otherwise(F.array().cast("array<bigint>"))


def _window_text(words: str, place: Column, n: int) -> Column:
    return F.array_join(F.slice(F.col(words), place + 1, n), " ")


def _numbered(prints: Column, n: int) -> Column:
    return F.transform(prints, lambda p: F.struct(F.lit(n).alias("n"), p.alias("print")))


def _near(n: int, field: str) -> Column:
    """A field of the benchmark's windows of n words that may occur in the document."""
    return F.transform(F.filter("near", lambda x: x["n"] == n), lambda x: x[field])


def _spans(n: int) -> Column:
    """Occurrences of windows of n words: where a fingerprint stands, the words are compared."""
    at = F.transform(f"prints{n}", lambda p, i: F.when(F.array_contains(F.col(f"near_prints{n}"), p), i))
    spans = F.transform(
        F.filter(at, lambda i: i.isNotNull()),
        lambda i: F.struct(i.alias("start"), (i + n).alias("end"), _window_text("words", i, n).alias("window")),
    )
    return F.filter(spans, lambda x: F.array_contains(F.col(f"near_windows{n}"), x["window"]))


def benchmark_windows(benchmark: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """``(n, print, window, items)``: distinct windows of the items, with the items that have them."""
    words = benchmark.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("words"))
    words = words.filter(F.size("words") > 0).select("*", _grams("words", GRAM).alias("grams"))
    parts = []
    for n in range(1, window + 1):
        some = words.filter(F.size("words") >= n) if n == window else words.filter(F.size("words") == n)
        each = F.posexplode(_window_prints("words", "grams", n)).alias("place", "print")
        parts.append(
            some.select("item", "words", each).select(
                F.lit(n).alias("n"), "print", _window_text("words", F.col("place"), n).alias("window"), "item"
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.groupBy("n", "print", "window").agg(F.collect_set("item").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``(key, n_words, n_hit, n_items, items_sha256, contaminated)`` of every document.

    n_hit: words inside any occurrence of a window of the benchmark; n_items: items with occurring windows; items_sha256: of
    their ids, sorted as strings and joined by commas. Null and empty texts have no words and no hits, an item without words is
    never hit, items with a null id count as hits but not as items. Repeated rows and ids are judged by their own text; extra
    columns do not matter. Options: see ``_hits``.
    """
    hits = _hits(docs, benchmark, key, **options)
    return hits.select(
        F.col("_key").alias(key),
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that share no window with the benchmark, with their own columns."""
    # Stored, so that the filter does not go into the expressions that it filters by.
    found = stored(_hits(docs, benchmark, key, text, **options).select("_key", "_hash", "n_hit"))
    hit = found.filter("n_hit > 0").select("_key", "_hash").distinct()
    # The documents' own columns are one struct, so that none of them can clash with the others.
    whole = docs.select(F.struct("*").alias("row"), F.col(key).alias("own_id"), F.xxhash64(text).alias("own_hash"))
    same = F.col("own_id").eqNullSafe(F.col("_key")) & (F.col("own_hash") == F.col("_hash"))
    return whole.join(hit, same, "left_anti").select("row.*")


def _hits(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``(_key, _hash, n_words, n_hit, items)``; _hash tells apart texts under one id."""
    windows = stored(benchmark_windows(benchmark, item_key, item_text, window))
    lengths = [r.n for r in windows.select("n").distinct().orderBy("n").collect()]  # at most ``window`` rows
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    words = rows.select("_key", words_of(F.col("_text")).alias("words"))
    found_by = [_numbered(F.array_distinct(_window_prints("words", "grams", n)), n) for n in lengths]
    if not lengths:
        found_by = [F.array().cast("array<struct<n:int,print:bigint>>")]
    keys = windows.select("n", "print").distinct()
    keys = F.broadcast(keys) if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else keys
    prints = words.select("_key", "words", _grams("words", GRAM).alias("grams")).select("_key", F.inline(F.concat(*found_by)))
    # The documents' matches with the text of the windows, one row a document.
    matches = (
        prints.join(keys, ["n", "print"])
        .distinct()
        .join(windows, ["n", "print"])
        .groupBy("_key")
        .agg(F.collect_list(F.struct("n", "print", "window", "items")).alias("near"))
        .withColumnRenamed("_key", "_match")
    )
    # Texts move to their matches, not the longer arrays of words.
    joined = rows.join(matches, F.col("_key").eqNullSafe(F.col("_match")), "left")
    joined = joined.select("_key", F.xxhash64("_text").alias("_hash"), "near", words_of(F.col("_text")).alias("words"))
    joined = joined.select("_key", "_hash", "words", "near", F.when(F.col("near").isNotNull(), _grams("words", GRAM)).alias("grams"))
    joined = joined.select(
        "_key", "_hash", F.size("words").alias("n_words"), "words", "near",
        *[F.when(F.col("near").isNotNull(), _window_prints("words", "grams", n)).alias(f"prints{n}") for n in lengths],
        *[F.array_distinct(_near(n, "print")).alias(f"near_prints{n}") for n in lengths],
        *[_near(n, "window").alias(f"near_windows{n}") for n in lengths],
    )
    span = "array<struct<start:int,end:int,window:string>>"
    spans = F.lit(None).cast(span)
    if lengths:
        spans = F.array_sort(F.concat(*[_spans(n) for n in lengths])).cast(span)
    hits = joined.select("_key", "_hash", "n_words", "near", spans.alias("spans"))
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("upto"))
    covered = F.aggregate(
        "spans",
        start,
        lambda a, x: F.struct(
            (a["total"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["upto"]))).alias("total"),
            F.greatest(a["upto"], x["end"]).alias("upto"),
        ),
        lambda a: a["total"],
    )
    texts = F.array_distinct(F.transform("spans", lambda x: x["window"]))
    hits = hits.select("_key", "_hash", "n_words", "near", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"), texts.alias("texts"))
    items = F.array_sort(
        F.array_distinct(F.flatten(F.transform(F.filter("near", lambda x: F.array_contains(F.col("texts"), x["window"])), lambda x: x["items"])))
    )
    return hits.select("_key", "_hash", "n_words", "n_hit", F.coalesce(items, F.array().cast("array<string>")).alias("items"))


_PATTERN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_PATTERN})"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(len(w), {WINDOW}) AS n, unnest(generate_series(1, len(w) - least(len(w), {WINDOW}) + 1)) AS i
        FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""


@query("op10_winnowing", SQL)
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
