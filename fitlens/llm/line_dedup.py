"""Lines that many documents share, dropped from all of them but one, by DataFrame operators alone.

Lines are exploded, normalised and hashed; documents are counted per hash; lines over the threshold go, and the others are put
together by position. Only hashes and positions are shuffled to find them; a text moves once, and only to meet its own positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import ascii_lower, query, table
from fitlens.session import stored

CHARS, DOCUMENTS = 40, 5
# White space that is stripped.
WHITE = " \t\n\x0b\x0c\r"
# Shared keys that are copied to all tasks at most, of 24 bytes and the id each. More of them meet the lines in a shuffle.
COPIED = 200_000


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keys(rows: DataFrame, chars: int) -> DataFrame:
    """Every line of at least ``chars`` code points as its place and its key, a 16-byte hash, beside all columns but the text."""
    own = [c for c in rows.columns if c != "_text"]
    lines = rows.select(*own, F.posexplode(_lines(F.col("_text"))).alias("_place", "_line"))
    # Lower case leaves the length as it is, so only lines that are long enough are put into it.
    lines = lines.withColumn("_line", F.btrim("_line", F.lit(WHITE))).filter(F.char_length("_line") >= chars)
    return lines.select(*own, "_place", F.unhex(F.md5(ascii_lower(F.col("_line")))).alias("_key"))


def shared_lines(rows: DataFrame, documents: int) -> DataFrame:
    """``(_key, _keeper)``: hashes of the lines in at least ``documents`` ids, and the largest of these ids.

    rows: ``(_id, _key)``, repeated ones allowed. They are made distinct first, so the ids of a line that is everywhere are
    spread over all tasks, and each task sends one count for it.
    """
    pairs = rows.filter("_id IS NOT NULL").distinct()
    counted = pairs.groupBy("_key").agg(F.count("*").alias("_n"), F.max("_id").alias("_keeper"))
    return counted.filter(F.col("_n") >= documents).select("_key", "_keeper")


def drop_shared_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: int = CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """``(key, text, n_lines, n_dropped)`` of every row: the text without its shared lines, and the number of lines before.

    Texts are cut at ``\\n``; a null or empty text has one empty line. A line's key is the line without white space at its ends,
    A-Z lower-cased. Keys of at least ``chars`` code points in at least ``documents`` documents lose all their lines, except in
    the document with the largest id that holds them, which keeps all of its own.

    Rows with one id are one document, each with a text of its own. Rows with a null id count as no document and keep no shared
    line. Other columns are left out, whatever their names. Keys are compared by 128-bit hashes.
    """
    source = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    shared = stored(shared_lines(_keys(source, chars).select("_id", "_key"), documents))
    copied = F.broadcast(shared) if shared.limit(COPIED + 1).count() <= COPIED else shared
    # A text is named by its id and digest: rows that repeat both have the same positions, so sets of them stay bounded.
    named = source.withColumn("_digest", F.unhex(F.md5(F.coalesce("_text", F.lit("")))))
    lines = _keys(named, chars).join(copied, "_key")
    lost = lines.filter("_id IS NULL OR _id <> _keeper").groupBy(F.col("_id").alias("_i"), F.col("_digest").alias("_d"))
    lost = lost.agg(F.collect_set("_place").alias("_lost"))
    both = named.join(lost, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_digest") == F.col("_d")), "left")

    def put_together(whole: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(whole) - 1), F.col("_lost"))
        return F.array_join(F.transform(places, lambda i: F.get(whole, i)), "\n")

    # The lines are the one element of an array, so that they are cut once and not for each position.
    kept = F.transform(F.array(_lines(F.col("_text"))), put_together)[0]
    n_lines = F.char_length(F.coalesce("_text", F.lit(""))) - F.char_length(F.translate(F.coalesce("_text", F.lit("")), "\n", "")) + 1
    return both.select(
        F.col("_id").alias(key),
        F.when(F.col("_lost").isNull(), F.coalesce("_text", F.lit(""))).otherwise(kept).alias(text),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("_lost").isNull(), 0).otherwise(F.size("_lost")).cast("long").alias("n_dropped"),
    )


ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {DOCUMENTS}),
m AS (SELECT k.*, f.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY r, doc_id"""


@query("op13_line_dedup", ORACLE)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that four others or more share."""
    kept = drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
