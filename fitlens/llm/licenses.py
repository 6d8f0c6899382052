"""License scan: canonical digests of whole texts, paragraphs and lines, hash-joined to known licences.

Texts are normalised (case, punctuation, copyright lines, equivalent spellings), digested, and joined with the digests of
known licences. Nothing is searched inside a unit: a unit is a licence if all of it is.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.license_texts import DIGESTS, LICENSES
from fitlens.llm.registry import query, table
from fitlens.sources.io import literal_rows

# Spellings that mean the same in a licence, as (pattern, replacement), applied in this order.
SPELLINGS = (
    ("licenc", "licens"),
    ("sub-licens", "sublicens"),
    ("non-commercial", "noncommercial"),
    ("non-infring", "noninfring"),
    ("copyright holder", "copyright owner"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("merchantibility", "merchantability"),
    ("https:", "http:"),
    ("&", " and "),
)
# A line that only names the owner, and the line that often follows it.
OWNER_LINE = r"(?m)^[^\S\n]*(?:copyright[^\S\n]*(?:\(c\)|©|[0-9]|<)|\(c\)|©|all rights reserved)[^\n]*$"
OTHER = r"[^\p{L}\p{N}\n]+"


def canonical(text: Column) -> Column:
    """Text in its canonical form; line breaks stay, all else that is no letter or digit is one space."""
    out = F.regexp_replace(F.lower(text), OWNER_LINE, "")
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(F.regexp_replace(out, OTHER, " "), r" ?\n ?", "\n")


def digest(part: Column) -> Column:
    return F.sha2(F.trim(F.regexp_replace(part, r"\s+", " ")), 256)


def known_digests(spark: SparkSession, licenses: Iterable[tuple[str, str, str, str]], digests: Iterable[tuple[str, str, str, str]] = ()) -> DataFrame:
    """``(digest, license, category, form)``, one row per digest; the first of equal texts counts. digests: such rows of texts
    that are not among the licences."""
    license, category, form, text = zip(*licenses)
    rows = literal_rows(
        spark,
        {"place": range(len(text)), "license": license, "category": category, "form": form, "text": text},
        {"place": pa.int32()} | dict.fromkeys(("license", "category", "form", "text"), pa.string()),
    )
    first = F.min_by(F.struct("license", "category", "form"), "place").alias("first")
    known = rows.groupBy(digest(canonical(F.col("text"))).alias("digest")).agg(first).select("digest", "first.*")
    if digests:
        names = ("digest", "license", "category", "form")
        known = known.union(literal_rows(spark, dict(zip(names, zip(*digests))), dict.fromkeys(names, pa.string())))
    return known


def scan_licenses(
    docs: DataFrame,
    licenses: Iterable[tuple[str, str, str, str]] = LICENSES,
    key: str = "doc_id",
    text: str = "text",
    digests: Iterable[tuple[str, str, str, str]] = DIGESTS,
) -> DataFrame:
    """``(key, unit, line, license, category, form)``, a row for each unit that is a known licence as a whole.

    unit: ``text`` (all of it), ``paragraph`` (between blank lines, if there are several) or ``line`` (if there are several);
    a paragraph of one line stands for itself and for its line. line: first line of the unit, from 1. Null and empty texts and
    units without letters or digits give no row; repeated rows and null keys are judged one by one; extra columns are left out.
    The known licences are parameters of a few hundred rows, local relations whose size the planner knows: texts, and digests of
    longer texts.
    """
    body = docs.select(F.col(key).alias("_key"), canonical(F.col(text)).alias("body"))
    body = body.select("_key", "body", F.split("body", "\n").alias("lines"), F.split(F.regexp_replace("body", r"^\n+|\n+$", ""), r"\n{2,}").alias("parts"))
    head = lambda line, i: F.when((line != "") & ((i == 0) | (F.get("lines", i - 1) == "")), i + 1)
    heads = F.filter(F.transform("lines", head), lambda n: n.isNotNull())
    unit = lambda kind, line, part: F.struct(F.lit(kind).alias("unit"), line.alias("line"), digest(part).alias("digest"))
    none = F.array().cast("array<struct<unit:string,line:int,digest:string>>")
    several = F.size("parts") > 1
    units = F.concat(
        F.array(unit("text", F.lit(1), F.col("body"))),
        F.when(several, F.zip_with("parts", heads, lambda part, line: unit("paragraph", line, part))).otherwise(none),
        F.when(
            several | F.contains("body", F.lit("\n")),
            F.filter(F.transform("lines", lambda line, i: F.when(line != "", unit("line", i + 1, line))), lambda u: u.isNotNull()),
        ).otherwise(none),
    )
    rows = body.select("_key", F.inline(units)).filter(F.col("digest") != EMPTY)
    found = rows.join(known_digests(docs.sparkSession, licenses, digests), "digest")
    return found.select(F.col("_key").alias(key), "unit", "line", "license", "category", "form")


# SHA-256 of the empty text.
EMPTY = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _sql() -> str:
    """The same for lines and whole texts in DuckDB."""
    out = r"regexp_replace(lower(text), '(?m)^[^\S\n]*(?:copyright[^\S\n]*(?:\(c\)|©|[0-9]|<)|\(c\)|©|all rights reserved)[^\n]*$', '', 'g')"
    for old, new in SPELLINGS:
        out = f"replace({out}, '{old}', '{new}')"
    form = rf"regexp_replace(regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g'), ' ?\n ?', chr(10), 'g')"
    known = ",\n".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in (str(i), *row)) + ")" for i, row in enumerate(LICENSES))
    sha = lambda x: rf"sha256(trim(regexp_replace({x}, '\s+', ' ', 'g')))"
    return f"""
WITH known0 AS (SELECT * FROM (VALUES {known}) AS v(place, license, category, form, text)),
known AS (
  SELECT digest, arg_min(license, place) AS license, arg_min(category, place) AS category, arg_min(form, place) AS form
  FROM (SELECT CAST(place AS INT) AS place, license, category, form, {sha(form)} AS digest FROM known0) GROUP BY digest),
body AS (SELECT doc_id, {form} AS body FROM documents),
lines AS (SELECT doc_id, body, string_split(body, chr(10)) AS l FROM body),
numbered AS (SELECT doc_id, unnest(l) AS part, generate_subscripts(l, 1) AS i, l FROM lines),
paragraphs AS (
  SELECT doc_id, run, min(i) AS i, string_agg(part, ' ' ORDER BY i) AS part, count(*) OVER (PARTITION BY doc_id) AS n
  FROM (SELECT doc_id, part, i, sum(CASE WHEN part = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM numbered)
  WHERE part <> '' GROUP BY doc_id, run),
units AS (
  SELECT doc_id, 'text' AS unit, 1 AS line, {sha("body")} AS digest FROM body
  UNION ALL SELECT doc_id, 'paragraph', i, {sha("part")} FROM paragraphs WHERE n > 1
  UNION ALL SELECT doc_id, 'line', i, {sha("part")} FROM numbered WHERE len(l) > 1 AND part <> '')
SELECT doc_id, unit, CAST(line AS INT) AS line, license, category, known.form AS form
FROM units JOIN known USING (digest) WHERE digest <> '{EMPTY}'"""


@query("op5_license_digests", _sql())
def op5_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every unit of every document that is a known licence."""
    return scan_licenses(table(spark, sf_dir, "documents"))
