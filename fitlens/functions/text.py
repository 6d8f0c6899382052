"""Column functions on text: degree names, durations, name flags, templates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from fitlens.constants import DEGREE_CODES, DEGREE_SPELLINGS

# A duration such as "2 years 3 months"; both parts may be missing.
DURATION = r"^(?:(\d+)\s*years?)?\s*(?:(\d+)\s*months?)?"


def degree_level(text: Column) -> Column:
    """Degree named in ``text``, or NULL; the first level with a known spelling wins."""
    low = F.lower(text)
    level = F.lit(None).cast("string")
    for name, spellings in reversed(DEGREE_SPELLINGS.items()):
        hit = F.lit(False)
        for spelling in spellings:
            hit = hit | low.contains(spelling)
        level = F.when(hit, F.lit(name)).otherwise(level)
    return level


def degree_code(degree: Column) -> Column:
    """Number of a degree for the forests; no degree is 0."""
    code = F.when(degree.isNull(), 0)
    for name, number in DEGREE_CODES.items():
        code = code.when(degree == name, number)
    return code


def duration_months(text: Column, unparsed: str = "zero") -> Column:
    """Months in a duration text. Text without a duration counts 0, or NULL if asked."""
    years = F.regexp_extract(text, DURATION, 1)
    months = F.regexp_extract(text, DURATION, 2)
    total = F.coalesce(years.try_cast("int"), F.lit(0)) * 12 + F.coalesce(months.try_cast("int"), F.lit(0))
    known = text.isNotNull()
    if unparsed == "null":
        known = known & ((years != "") | (months != ""))
    return F.when(known, total)


def any_name(text: Column, names: Iterable[str]) -> Column:
    """1 if any of the names stands in the text as whole words, else 0 (also for NULL)."""
    listed = "|".join(re.escape(name.lower()) for name in names)
    pattern = rf"(?<![\p{{L}}\p{{N}}_])(?:{listed})(?![\p{{L}}\p{{N}}_])"
    return F.when(F.lower(text).rlike(pattern), 1).otherwise(0)


def percent_text(parts: Mapping[str, Column], total: Column) -> Column:
    """``name: share %`` for each part, comma-separated; a zero total leaves shares blank."""
    shares = [
        F.concat_ws("", F.lit(f"{name}: "), F.round(F.try_divide(n * F.lit(100.0), total), 2).cast("string"), F.lit(" %"))
        for name, n in parts.items()
    ]
    return F.concat_ws(", ", *shares)


def stored_score(text: Column, label: str) -> Column:
    """Score of one label in a serialised list of ``{score=…, label=…}`` entries."""
    return F.regexp_extract(text, rf"score=([0-9.]+), label={re.escape(label)}", 1).try_cast("float")


def dominant_label(happy: Column, neutral: Column) -> Column:
    """``happy`` only if strictly ahead; NULL unless both scores are known."""
    return F.when(
        happy.isNotNull() & neutral.isNotNull(),
        F.when(happy > neutral, F.lit("happy")).otherwise(F.lit("neutral")),
    )


def before_colon(text: Column) -> Column:
    return F.substring_index(text, ":", 1)


def after_colon(text: Column) -> Column:
    return F.regexp_replace(text, "^[^:]*:", "")


def fill_template(template: Column, values: Mapping[str, Column]) -> Column:
    """Put each value in place of its ``{placeholder}``; a NULL value becomes empty text."""
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value, F.lit("")))
    return out


def spaced_text(items: Column) -> Column:
    """Non-NULL items, each followed by one blank; a NULL array gives empty text."""
    kept = F.filter(items, lambda x: x.isNotNull())
    return F.coalesce(F.array_join(F.transform(kept, lambda x: F.concat(x, F.lit(" "))), ""), F.lit(""))


def md5_number(*parts: Column) -> Column:
    """Non-negative 60-bit number from the md5 of the parts, the same on every run."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
