"""Profile against company: shared values and traits, and advice in sentences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.constants import BOOKS, SECTION_LIMITS
from fitlens.functions.text import fill_template, md5_number
from fitlens.operators.ranking import top_per_section
from fitlens.session import stored
from fitlens.sources.io import books_df, dealt

PAIR = ["id", "company_name"]


def profile_values(
    feature_rows: DataFrame, volunteer_rows: DataFrame, engineered: DataFrame, text_values: DataFrame | None = None
) -> DataFrame:
    """Distinct ``(id, value, source)`` of all profiles; source is NULL for unsourced values.

    Degrees and employers give unsourced values, volunteering and a top university sourced ones
    (a value has one source; the university comes after volunteering and replaces it). Values
    found in the profile's text are used only if ``text_values(id, value)`` is given.
    """
    plain = feature_rows.filter("feature <> 'top_university'").select("id", "value")
    if text_values is not None:
        plain = plain.union(text_values.select("id", "value"))
    plain = plain.distinct().withColumn("source", F.lit(None).cast("string"))
    sourced = volunteer_rows.select("id", "value", "source").union(
        feature_rows.filter("feature = 'top_university'").select("id", "value", F.col("feature").alias("source"))
    )
    # The names of the two sources sort so that the university wins over volunteering by min.
    sourced = sourced.groupBy("id", "value").agg(F.min("source").alias("source"))
    return plain.union(sourced)


def profile_traits(engineered: DataFrame, strict: bool = False) -> DataFrame:
    """``(id, feature, detail)``: traits a company's significant features can be matched with.

    ``strict`` leaves volunteering out, which the original naming could never match.
    """
    def trait(name: str, flag: str, detail: F.Column) -> F.Column:
        return F.when(F.col(flag) == 1, F.struct(F.lit(name).alias("feature"), detail.alias("detail")))

    none = F.lit(None).cast("string")
    listed = [
        trait("master", "has_master", none),
        trait("doctorate", "has_doctorate", none),
        trait("top_university", "top_university", F.col("educations_details")),
    ]
    if not strict:
        listed.append(trait("volunteering", "volunteering", none))
    return engineered.select("id", F.explode(F.array_compact(F.array(*listed))).alias("t")).select("id", "t.*")


def profile_summary(
    engineered: DataFrame, causes: DataFrame, values: DataFrame, emotions: DataFrame | None = None
) -> DataFrame:
    """``(id, section, item, source)`` of all profiles.

    Sections: ``degree``, ``average_tenure``, ``top_university``, ``volunteer`` (causes),
    ``value_unsourced``, ``value_sourced`` and ``picture``.
    """
    none = F.lit(None).cast("string")

    def entry(section: str, item: F.Column) -> F.Column:
        return F.struct(F.lit(section).alias("section"), item.cast("string").alias("item"))

    own = F.concat(
        F.transform("degrees", lambda d: entry("degree", d)),
        F.array(
            F.when(F.col("average_months_of_experience") != 0, entry("average_tenure", F.col("average_months_of_experience"))),
            F.when(F.col("top_university") == 1, entry("top_university", F.col("educations_details"))),
        ),
    )
    parts = [
        engineered.select("id", F.explode(F.array_compact(own)).alias("e")).select("id", "e.*", none.alias("source")),
        causes.dropna().distinct().select("id", F.lit("volunteer").alias("section"), F.col("cause").alias("item"), none.alias("source")),
        values.select(
            "id",
            F.when(F.col("source").isNull(), "value_unsourced").otherwise("value_sourced").alias("section"),
            F.col("value").alias("item"),
            "source",
        ),
    ]
    if emotions is not None:
        parts.append(
            emotions.filter("emotion is not null").select(
                "id", F.lit("picture").alias("section"), F.col("emotion").alias("item"), none.alias("source")
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def match_values_pair(pairs: DataFrame, of_profiles: DataFrame, of_companies: DataFrame) -> DataFrame:
    """``(id, company_name, value, profile_source, company_source)``: shared values of each pair.

    Per value the match with the most known sources stays. All sources of a value on one side meet all on the other, so that is the
    known source of each side, if it has one: sides are cut to one row per value before they meet, and no match has to be ranked.
    """
    mine = of_profiles.groupBy("id", "value").agg(F.max("source").alias("profile_source"))
    # Stored, so that its size is known: companies are few, and then pairs stay where they are.
    theirs = stored(of_companies.groupBy("company_name", "value").agg(F.max("source").alias("company_source")))
    both = pairs.select(*PAIR).distinct().join(mine, "id").join(theirs, ["company_name", "value"])
    return both.select(*PAIR, "value", "profile_source", "company_source")


def match_patterns(pairs: DataFrame, traits: DataFrame, ranked: DataFrame) -> DataFrame:
    """``(id, company_name, feature, detail, p_value)``: significant features the profile has, with ``log_p`` where ranked has it.

    A matched doctorate hides a matched master's degree. It is matched if both the profile and the company have it, which each side
    knows before they meet.
    """
    tests = [c for c in ("p_value", "log_p") if c in ranked.columns]
    is_doctor = (F.col("feature") == "doctorate").alias("d")
    theirs = stored(ranked.filter("feature <> 'average_tenure'").select("company_name", "feature", *tests))
    wanted = theirs.select("company_name", is_doctor).groupBy("company_name").agg(F.bool_or("d").alias("_wanted"))
    has = traits.groupBy("id").agg(F.bool_or(is_doctor).alias("_doctor"), F.collect_list(F.struct("feature", "detail")).alias("_traits"))
    both = pairs.select(*PAIR).join(has, "id").join(wanted, "company_name")
    both = both.select(*PAIR, (F.col("_doctor") & F.col("_wanted")).alias("_hides"), F.explode("_traits").alias("t")).select(*PAIR, "_hides", "t.*")
    kept = both.join(theirs, ["company_name", "feature"]).filter("not (_hides and feature = 'master')")
    return kept.select(*PAIR, "feature", "detail", *tests)


def match_label(pairs: DataFrame, of_profiles: DataFrame, of_companies: DataFrame) -> DataFrame:
    """``(id, company_name, emotion, company_emotion, agree)`` where both labels are known."""
    theirs = stored(of_companies.select("company_name", "company_emotion"))
    known = pairs.select(*PAIR).join(of_profiles.select("id", "emotion"), "id").join(theirs, "company_name")
    known = known.filter("emotion is not null and company_emotion is not null")
    agree = F.when(F.col("emotion") == F.col("company_emotion"), 1).otherwise(0)
    return known.select(*PAIR, "emotion", "company_emotion", agree.alias("agree"))


ENTRY = [
    "section", "book", "seq", "item", "company_source", "profile_source", "detail", "emotion", "company_emotion", "colors",
]


def _entries(df: DataFrame, **columns: F.Column) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(*PAIR, *[columns.get(c, none).alias(c) for c in ENTRY])


def advice(
    values: DataFrame,
    traits: DataFrame,
    seed: int,
    labels: DataFrame | None = None,
    themes: DataFrame | None = None,
    books: Mapping[str, Sequence[str]] = BOOKS,
    limits: Mapping[str, int] = SECTION_LIMITS,
) -> DataFrame:
    """``(id, company_name, section, rank, item, book, sentence)`` for all pairs.

    Matches are ranked and capped first, so sentences are written only for those that stay. Each kind of match is a section and
    ranked by itself, so matches that lie together by person, as pairs dealt by ``id`` give them, are not shuffled again.
    The sentence is picked by a seeded hash of the pair and the item. ``labels`` is the result
    of ``match_label``; ``themes`` holds ``(id, company_name, colors)``.
    """
    known = F.col("profile_source").isNotNull().cast("int") + F.col("company_source").isNotNull().cast("int")
    value_book = (
        F.when(F.col("profile_source").isNotNull() & F.col("company_source").isNotNull(), "value_both")
        .when(F.col("company_source").isNotNull(), "value_company")
        .when(F.col("profile_source").isNotNull(), "value_profile")
        .otherwise("value_neither")
    )
    parts = [
        _entries(
            values,
            section=F.lit("values"),
            book=value_book,
            seq=-known.cast("double"),
            item=F.col("value"),
            company_source=F.col("company_source"),
            profile_source=F.col("profile_source"),
        ),
        _entries(
            traits,
            section=F.lit("patterns"),
            book=F.col("feature"),
            seq=F.col("log_p" if "log_p" in traits.columns else "p_value"),
            item=F.col("feature"),
            detail=F.col("detail"),
        ),
    ]
    if labels is not None:
        parts.append(
            _entries(
                labels,
                section=F.lit("picture"),
                book=F.when(F.col("agree") == 1, "picture_keep").otherwise("picture_change"),
                seq=F.lit(0.0),
                item=F.col("emotion"),
                emotion=F.col("emotion"),
                company_emotion=F.col("company_emotion"),
            )
        )
    if themes is not None:
        parts.append(
            _entries(
                themes, section=F.lit("theme"), book=F.lit("theme"), seq=F.lit(0.0), item=F.col("colors"), colors=F.col("colors")
            )
        )
    capped = [top_per_section(part, PAIR, "section", ["seq", "item"], limits) for part in parts]
    kept = capped[0]
    for part in capped[1:]:
        kept = kept.unionByName(part)
    size = F.lit(1)
    for book, texts in books.items():
        size = F.when(F.col("book") == book, len(texts)).otherwise(size)
    place = md5_number(F.lit(str(seed)), F.col("id"), F.col("company_name"), F.col("item")) % size
    templates = books_df(values.sparkSession, books)
    picked = kept.withColumn("template_id", place).join(templates, ["book", "template_id"])
    sentence = fill_template(
        F.col("template"),
        {
            "company name": F.col("company_name"),
            "core value": F.col("item"),
            "company source": F.col("company_source"),
            "profile source": F.col("profile_source"),
            "university name": F.col("detail"),
            "dominant profile emotion": F.col("emotion"),
            "dominant company emotion": F.col("company_emotion"),
            "colors": F.col("colors"),
        },
    )
    return picked.select(*PAIR, "section", "rank", "item", "book", sentence.alias("sentence"))


def pair_colours(pairs: DataFrame, themes: DataFrame) -> DataFrame:
    """``(id, company_name, colors)``: the dominant colours of each pair's company; a company has a few ``(cluster, colour)``."""
    names = F.array_sort(F.collect_list(F.struct("cluster", "colour")))
    per = themes.groupBy("company_name").agg(F.array_join(F.transform(names, lambda c: c["colour"]), " and ").alias("colors"))
    return pairs.select(*PAIR).join(stored(per), "company_name").select(*PAIR, "colors")


def align(
    pairs: DataFrame,
    of_profiles: DataFrame,
    of_companies: DataFrame,
    traits: DataFrame,
    ranked: DataFrame,
    seed: int,
    profile_emotions: DataFrame | None = None,
    company_emotions: DataFrame | None = None,
    themes: DataFrame | None = None,
) -> DataFrame:
    """Advice for many (profile, company) pairs, a stored table, in one job."""
    pairs = dealt(pairs, "id")
    labels = None
    if profile_emotions is not None and company_emotions is not None:
        labels = match_label(pairs, profile_emotions, company_emotions)
    colours = None if themes is None else pair_colours(pairs, themes)
    return advice(
        match_values_pair(pairs, of_profiles, of_companies),
        match_patterns(pairs, traits, ranked),
        seed,
        labels,
        colours,
    )
