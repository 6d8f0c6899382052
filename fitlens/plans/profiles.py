"""People: nested rows to long tables, and one row of features per person."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitlens.constants import (
    CAUSE_VALUES, DEGREES, DOCTORATE_VALUES, NONPROFIT_VALUES, SELF_EMPLOYED_VALUES, TOP_UNIVERSITIES,
    TOP_UNIVERSITY_VALUES, VOLUNTEER_VALUES,
)
from fitlens.functions.arrays import flags_to_names
from fitlens.functions.text import any_name, degree_level, duration_months
from fitlens.operators.joins import attach, null_safe_join
from fitlens.sources.io import rules_df


@dataclass(frozen=True)
class People:
    """Long tables about people. A person may have any number of rows in all but ``people``.

    people(id, name, educations_details, current_company) · education(id, degree) ·
    durations(id, duration_short) · employers(id, company_name) · causes(id, cause)
    """

    people: DataFrame
    education: DataFrame
    durations: DataFrame
    employers: DataFrame
    causes: DataFrame


def flatten_profiles(profiles: DataFrame) -> People:
    """Long tables from nested profile rows with the source's column names."""
    jobs = profiles.select("id", F.explode("experience").alias("job"))
    return People(
        people=profiles.select("id", "name", "educations_details", F.col("`current_company:name`").alias("current_company")),
        education=profiles.select("id", F.explode("education").alias("e")).select("id", "e.degree"),
        durations=jobs.select("id", "job.duration_short"),
        employers=jobs.select("id", F.col("job.subtitle").alias("company_name")),
        causes=profiles.select("id", F.explode("volunteer_experience").alias("v")).select("id", "v.cause"),
    )


def employment(p: People) -> DataFrame:
    """Distinct ``(company_name, id)``: the current employer and every past one."""
    now = p.people.select(F.col("current_company").alias("company_name"), "id")
    past = p.employers.select("company_name", "id")
    return now.union(past).dropna(subset=["company_name"]).distinct()


def degree_flags(education: DataFrame, by: Sequence[str] = ("id",)) -> DataFrame:
    """One 0/1 column per degree level, per person."""
    level = education.withColumn("level", degree_level(F.col("degree")))
    return level.groupBy(*by).agg(
        *[F.max(F.when(F.col("level") == d, 1).otherwise(0)).alias(f"has_{d.lower()}") for d in DEGREES]
    )


def degree_names() -> Column:
    """Array of the degree levels whose flag is set."""
    return flags_to_names([(d, F.col(f"has_{d.lower()}") == 1) for d in DEGREES])


def degrees(p: People, by: str = "id", drop_without_education: bool = False) -> DataFrame:
    """``(id, degrees)``; with ``by='name'`` namesakes share their degrees."""
    if by == "name":
        names = p.people.select("id", "name")
        flags = degree_flags(p.education.join(names, "id"), ["name"])
        out = null_safe_join(names, flags, ["name"], "left").select("id", degree_names().alias("degrees"))
    else:
        out = attach(p.people.select("id"), degree_flags(p.education), "id").select("id", degree_names().alias("degrees"))
    if drop_without_education:
        out = out.join(p.education.select("id"), "id", "left_semi")
    return out


def tenure(durations: DataFrame, unparsed: str = "zero") -> DataFrame:
    """``(id, average_months_of_experience)``, rounded to one decimal."""
    months = durations.select("id", duration_months(F.col("duration_short"), unparsed).alias("m"))
    return months.groupBy("id").agg(F.round(F.avg("m"), 1).alias("average_months_of_experience"))


def org_types_per_profile(bridge: DataFrame, companies: DataFrame) -> DataFrame:
    """Distinct ``(id, company_name, organization_type)`` over the known employers of a person."""
    known = companies.select(F.col("name").alias("company_name"), "organization_type")
    return bridge.join(known, "company_name").select("id", "company_name", "organization_type").distinct()


def org_type_flags(org_types: DataFrame) -> DataFrame:
    """Whether a person has worked for a nonprofit, or for themself."""
    return org_types.groupBy("id").agg(
        F.max(F.when(F.col("organization_type") == "Nonprofit", 1).otherwise(0)).alias("nonprofit"),
        F.max(F.when(F.col("organization_type") == "Self-Employed", 1).otherwise(0)).alias("self_employed"),
    )


def volunteer_values(causes: DataFrame) -> DataFrame:
    """``(id, value, source, detail)`` that volunteering implies; detail is the cause, if one does."""
    who = causes.select("id").distinct()
    general = who.select("id", F.explode(F.array(*[F.lit(v) for v in VOLUNTEER_VALUES])).alias("value"))
    rules = rules_df(causes.sparkSession, CAUSE_VALUES, "cause", "value")
    special = causes.distinct().join(rules, "cause").select("id", "value", F.col("cause").alias("detail"))
    return (
        general.withColumn("detail", F.lit(None).cast("string"))
        .unionByName(special)
        .select("id", "value", F.lit("volunteering").alias("source"), "detail")
    )


def values_map(values: DataFrame) -> DataFrame:
    """``(id, values_from_volunteering)``: the map view ``value -> [[source, detail], …]``.

    The entries of a person are bounded by the rule table.
    """
    per_value = values.groupBy("id", "value").agg(F.sort_array(F.collect_list(F.array("source", "detail"))).alias("why"))
    entries = F.sort_array(F.collect_list(F.struct("value", "why")))
    return per_value.groupBy("id").agg(F.map_from_entries(entries).alias("values_from_volunteering"))


def engineer(p: People, universities: Sequence[str] = TOP_UNIVERSITIES) -> DataFrame:
    """One row of features per person.

    Each long table is summed up per person on the map side; all joins are on ``id``, so the
    sums meet the people in one partitioning.
    """
    base = p.people.withColumn("top_university", any_name(F.col("educations_details"), universities))
    volunteers = p.causes.groupBy("id").agg(F.lit(1).alias("volunteering"))
    flags = [f"has_{d.lower()}" for d in DEGREES]
    out = attach(base, degree_flags(p.education), "id")
    out = attach(out, tenure(p.durations), "id")
    out = attach(out, volunteers, "id").fillna(0, subset=["volunteering", *flags])
    return out.withColumn("degrees", degree_names())


def _filled(items: Column) -> Column:
    """An array without its NULL elements; a NULL array has none."""
    return F.filter(items, lambda x: x.isNotNull())


def engineer_rows(profiles: DataFrame, universities: Sequence[str] = TOP_UNIVERSITIES) -> DataFrame:
    """Nested profile rows with the features of ``engineer`` beside their own columns, and with ``causes`` and
    ``values_from_volunteering`` as ``values_map`` gives them.

    Everything about a person stands in the person's row, so each feature is a function of the row's own arrays: one scan, no
    shuffle and no join, however many rows there are. NULL arrays and elements count as absent.
    """
    volunteered = _filled(F.col("volunteer_experience"))
    months = _filled(F.transform("experience", lambda job: duration_months(job["duration_short"])))
    total = F.aggregate(months, F.lit(0.0), lambda a, m: a + m)
    causes = F.coalesce(F.array_sort(F.array_distinct(_filled(F.transform(volunteered, lambda v: v["cause"])))), F.array().cast("array<string>"))
    has = {
        f"has_{d.lower()}": F.coalesce(F.exists("education", lambda e: degree_level(e["degree"]) == d), F.lit(False)).cast("int")  # noqa: B023
        for d in DEGREES
    }

    def value_of(cause: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, value in CAUSE_VALUES.items():
            out = F.when(cause == name, F.lit(value)).otherwise(out)
        return out

    why = lambda value, detail: F.struct(value.alias("value"), F.array(F.lit("volunteering"), detail).alias("why"))
    general = F.array(*[why(F.lit(v), F.lit(None).cast("string")) for v in VOLUNTEER_VALUES])
    special = F.filter(F.transform("causes", lambda c: why(value_of(c), c)), lambda e: e["value"].isNotNull())
    entries = F.concat(F.when(F.col("volunteering") == 1, general).otherwise(F.slice(general, 1, 0)), special)

    def by_value(found: Column) -> Column:
        own = lambda v: F.sort_array(F.transform(F.filter(found, lambda e: e["value"] == v), lambda e: e["why"]))
        values = F.array_sort(F.array_distinct(F.transform(found, lambda e: e["value"])))
        return F.map_from_entries(F.transform(values, lambda v: F.struct(v.alias("value"), own(v).alias("why"))))

    out = profiles.withColumns(
        {
            "top_university": any_name(F.col("educations_details"), universities),
            "volunteering": F.coalesce((F.size(volunteered) > 0).cast("int"), F.lit(0)),
            "average_months_of_experience": F.round(F.try_divide(total, F.size(months).cast("double")), 1),
            "causes": causes,
            **has,
        }
    )
    out = out.withColumn("degrees", degree_names())
    return out.withColumn("values_from_volunteering", F.transform(F.array(entries), by_value)[0])


def feature_values(engineered: DataFrame, org_flags: DataFrame) -> DataFrame:
    """``(id, feature, value)`` that a top university, a doctorate or the employers imply.

    A nonprofit employer hides self-employment.
    """
    rows = attach(engineered.select("id", "top_university", "has_doctorate"), org_flags, "id")

    def names(feature: str, values: Sequence[str]) -> Column:
        return F.transform(
            F.array(*[F.lit(v) for v in values]), lambda v: F.struct(F.lit(feature).alias("feature"), v.alias("value"))
        )

    none = F.array().cast("array<struct<feature:string,value:string>>")
    listed = F.concat(
        F.when(F.col("top_university") == 1, names("top_university", TOP_UNIVERSITY_VALUES)).otherwise(none),
        F.when(F.col("has_doctorate") == 1, names("degrees", DOCTORATE_VALUES)).otherwise(none),
        F.when(F.col("nonprofit") == 1, names("organization_types", NONPROFIT_VALUES))
        .when(F.col("self_employed") == 1, names("organization_types", SELF_EMPLOYED_VALUES))
        .otherwise(none),
    )
    return rows.select("id", F.explode(listed).alias("v")).select("id", "v.feature", "v.value")


def feature_values_struct(engineered: DataFrame, org_flags: DataFrame) -> DataFrame:
    """``(id, values_from_features)``: the same as one struct of three arrays per person."""
    rows = attach(engineered.select("id", "top_university", "has_doctorate"), org_flags, "id")

    def listed(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values])

    none = F.lit(None).cast("array<string>")
    return rows.select(
        "id",
        F.struct(
            F.when(F.col("top_university") == 1, listed(TOP_UNIVERSITY_VALUES)).otherwise(none).alias("top_university"),
            F.when(F.col("has_doctorate") == 1, listed(DOCTORATE_VALUES)).otherwise(none).alias("degrees"),
            F.when(F.col("nonprofit") == 1, listed(NONPROFIT_VALUES))
            .when(F.col("self_employed") == 1, listed(SELF_EMPLOYED_VALUES))
            .otherwise(none)
            .alias("company_and_organization_types"),
        ).alias("values_from_features"),
    )
