"""Companies: who works there, what the staff have in common, what the texts say."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitlens.constants import MIN_EMPLOYEES
from fitlens.functions.stats import log_normal_two_sided, log_student_two_sided, two_proportion_z, welch_df, welch_t
from fitlens.functions.text import dominant_label, percent_text
from fitlens.operators.groups import eligible
from fitlens.operators.joins import drop_ambiguous
from fitlens.operators.keywords import first_values, keyword_array, lemmatise, nouns_and_adjectives
from fitlens.session import stored


def eligible_companies(bridge: DataFrame, companies: DataFrame, n: int = MIN_EMPLOYEES) -> DataFrame:
    """``(company_name, n_members)`` of companies that are known once and have ``n`` employees."""
    known = drop_ambiguous(companies.select(F.col("name").alias("company_name")), "company_name")
    return eligible(bridge, n).join(known, "company_name")


def staff(bridge: DataFrame, chosen: DataFrame, engineered: DataFrame) -> DataFrame:
    """Features of every employee of the chosen companies, one row per company and person."""
    return bridge.join(chosen.select("company_name"), "company_name", "left_semi").join(engineered, "id")


def patterns(staff_rows: DataFrame) -> DataFrame:
    """What the staff of each company have in common, one row per company.

    Degree shares relate to the number of degrees, as text (where staff without any may exceed
    100 %) and as numbers with doctorates.
    """
    n_degrees = F.sum(F.size("degrees"))
    counts = {
        "Bachelor": F.sum("has_bachelor"),
        "Associate": F.sum("has_associate"),
        "Master": F.sum("has_master"),
        "No Degree": F.count_if(F.size("degrees") == 0),
    }
    return staff_rows.groupBy("company_name").agg(
        (F.avg("volunteering") * 100).alias("volunteering_percentage"),
        (F.avg("top_university") * 100).alias("top_university_percentage"),
        F.avg("average_months_of_experience").alias("mean_post_duration"),
        F.var_samp("average_months_of_experience").alias("variance_post_duration"),
        percent_text(counts, n_degrees).alias("degree_percentage"),
        *[
            F.try_divide(F.sum(f"has_{d}") * 100.0, n_degrees).alias(f"{d}_percentage")
            for d in ("associate", "bachelor", "master", "doctorate")
        ],
    )


def population(bridge: DataFrame, chosen: DataFrame, engineered: DataFrame, assign: str = "one") -> DataFrame:
    """Rows the tests run on, with a 0/1 column per tested trait.

    ``one`` counts each person once, under the first of their chosen companies and the first of
    their degrees by name; ``all`` counts a person in every chosen company with all degrees.
    """
    jobs = bridge.join(chosen.select("company_name"), "company_name", "left_semi").select("company_name", "id")
    traits = ["volunteering", "top_university", "average_months_of_experience"]
    if assign == "all":
        return jobs.join(engineered, "id").select(
            "company_name", "id", *traits, F.col("has_doctorate").alias("doctorate"), F.col("has_master").alias("master")
        )
    once = jobs.groupBy("id").agg(F.min("company_name").alias("company_name"))
    degree = F.get("degrees", 0)
    return once.join(engineered, "id").select(
        "company_name",
        "id",
        *traits,
        degree.alias("degree"),
        F.when(degree == "Doctorate", 1).otherwise(0).alias("doctorate"),
        F.when(degree == "Master", 1).otherwise(0).alias("master"),
    )


FLAGS = ["volunteering", "top_university", "doctorate", "master"]
TENURE = "average_months_of_experience"


def company_sums(rows: DataFrame, flags: Sequence[str] = FLAGS, x: str = TENURE, key: str = "company_name") -> DataFrame:
    """All sums the tests need, per company, with those of everybody in the struct ``everybody``.

    The sums of the companies are stored, one row each, and those of everybody are summed up
    from them as a scalar subquery, so the rows are read once.
    """
    per = rows.groupBy(key).agg(
        F.count("*").alias("n1"),
        *[F.sum(f).alias(f) for f in flags],
        F.count(x).alias("nx1"),
        F.avg(x).alias("mean1"),
        F.var_samp(x).alias("var1"),
    )
    per = stored(per)
    n2, nx2 = F.sum("n1"), F.sum("nx1")
    # Squares are taken about the mean of everybody, so that large values do not cancel out.
    mean2 = per.agg(F.try_divide(F.sum(F.col("nx1") * F.col("mean1")), nx2).alias("m")).scalar()
    within = F.sum((F.col("nx1") - 1) * F.coalesce("var1", F.lit(0.0)))
    between = F.sum(F.col("nx1") * F.pow(F.col("mean1") - mean2, F.lit(2.0)))
    var2 = F.try_divide(F.coalesce(within, F.lit(0.0)) + F.coalesce(between, F.lit(0.0)), nx2 - 1)
    totals = F.struct(
        n2.alias("n2"), *[F.sum(f).alias(f) for f in flags], nx2.alias("nx2"), F.max(mean2).alias("mean2"), var2.alias("var2")
    )
    return per.withColumn("everybody", per.agg(totals.alias("t")).scalar())


def _z_rows(sums: DataFrame, flags: Sequence[str], key: str) -> DataFrame:
    """One row per company and flag with its counts, z, p-value, its logarithm and direction."""
    counts = [
        F.struct(F.lit(f).alias("feature"), F.col(f).alias("x1"), "n1", F.col(f"everybody.{f}").alias("x2"), "everybody.n2")
        for f in flags
    ]
    long = sums.select(key, F.explode(F.array(*counts)).alias("r")).select(key, "r.*")
    z = two_proportion_z(F.col("x1"), F.col("n1"), F.col("x2"), F.col("n2"))
    tested = long.withColumn("z", z).withColumn("log_p", log_normal_two_sided(F.col("z")))
    return tested.withColumns({"p_value": F.exp("log_p"), "direction": F.signum("z").cast("int")})


def _t_rows(sums: DataFrame, key: str) -> DataFrame:
    """One row per company with a known mean, its t, degrees of freedom, p-value and its logarithm."""
    wide = sums.filter("nx1 > 0").select(
        key,
        F.col("nx1").alias("n1"),
        "mean1",
        "var1",
        F.col("everybody.nx2").alias("n2"),
        "everybody.mean2",
        "everybody.var2",
    )
    t = welch_t(*[F.col(c) for c in ("mean1", "var1", "n1", "mean2", "var2", "n2")])
    df = welch_df(*[F.col(c) for c in ("var1", "n1", "var2", "n2")])
    tested = wide.withColumns({"t": t, "df": df}).withColumn("log_p", log_student_two_sided("t", "df"))
    return tested.withColumn("p_value", F.exp("log_p"))


def ztests(rows: DataFrame, flags: Sequence[str] = FLAGS, key: str = "company_name") -> DataFrame:
    """Two-proportion z-tests of every company and flag against everybody.

    ``direction`` is 1 where the company is above everybody, -1 below.
    """
    return _z_rows(company_sums(rows.withColumn(TENURE, F.lit(None).cast("double")), flags, key=key), flags, key)


def welch_tests(rows: DataFrame, x: str = TENURE, key: str = "company_name") -> DataFrame:
    """Welch t-tests of a number, every company against everybody; one row per company."""
    return _t_rows(company_sums(rows, [], x, key), key)


def all_tests(rows: DataFrame, key: str = "company_name") -> DataFrame:
    """``(company_name, feature, p_value, log_p, direction)`` of the z-tests and the tenure test, from one aggregate."""
    sums = company_sums(rows, key=key)
    z = _z_rows(sums, FLAGS, key).select(key, "feature", "p_value", "log_p", "direction")
    t = _t_rows(sums, key).select(
        key, F.lit("average_tenure").alias("feature"), "p_value", "log_p", F.signum("t").cast("int").alias("direction")
    )
    return z.unionByName(t)


def company_values(texts: DataFrame, lexicon: DataFrame, pos_lexicon: DataFrame | None = None, forms: DataFrame | None = None) -> DataFrame:
    """Distinct ``(company_name, value, source)``; source is ``slogan``, or NULL for other text.

    texts(company_name, scraped_data, about, slogan) is read once; a company may have several rows.
    ``pos_lexicon(word, tag)`` keeps nouns and adjectives only, ``forms(token, form)`` then puts words in their base form.
    """

    def found(text: str, source: Column) -> Column:
        return F.transform(keyword_array(F.col(text)), lambda w: F.struct(w.alias("word"), source.alias("source")))

    none = F.lit(None).cast("string")
    listed = F.concat(found("slogan", F.lit("slogan")), found("scraped_data", none), found("about", none))
    words = texts.select("company_name", F.explode(listed).alias("w")).select("company_name", "w.*")
    words = words if pos_lexicon is None else nouns_and_adjectives(words, pos_lexicon)
    words = words if forms is None else lemmatise(words, forms)
    return words.join(first_values(lexicon), "word").select("company_name", "value", "source").distinct()


def company_summary(
    ranked: DataFrame, values: DataFrame, themes: DataFrame | None = None, emotions: DataFrame | None = None
) -> DataFrame:
    """``(company_name, section, rank, item, p_value)`` of all companies.

    Sections: ``feature`` (significant traits by p-value), ``value_slogan``, ``value_text``,
    ``theme`` (dominant vectors of the logo, as text) and ``picture``.
    """
    none = F.lit(None).cast("double")
    parts = [
        ranked.select("company_name", F.lit("feature").alias("section"), "rank", F.col("feature").alias("item"), "p_value"),
        values.select(
            "company_name",
            F.when(F.col("source") == "slogan", "value_slogan").otherwise("value_text").alias("section"),
            F.lit(None).cast("int").alias("rank"),
            F.col("value").alias("item"),
            none.alias("p_value"),
        ),
    ]
    if themes is not None:
        parts.append(
            themes.select(
                "company_name",
                F.lit("theme").alias("section"),
                (F.col("cluster") + 1).cast("int").alias("rank"),
                F.col("colour").alias("item"),
                none.alias("p_value"),
            )
        )
    if emotions is not None:
        parts.append(
            emotions.filter("company_emotion is not null").select(
                "company_name",
                F.lit("picture").alias("section"),
                F.lit(None).cast("int").alias("rank"),
                F.col("company_emotion").alias("item"),
                none.alias("p_value"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def company_emotion(scores: DataFrame, key: str = "company_name") -> DataFrame:
    """Mean happy and neutral score per company and the label that prevails."""
    means = scores.groupBy(key).agg(F.avg("happy_score").alias("avg_happy"), F.avg("neutral_score").alias("avg_neutral"))
    return means.withColumn("company_emotion", dominant_label(F.col("avg_happy"), F.col("avg_neutral")))
