"""Queries for the composite dataflows: features, patterns, tests, summaries, matches, advice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.constants import BOOKS, DOMINANT_VECTORS
from fitlens.functions import text as ft
from fitlens.operators import distributions as ds
from fitlens.operators import keywords as kw
from fitlens.operators import ranking as rk
from fitlens.operators import vectors as vc
from fitlens.plans import alignment as al
from fitlens.plans import companies as co
from fitlens.plans import profiles as pf
from fitlens.session import stored
from workload.basics import stored_scores, tests, text_of
from workload.roles import UNIVERSITIES, Roles, query, sql
from workload.texts import three_rounds

SEED = 11


@query("c1_employment", sql("SELECT company_name, id FROM bridge"))
def c1(r: Roles) -> DataFrame:
    return r.bridge


@query(
    "c2_eligible_companies",
    sql("""SELECT company_name, count(*) AS n_members FROM bridge JOIN companies ON company_name = name
    GROUP BY 1 HAVING count(*) >= 110"""),
)
def c2(r: Roles) -> DataFrame:
    return co.eligible_companies(r.bridge, r.companies, 110)


def nested_profiles(r: Roles) -> DataFrame:
    """The people as nested profile rows, as a source would bring them."""
    p = r.people
    none = lambda name: F.lit(None).cast("string").alias(name)
    jobs = p.durations.select("id", F.struct("duration_short", none("subtitle")).alias("job")).union(
        p.employers.select("id", F.struct(none("duration_short"), F.col("company_name").alias("subtitle")))
    )
    parts = [
        p.education.groupBy("id").agg(F.collect_list(F.struct("degree")).alias("education")),
        jobs.groupBy("id").agg(F.collect_list("job").alias("experience")),
        p.causes.groupBy("id").agg(F.collect_list(F.struct("cause")).alias("volunteer_experience")),
    ]
    out = p.people.withColumnRenamed("current_company", "current_company:name")
    for part in parts:
        out = out.join(part, "id", "left")
    return stored(out)


@query("c1_nested_employment", sql("SELECT company_name, id FROM bridge"))
def c1_nested(r: Roles) -> DataFrame:
    """The bridge from nested profile rows by way of long tables."""
    return pf.employment(pf.flatten_profiles(nested_profiles(r)))


@query(
    "c6_nested_features",
    sql("""SELECT id, top_university, volunteering, average_months_of_experience, has_associate, has_bachelor, has_doctorate, has_master,
      coalesce((SELECT string_agg(DISTINCT cause, ',' ORDER BY cause) FROM causes c WHERE c.id = e.id), '') AS causes,
      coalesce((SELECT string_agg(DISTINCT value || '/' || coalesce(detail, ''), ',' ORDER BY value || '/' || coalesce(detail, ''))
        FROM volunteer_values v WHERE v.id = e.id), '') AS volunteer_values
    FROM engineered e"""),
)
def c6_nested(r: Roles) -> DataFrame:
    """Features of nested profile rows, each from its own row."""
    out = pf.engineer_rows(nested_profiles(r), UNIVERSITIES)
    values = F.flatten(F.transform(F.map_entries("values_from_volunteering"), lambda e: F.transform(e["value"], lambda w: F.concat_ws("/", e["key"], F.coalesce(w[1], F.lit(""))))))
    flags = ["has_associate", "has_bachelor", "has_doctorate", "has_master"]
    return out.select(
        "id", "top_university", "volunteering", "average_months_of_experience", *flags,
        F.array_join("causes", ",").alias("causes"), F.array_join(F.array_sort(values), ",").alias("volunteer_values"),
    )


@query("c3_org_types", sql("SELECT id, company_name, organization_type FROM org_types"))
def c3(r: Roles) -> DataFrame:
    return r.org_types


@query(
    "c4_degrees",
    sql("""SELECT id, coalesce(string_agg(degree, ',' ORDER BY degree), '') AS degrees
    FROM people LEFT JOIN levels USING (id) GROUP BY 1"""),
)
def c4(r: Roles) -> DataFrame:
    return pf.degrees(r.people).select("id", text_of("degrees").alias("degrees"))


@query(
    "c4_degrees_by_name",
    sql("""SELECT p.id, coalesce(d.degrees, '') AS degrees FROM people p LEFT JOIN (
      SELECT name, string_agg(DISTINCT degree, ',' ORDER BY degree) AS degrees
      FROM levels JOIN people USING (id) GROUP BY 1) d USING (name)
    WHERE p.id IN (SELECT id FROM education)"""),
)
def c4_by_name(r: Roles) -> DataFrame:
    shared = pf.degrees(r.people, by="name", drop_without_education=True)
    return shared.select("id", text_of("degrees").alias("degrees"))


@query(
    "c5_volunteering",
    sql("""SELECT id, volunteering, causes, n_values FROM engineered
    LEFT JOIN (SELECT id, string_agg(DISTINCT cause, ',' ORDER BY cause) AS causes FROM causes GROUP BY 1) USING (id)
    LEFT JOIN (SELECT id, count(DISTINCT value)::INTEGER AS n_values FROM volunteer_values GROUP BY 1) USING (id)"""),
)
def c5(r: Roles) -> DataFrame:
    causes = r.people.causes
    known = sorted(["Education", "Environment", "Arts and Culture", "Social Services", "Chess"])
    flags = causes.groupBy("id").agg(
        F.concat_ws(",", *[F.when(F.bool_or(F.col("cause") == c), F.lit(c)) for c in known]).alias("causes")
    )
    mapped = pf.values_map(pf.volunteer_values(causes)).select("id", F.size("values_from_volunteering").alias("n_values"))
    return r.engineered.select("id", "volunteering").join(flags, "id", "left").join(mapped, "id", "left")


@query(
    "c6_tenure",
    sql("SELECT id, name, months AS average_months_of_experience FROM people LEFT JOIN tenure USING (id)"),
)
def c6(r: Roles) -> DataFrame:
    return r.people.people.select("id", "name").join(pf.tenure(r.people.durations), "id", "left")


PATTERN_COLUMNS = [
    "volunteering_percentage", "top_university_percentage", "mean_post_duration", "variance_post_duration",
    "associate_percentage", "bachelor_percentage", "master_percentage", "doctorate_percentage",
]


@query(
    "c7_patterns",
    sql("""SELECT company_name, round(avg(volunteering) * 100, 6) AS volunteering_percentage,
    round(avg(top_university) * 100, 6) AS top_university_percentage,
    round(avg(average_months_of_experience), 6) AS mean_post_duration,
    round(var_samp(average_months_of_experience), 6) AS variance_post_duration,
    round(sum(has_associate) * 100.0::DOUBLE / sum(n), 6) AS associate_percentage,
    round(sum(has_bachelor) * 100.0::DOUBLE / sum(n), 6) AS bachelor_percentage,
    round(sum(has_master) * 100.0::DOUBLE / sum(n), 6) AS master_percentage,
    round(sum(has_doctorate) * 100.0::DOUBLE / sum(n), 6) AS doctorate_percentage,
    'Bachelor: ' || round(sum(has_bachelor) * 100.0::DOUBLE / sum(n), 2) || ' %, Associate: '
      || round(sum(has_associate) * 100.0::DOUBLE / sum(n), 2) || ' %, Master: '
      || round(sum(has_master) * 100.0::DOUBLE / sum(n), 2) || ' %, No Degree: '
      || round(count(*) FILTER (n = 0) * 100.0::DOUBLE / sum(n), 2) || ' %' AS degree_percentage
    FROM (SELECT b.company_name, e.*, has_associate + has_bachelor + has_master + has_doctorate AS n
      FROM bridge b JOIN eligible USING (company_name) JOIN engineered e USING (id)) GROUP BY 1"""),
)
def c7(r: Roles) -> DataFrame:
    r = r.staged()
    chosen = co.eligible_companies(r.bridge, r.companies)
    out = co.patterns(co.staff(r.bridge, chosen, r.engineered))
    return out.withColumns({c: F.round(c, 6) for c in PATTERN_COLUMNS})


def population(r: Roles, assign: str = "one") -> DataFrame:
    r = r.staged()
    return co.population(r.bridge, co.eligible_companies(r.bridge, r.companies), r.engineered, assign)


@query(
    "c8_ztests",
    sql("""SELECT company_name, feature, x1, n1, x2, n2, direction, round(z, 6) AS z, round(p_value, 6) AS p_value, round(log_p, 6) AS log_p FROM ztests"""),
)
def c8(r: Roles) -> DataFrame:
    out = co.ztests(population(r))
    return out.withColumns({c: F.round(c, 6) for c in ("z", "p_value", "log_p")})


@query(
    "c8_ztests_all_employers",
    sql("""SELECT company_name, x1, n1, x2, n2, round((x1::DOUBLE / n1 - x2::DOUBLE / n2)
      / sqrt(rate * (1 - rate) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)), 6) AS z
    FROM (SELECT *, (x1 + x2)::DOUBLE / (n1 + n2) AS rate FROM
      (SELECT company_name, sum(has_doctorate)::BIGINT AS x1, count(*) AS n1 FROM bridge JOIN eligible USING (company_name) JOIN engineered USING (id) GROUP BY 1),
      (SELECT sum(has_doctorate)::BIGINT AS x2, count(*) AS n2 FROM bridge JOIN eligible USING (company_name) JOIN engineered USING (id)))"""),
)
def c8_all(r: Roles) -> DataFrame:
    out = co.ztests(population(r, "all"), ["doctorate"])
    return out.select("company_name", "x1", "n1", "x2", "n2", F.round("z", 6).alias("z"))


@query(
    "c9_welch",
    sql("""SELECT company_name, n1, n2, round(mean1, 6) AS mean1, round(mean2, 6) AS mean2, round(t, 6) AS t,
    round(df, 4) AS df, round(p_value, 6) AS p_value, round(log_p, 5) AS log_p FROM ttests"""),
)
def c9(r: Roles) -> DataFrame:
    out = co.welch_tests(population(r))
    rounded = {c: F.round(c, 6) for c in ("mean1", "mean2", "t", "p_value")}
    return out.withColumns({**rounded, "df": F.round("df", 4), "log_p": F.round("log_p", 5)}).drop("var1", "var2")


def ranked(r: Roles) -> DataFrame:
    return rk.rank_features(tests(r), 0.5)


def company_values(r: Roles) -> DataFrame:
    return co.company_values(r.company_texts, r.lexicon)


def scores(r: Roles) -> DataFrame:
    """Happy and neutral scores of events, by the current company of the user."""
    people = r.people.people.select("id", F.col("current_company").alias("company_name"))
    events = r.table("events").select(F.col("user_id").alias("id"), stored_scores().alias("text"))
    return events.join(people, "id").select(
        "company_name",
        "id",
        ft.stored_score(F.col("text"), "happy1").cast("double").alias("happy_score"),
        ft.stored_score(F.col("text"), "neutral1").cast("double").alias("neutral_score"),
    )


EMOTION_SQL = """scored AS (
  SELECT current_company AS company_name, id,
    CASE WHEN event_type IN ('view', 'click') THEN printf('%.4f', value / 500)::FLOAT::DOUBLE END AS h,
    CASE WHEN event_type NOT IN ('view', 'click') THEN printf('%.4f', value / 500)::FLOAT::DOUBLE END AS n
  FROM events JOIN people ON user_id = id),
company_emotions AS (
  SELECT company_name, avg(h) AS avg_happy, avg(n) AS avg_neutral,
    CASE WHEN avg(h) IS NULL OR avg(n) IS NULL THEN NULL WHEN avg(h) > avg(n) THEN 'happy' ELSE 'neutral' END AS company_emotion
  FROM scored GROUP BY 1),
profile_emotions AS (
  SELECT id, CASE WHEN avg(h) IS NULL OR avg(n) IS NULL THEN NULL WHEN avg(h) > avg(n) THEN 'happy' ELSE 'neutral' END AS emotion
  FROM scored GROUP BY 1)"""


def profile_emotions(r: Roles) -> DataFrame:
    means = co.company_emotion(scores(r), "id")
    return means.select("id", F.col("company_emotion").alias("emotion"))


# Pixels of the companies' logos: the first three numbers of each vector as colours, by label.
THEME_SQL = f"""logos AS (SELECT n_name AS label, vec_id, list_transform(embedding[1:3], lambda x: (x::DOUBLE + 1) * 127.5) AS v
  FROM embeddings JOIN nation ON label % 25 = n_nationkey),
{three_rounds("logos")},
themes AS (SELECT label AS company_name, c AS cluster, '[' || string_agg(round(centre)::INT::VARCHAR, ', ' ORDER BY pos) || ']' AS colour FROM c3 GROUP BY 1, 2)"""


def themes(r: Roles) -> DataFrame:
    """``(company_name, cluster, colour)``: the two dominant colours of each logo, after three rounds, which SQL can follow."""
    pixel = F.transform(F.slice("embedding", 1, 3), lambda x: (x.cast("double") + 1) * 127.5)
    owner = r.table("nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("company_name"))
    logos = r.table("embeddings").select((F.col("label") % 25).alias("key"), pixel.alias("pixel")).join(owner, "key")
    centres = vc.dominant_vectors(logos, "company_name", "pixel", k=DOMINANT_VECTORS, rounds=3)
    return centres.select("company_name", "cluster", vc.colour_text(F.col("centre")).alias("colour"))


@query(
    "c10_company_summary",
    sql("""SELECT company_name, 'feature' AS section, rank::INTEGER AS rank, feature AS item, round(p_value, 5) AS p_value FROM ranked
    UNION ALL SELECT company_name, CASE WHEN source = 'slogan' THEN 'value_slogan' ELSE 'value_text' END, NULL, value, NULL
    FROM company_values UNION ALL SELECT company_name, 'theme', (cluster + 1)::INTEGER, colour, NULL FROM themes
    UNION ALL SELECT company_name, 'picture', NULL, company_emotion, NULL FROM company_emotions WHERE company_emotion IS NOT NULL""",
        f"{EMOTION_SQL},\n{THEME_SQL}"),
)
def c10(r: Roles) -> DataFrame:
    r = r.staged()
    out = co.company_summary(ranked(r), company_values(r), themes(r), co.company_emotion(scores(r)))
    return out.withColumn("p_value", F.round("p_value", 5))


def profile_values(r: Roles) -> DataFrame:
    features = pf.feature_values(r.engineered, pf.org_type_flags(r.org_types))
    return al.profile_values(features, pf.volunteer_values(r.people.causes), r.engineered)


@query(
    "c11_profile_summary",
    sql("""SELECT id, 'degree' AS section, degree AS item, NULL::VARCHAR AS source FROM levels JOIN people USING (id)
    UNION ALL SELECT id, 'average_tenure', months::VARCHAR, NULL FROM tenure WHERE months <> 0 AND id IN (SELECT id FROM people)
    UNION ALL SELECT id, 'top_university', educations_details, NULL FROM engineered WHERE top_university = 1
    UNION ALL SELECT DISTINCT id, 'volunteer', cause, NULL::VARCHAR FROM causes
    UNION ALL SELECT id, CASE WHEN source IS NULL THEN 'value_unsourced' ELSE 'value_sourced' END, value, source
    FROM profile_values"""),
)
def c11(r: Roles) -> DataFrame:
    r = r.staged()
    return al.profile_summary(r.engineered, r.people.causes, profile_values(r))


def value_matches(r: Roles) -> DataFrame:
    return al.match_values_pair(r.pairs, profile_values(r), company_values(r))


@query(
    "c12_match_values",
    sql("""SELECT id, company_name, value, profile_source, company_source FROM value_matches"""),
)
def c12(r: Roles) -> DataFrame:
    r = r.staged()
    return value_matches(r)


@query(
    "c12_match_values_from_text",
    sql("""SELECT b.id, b.company_name, c.value, max(c.source) AS company_source FROM bridge b
    JOIN (SELECT DISTINCT id, value FROM (
      SELECT c_custkey AS id, unnest(string_split(p_name, ' ')) AS word FROM customer
      JOIN part ON p_partkey = c_custkey % (SELECT count(*) FROM part)) JOIN first_values USING (word)) t ON t.id = b.id
    JOIN company_values c ON c.company_name = b.company_name AND c.value = t.value GROUP BY 1, 2, 3"""),
)
def c12_text(r: Roles) -> DataFrame:
    found = kw.match_values(kw.keywords(r.profile_words, "id", "text"), "id", r.lexicon, distinct=True)
    plain = found.withColumn("source", F.lit(None).cast("string"))
    return al.match_values_pair(r.bridge, plain, company_values(r)).drop("profile_source")


def pattern_matches(r: Roles) -> DataFrame:
    return al.match_patterns(r.pairs, al.profile_traits(r.engineered), ranked(r))


@query(
    "c13_match_patterns",
    sql("""SELECT id, company_name, feature, detail, round(p_value, 5) AS p_value FROM pattern_matches"""),
)
def c13(r: Roles) -> DataFrame:
    r = r.staged()
    return pattern_matches(r).withColumn("p_value", F.round("p_value", 5)).drop("log_p")


@query(
    "c14_match_label",
    sql("""SELECT b.id, b.company_name, emotion, company_emotion, (emotion = company_emotion)::INTEGER AS agree FROM bridge b
    JOIN profile_emotions p ON p.id = b.id JOIN company_emotions c ON c.company_name = b.company_name
    WHERE emotion IS NOT NULL AND company_emotion IS NOT NULL""", EMOTION_SQL),
)
def c14(r: Roles) -> DataFrame:
    return al.match_label(r.bridge, profile_emotions(r), co.company_emotion(scores(r)))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


BOOKS_SQL = (
    "books(book, template_id, template) AS (VALUES "
    + ", ".join(f"('{b}', {i}, {_quoted(t)})" for b, ts in BOOKS.items() for i, t in enumerate(ts))
    + ")"
)


def advice_sql(matches: str) -> str:
    """Ranked and capped sentences for ``matches`` given as SQL."""
    body = f"""SELECT id, company_name, section, rank::INTEGER AS rank, item, book,
    replace(replace(replace(replace(replace(replace(replace(replace(template, '{{company name}}', company_name), '{{core value}}', item),
      '{{company source}}', coalesce(company_source, '')), '{{profile source}}', coalesce(profile_source, '')),
      '{{university name}}', coalesce(detail, '')), '{{dominant profile emotion}}', coalesce(emotion, '')),
      '{{dominant company emotion}}', coalesce(company_emotion, '')), '{{colors}}', item) AS sentence
    FROM (SELECT *, row_number() OVER (PARTITION BY id, company_name, section ORDER BY seq, item) AS rank FROM ({matches}))
    JOIN (SELECT *, count(*) OVER (PARTITION BY book) AS size FROM books) USING (book)
    WHERE rank <= CASE section WHEN 'values' THEN 3 WHEN 'patterns' THEN 3 ELSE 1 END
      AND template_id = ('0x' || substr(md5('{SEED}|' || id || '|' || company_name || '|' || item), 1, 15))::BIGINT % size"""
    return body


VALUE_ENTRIES = """SELECT id, company_name, 'values' AS section, CASE WHEN profile_source IS NOT NULL AND company_source IS NOT NULL
      THEN 'value_both' WHEN company_source IS NOT NULL THEN 'value_company' WHEN profile_source IS NOT NULL THEN 'value_profile'
      ELSE 'value_neither' END AS book, -known::DOUBLE AS seq, value AS item, company_source, profile_source,
      NULL::VARCHAR AS detail, NULL::VARCHAR AS emotion, NULL::VARCHAR AS company_emotion FROM value_matches"""
PATTERN_ENTRIES = """SELECT id, company_name, 'patterns', feature, p_value, feature, NULL, NULL, detail, NULL, NULL FROM pattern_matches"""
PICTURE_ENTRIES = """SELECT b.id, b.company_name, 'picture', CASE WHEN emotion = company_emotion THEN 'picture_keep' ELSE 'picture_change' END,
      0.0, emotion, NULL, NULL, NULL, emotion, company_emotion FROM bridge b
      JOIN profile_emotions p ON p.id = b.id JOIN company_emotions c ON c.company_name = b.company_name
      WHERE emotion IS NOT NULL AND company_emotion IS NOT NULL"""
THEME_ENTRIES = """SELECT b.id, b.company_name, 'theme', 'theme', 0.0, colors, NULL, NULL, NULL, NULL, NULL FROM bridge b
      JOIN (SELECT company_name, string_agg(colour, ' and ' ORDER BY cluster) AS colors FROM themes GROUP BY 1) USING (company_name)"""


@query("c15_advice", sql(advice_sql(" UNION ALL ".join([VALUE_ENTRIES, PATTERN_ENTRIES, THEME_ENTRIES])), f"{BOOKS_SQL},\n{THEME_SQL}"))
def c15(r: Roles) -> DataFrame:
    r = r.staged()
    return al.advice(value_matches(r), pattern_matches(r), SEED, themes=al.pair_colours(r.pairs, themes(r)))


@query(
    "c16_align",
    sql(advice_sql(" UNION ALL ".join([VALUE_ENTRIES, PATTERN_ENTRIES, PICTURE_ENTRIES, THEME_ENTRIES])), f"{BOOKS_SQL},\n{EMOTION_SQL},\n{THEME_SQL}"),
)
def c16(r: Roles) -> DataFrame:
    r = r.staged()
    return al.align(
        r.bridge,
        profile_values(r),
        company_values(r),
        al.profile_traits(r.engineered),
        ranked(r),
        SEED,
        profile_emotions(r),
        co.company_emotion(scores(r)),
        themes(r),
    )


@query(
    "t6_known_sources_first",
    sql("""SELECT id, company_name, value, known, row_number() OVER (PARTITION BY id, company_name ORDER BY known DESC, value)::INTEGER
    AS rank FROM value_matches"""),
)
def t6(r: Roles) -> DataFrame:
    r = r.staged()
    ranked_matches = rk.known_sources_first(value_matches(r), al.PAIR, ["profile_source", "company_source"], "value")
    return ranked_matches.select("id", "company_name", "value", "known", "rank")


@query(
    "c17_company_emotion",
    sql("""SELECT company_name, round(avg_happy, 6) AS avg_happy, round(avg_neutral, 6) AS avg_neutral, company_emotion
    FROM company_emotions""", EMOTION_SQL),
)
def c17(r: Roles) -> DataFrame:
    out = co.company_emotion(scores(r))
    return out.withColumn("avg_happy", F.round("avg_happy", 6)).withColumn("avg_neutral", F.round("avg_neutral", 6))


# --- distributions -------------------------------------------------------------------------


@query(
    "c18_category_counts",
    sql("""SELECT degree, count(*) AS n, list_position(['Associate', 'Bachelor', 'Master', 'Doctorate'], degree)::INTEGER AS place
    FROM population WHERE degree IS NOT NULL GROUP BY 1"""),
)
def c18(r: Roles) -> DataFrame:
    return ds.category_counts(population(r), "degree", ["Associate", "Bachelor", "Master", "Doctorate"])


@query(
    "c18_histogram",
    """WITH ends AS (SELECT min(value) AS a, max(value) AS b FROM events),
    bins AS (SELECT least(floor((value - a) * 200 / (b - a)), 199)::BIGINT AS bin, count(*) AS n FROM events, ends GROUP BY 1)
    SELECT i AS bin, round(a + (b - a) * i / 200, 6) AS left, round(a + (b - a) * (i + 1) / 200, 6) AS right, coalesce(n, 0) AS n
    FROM ends, range(200) r(i) LEFT JOIN bins ON bin = i WHERE a + (b - a) * i / 200 <= 300 AND a + (b - a) * (i + 1) / 200 >= 0""",
)
def c18_histogram(r: Roles) -> DataFrame:
    out = ds.histogram(r.table("events"), "value")
    return out.withColumn("left", F.round("left", 6)).withColumn("right", F.round("right", 6))


GRID = [float(g) for g in range(0, 301, 12)]


@query(
    "c19_density",
    sql("""SELECT company_name, point, is_all, round(sum(exp(-0.5 * pow((point - x) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 8)
      AS density FROM (
      SELECT p.company_name, 0 AS is_all, average_months_of_experience AS x, n, bw FROM population p JOIN (
        SELECT company_name, count(*) AS n, pow(count(*)::DOUBLE, -0.2) * stddev_samp(average_months_of_experience) AS bw
        FROM population WHERE average_months_of_experience IS NOT NULL GROUP BY 1) s ON s.company_name = p.company_name
      WHERE bw > 0
      UNION ALL SELECT NULL, 1, average_months_of_experience, n, bw FROM population, (
        SELECT count(*) AS n, pow(count(*)::DOUBLE, -0.2) * stddev_samp(average_months_of_experience) AS bw
        FROM population WHERE average_months_of_experience IS NOT NULL)),
      (SELECT (i * 12)::DOUBLE AS point FROM range(26) g(i)) WHERE x IS NOT NULL GROUP BY 1, 2, 3"""),
)
def c19(r: Roles) -> DataFrame:
    out = ds.density(population(r), "company_name", "average_months_of_experience", GRID)
    return out.withColumn("density", F.round("density", 8))


SHIFTED = "SELECT c_mktsegment AS company_name, c_acctbal + 1e8::DOUBLE AS x FROM customer"


@query(
    "c9_welch_shifted",
    f"""WITH rows AS ({SHIFTED}),
    one AS (SELECT company_name, count(x) AS n1, avg(x) AS mean1, var_samp(x) AS var1 FROM rows GROUP BY 1),
    everyone AS (SELECT count(x) AS n2, avg(x) AS mean2, var_samp(x) AS var2 FROM rows)
    SELECT company_name, n1, n2, round(var2, 2) AS var2, round((mean1 - mean2) / sqrt(var1 / n1 + var2 / n2), 4) AS t FROM one, everyone""",
)
def c9_shifted(r: Roles) -> DataFrame:
    """Welch tests of large numbers: their squares must not cancel out."""
    rows = r.table("customer").select(F.col("c_mktsegment").alias("company_name"), (F.col("c_acctbal") + 1e8).alias("x"))
    out = co.welch_tests(rows, "x")
    return out.select("company_name", "n1", "n2", F.round("var2", 2).alias("var2"), F.round("t", 4).alias("t"))


@query(
    "c19_density_shifted",
    f"""WITH rows AS ({SHIFTED}),
    stats AS (SELECT company_name, 0 AS is_all, count(*) AS n, stddev_samp(x) AS s FROM rows GROUP BY 1
      UNION ALL SELECT NULL, 1, count(*), stddev_samp(x) FROM rows)
    SELECT s.company_name, is_all, point,
      round(sum(exp(-0.5 * pow((point - x) / (pow(n::DOUBLE, -0.2) * s), 2))) / (any_value(n) * any_value(pow(n::DOUBLE, -0.2) * s) * sqrt(2 * pi())), 9) AS density
    FROM stats s JOIN rows r ON is_all = 1 OR r.company_name = s.company_name,
      (SELECT 1e8::DOUBLE + i * 1000 AS point FROM range(11) g(i)) GROUP BY 1, 2, 3""",
)
def c19_shifted(r: Roles) -> DataFrame:
    rows = r.table("customer").select(F.col("c_mktsegment").alias("company_name"), (F.col("c_acctbal") + 1e8).alias("x"))
    out = ds.density(rows, "company_name", "x", [1e8 + 1000.0 * i for i in range(11)])
    return out.withColumn("density", F.round("density", 9))
