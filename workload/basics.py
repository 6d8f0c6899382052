"""Queries for sources, filters, joins, aggregates, windows, ranks, set operations and functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.constants import DEGREES
from fitlens.functions import arrays as fa
from fitlens.functions import text as ft
from fitlens.operators import groups as g
from fitlens.operators import joins as j
from fitlens.operators import ranking as rk
from fitlens.operators import rows as rw
from fitlens.operators.sampling import sample_per_group
from fitlens.plans import companies as co
from fitlens.plans import profiles as pf
from fitlens.session import shared_folder
from fitlens.sources import io
from workload.roles import Roles, query, sql


def text_of(column: str) -> F.Column:
    """A list column as text, so that engines agree on its form."""
    return F.array_join(F.col(column).cast("array<string>"), ",")


def words(column: str = "p_name") -> F.Column:
    return F.split(column, " ")


# --- sources and sinks ---------------------------------------------------------------------


@query("s1_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def s1(r: Roles) -> DataFrame:
    return r.table("orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey")


@query(
    "s4_literal_rows",
    sql("""SELECT value, count(*) AS n FROM part, lexicon
    WHERE list_contains(string_split(p_name, ' '), word) GROUP BY 1"""),
)
def s4(r: Roles) -> DataFrame:
    listed = r.table("part").select(F.explode(words()).alias("word"))
    return listed.join(r.lexicon, "word").groupBy("value").agg(F.count("*").alias("n"))


@query(
    "s5_clean_scraped",
    """SELECT source AS name, lang AS website, text AS scraped_text FROM documents
    WHERE lang <> 'fr' AND text IS NOT NULL""",
)
def s5(r: Roles) -> DataFrame:
    raw = r.table("documents").select(
        F.col("source").alias("name"),
        F.nullif("lang", F.lit("fr")).alias("website"),
        F.col("text").alias("scraped_text"),
        "n_chars",
    )
    return io.clean_scraped(raw)


@query(
    "s6_slice_rows",
    """SELECT c_custkey, c_mktsegment FROM customer
    QUALIFY row_number() OVER (ORDER BY c_mktsegment, c_custkey) > 401""",
)
def s6(r: Roles) -> DataFrame:
    return io.slice_rows(r.table("customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment", "c_custkey"], 401)


@query(
    "s6_slice_between",
    """SELECT o_orderkey, o_orderpriority FROM orders
    QUALIFY row_number() OVER (ORDER BY o_orderpriority, o_orderkey) BETWEEN 402 AND 1000""",
)
def s6_between(r: Roles) -> DataFrame:
    rows = r.table("orders").select("o_orderkey", "o_orderpriority")
    return io.slice_rows(rows, ["o_orderpriority", "o_orderkey"], 401, 1000)


# --- projections and filters ---------------------------------------------------------------


@query(
    "p1_project",
    """SELECT event_id AS id, event_type AS kind, round(value * 2, 2) AS doubled,
    string_split(event_type, 'i')[1] AS head FROM events""",
)
def p1(r: Roles) -> DataFrame:
    nested = r.table("events").select(
        "event_id", F.struct(F.col("event_type").alias("kind"), "value").alias("event"), F.split("event_type", "i").alias("parts")
    )
    return nested.select(
        F.col("event_id").alias("id"),
        "event.kind",
        F.round(F.col("event.value") * 2, 2).alias("doubled"),
        F.col("parts")[0].alias("head"),
    )


@query("p2_drop", "SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def p2(r: Roles) -> DataFrame:
    return r.table("part").drop("p_type", "p_size")


@query("p3_not_null", "SELECT p_partkey, p_brand AS brand FROM part WHERE p_brand <> 'Brand#1'")
def p3(r: Roles) -> DataFrame:
    rows = r.table("part").select("p_partkey", F.nullif("p_brand", F.lit("Brand#1")).alias("brand"))
    return rows.filter(F.col("brand").isNotNull())


@query(
    "p4_rich",
    r"""SELECT doc_id FROM documents WHERE len(string_split(text, chr(10))) > 2 AND len(string_split(text, ' ')) > 50""",
)
def p4(r: Roles) -> DataFrame:
    rows = r.table("documents").select("doc_id", F.split("text", "\n").alias("lines"), F.split("text", " ").alias("words"))
    return rw.rich_profiles(rows, lines=2, words=50).select("doc_id")


@query(
    "p5_all_text",
    """SELECT doc_id, source, lang FROM documents WHERE source <> 'src1' AND lang <> 'en'""",
)
def p5(r: Roles) -> DataFrame:
    rows = r.table("documents").select(
        "doc_id", F.nullif("source", F.lit("src1")).alias("source"), F.nullif("lang", F.lit("en")).alias("lang")
    )
    return rw.with_all_text(rows, ["source", "lang"])


@query(
    "p6_has_items",
    """SELECT p_partkey, CASE WHEN list_contains(string_split(p_name, ' '), 'red') THEN 1 ELSE 0 END AS has_red FROM part""",
)
def p6(r: Roles) -> DataFrame:
    found = F.filter(words(), lambda w: w == "red")
    items = F.when(F.size(found) > 0, found)
    return r.table("part").select("p_partkey", fa.has_items(items).alias("has_red"))


@query(
    "p7_any_name",
    r"""SELECT doc_id, CASE WHEN regexp_matches(lower(text), '(^|[^\p{L}\p{N}_])(the and|est|sch|und der)($|[^\p{L}\p{N}_])')
    THEN 1 ELSE 0 END AS named FROM documents""",
)
def p7(r: Roles) -> DataFrame:
    names = ["The and", "est", "sch", "und der"]
    return r.table("documents").select("doc_id", ft.any_name(F.col("text"), names).alias("named"))


@query(
    "p8_null_replacement",
    """SELECT p_partkey, coalesce(nullif(p_size, 7), -1) AS size,
    CASE WHEN p_brand = 'Brand#2' THEN 0 ELSE len(string_split(p_name, ' ')) END::INTEGER AS n_words FROM part""",
)
def p8(r: Roles) -> DataFrame:
    rows = r.table("part").select(
        "p_partkey",
        F.nullif("p_size", F.lit(7)).alias("size"),
        F.when(F.col("p_brand") != "Brand#2", words()).alias("words"),
    )
    return rows.fillna(-1, subset=["size"]).select("p_partkey", "size", F.size(fa.or_empty(F.col("words"))).alias("n_words"))


@query("p9_label", sql("SELECT id AS employee_id, company_name AS negative_company_name, 1 AS label FROM bridge"))
def p9(r: Roles) -> DataFrame:
    labelled = r.bridge.withColumn("label", F.lit(1))
    return labelled.withColumnRenamed("company_name", "negative_company_name").withColumnRenamed("id", "employee_id")


@query("p10_feature_values", sql("SELECT id, feature, value FROM feature_values"))
def p10(r: Roles) -> DataFrame:
    return pf.feature_values(r.engineered, pf.org_type_flags(r.org_types))


@query(
    "p11_typed_null",
    sql("""SELECT e.id, CASE WHEN top_university = 1 THEN 'Excellence,Learning' END AS from_university,
    CASE WHEN has_doctorate = 1 THEN 'Excellence,Autonomy,Learning' END AS from_degrees,
    CASE WHEN nonprofit THEN 'Contribution,Meaningful work,Community' WHEN self_employed THEN 'Accountability,Autonomy' END
      AS from_employers
    FROM engineered e LEFT JOIN (
      SELECT id, max(organization_type = 'Nonprofit') AS nonprofit, max(organization_type = 'Self-Employed') AS self_employed
      FROM org_types GROUP BY id) w ON w.id = e.id"""),
)
def p11(r: Roles) -> DataFrame:
    rows = pf.feature_values_struct(r.engineered, pf.org_type_flags(r.org_types))
    v = "values_from_features"
    return rows.select(
        "id",
        F.array_join(f"{v}.top_university", ",").alias("from_university"),
        F.array_join(f"{v}.degrees", ",").alias("from_degrees"),
        F.array_join(f"{v}.company_and_organization_types", ",").alias("from_employers"),
    )


@query("p12_for_company", sql("SELECT company_name, id FROM bridge WHERE company_name = 'NATION_3'"))
def p12(r: Roles) -> DataFrame:
    return rw.for_company(r.bridge, "NATION_3")


# --- joins ---------------------------------------------------------------------------------


@query(
    "j1_attach",
    """SELECT c_custkey, c_name, n_orders FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_totalprice > 400000 GROUP BY 1)
    ON c_custkey = o_custkey""",
)
def j1(r: Roles) -> DataFrame:
    n = r.table("orders").filter("o_totalprice > 400000").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders")
    )
    return j.attach(r.table("customer").select("c_custkey", "c_name"), n, "c_custkey")


@query("j2_inner", sql("SELECT company_name, id, organization_type FROM bridge JOIN companies ON company_name = name"))
def j2(r: Roles) -> DataFrame:
    both = r.bridge.join(r.companies, F.col("company_name") == F.col("name"))
    return both.select("company_name", "id", "organization_type")


@query("j3_inner_two_columns", sql("SELECT id, name, value FROM people JOIN volunteer_values USING (id)"))
def j3(r: Roles) -> DataFrame:
    extra = pf.volunteer_values(r.people.causes).select("id", "value")
    return r.people.people.select("id", "name").join(extra, "id")


@query(
    "j4_full_outer",
    sql("""SELECT coalesce(a.company_name, b.company_name) AS company_name, coalesce(a.id, b.id) AS id,
    CASE WHEN a.id IS NULL THEN 0 ELSE 1 END AS is_current, CASE WHEN b.id IS NULL THEN 0 ELSE 1 END AS is_past
    FROM (SELECT current_company AS company_name, id FROM people) a
    FULL JOIN (SELECT DISTINCT company_name, id FROM past) b ON a.company_name = b.company_name AND a.id = b.id"""),
)
def j4(r: Roles) -> DataFrame:
    now = r.people.people.select(F.col("current_company").alias("company_name"), "id")
    return j.bridge_full_outer(now, r.people.employers.select("company_name", "id"))


def _named_parts(r: Roles) -> DataFrame:
    return r.table("part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("name"), "p_size")


@query(
    "j5_drop_ambiguous",
    """SELECT p_partkey, p_name || ' ' || p_brand AS name, p_size FROM part
    QUALIFY count(*) OVER (PARTITION BY p_name, p_brand) = 1""",
)
def j5(r: Roles) -> DataFrame:
    return j.drop_ambiguous(_named_parts(r), "name")


@query(
    "j6_ambiguous_rows",
    """SELECT p_partkey, p_name || ' ' || p_brand AS name, p_size FROM part
    QUALIFY count(*) OVER (PARTITION BY p_name, p_brand) > 1""",
)
def j6(r: Roles) -> DataFrame:
    return j.ambiguous_rows(_named_parts(r), "name")


@query("j8_filtered_pairs", "SELECT c_custkey, n_name FROM customer, nation WHERE c_nationkey = n_nationkey")
def j8(r: Roles) -> DataFrame:
    both = r.table("customer").join(r.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return both.select("c_custkey", "n_name")


@query(
    "j9_reattach_features",
    sql("""SELECT b.company_name, b.id, e.top_university, e.volunteering, e.average_months_of_experience AS months
    FROM bridge b LEFT JOIN engineered e ON e.id = b.id AND e.average_months_of_experience > 30"""),
)
def j9(r: Roles) -> DataFrame:
    features = r.engineered.filter("average_months_of_experience > 30").select(
        "id", "top_university", "volunteering", F.col("average_months_of_experience").alias("months")
    )
    return r.bridge.join(features, "id", "left").select("company_name", "id", "top_university", "volunteering", "months")


# --- aggregates ----------------------------------------------------------------------------


@query(
    "a1_ids_by",
    """SELECT o_custkey, part, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS order_keys FROM (
      SELECT o_custkey, o_orderkey,
        ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 15))::BIGINT % ceil(count(*) OVER (PARTITION BY o_custkey) / 8)::BIGINT AS part
      FROM orders) GROUP BY 1, 2""",
)
def a1(r: Roles) -> DataFrame:
    lists = g.ids_by(r.table("orders"), "o_custkey", "o_orderkey", "order_keys", chunk=8)
    return lists.withColumn("order_keys", text_of("order_keys"))


@query("a2_avg_months", sql("SELECT id, months AS average_months_of_experience FROM tenure"))
def a2(r: Roles) -> DataFrame:
    return pf.tenure(r.people.durations)


@query("a3_counts", "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def a3(r: Roles) -> DataFrame:
    return g.counts(r.table("events"), "event_type", "user_id")


@query("a4_having", "SELECT p_name || ' ' || p_brand AS name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def a4(r: Roles) -> DataFrame:
    return j.repeated_keys(_named_parts(r), "name")


@query(
    "a5_org_types",
    sql("""SELECT id, 0::BIGINT AS part, string_agg(company_name || ':' || organization_type, ',' ORDER BY company_name || ':' || organization_type) AS org_types
    FROM org_types GROUP BY 1"""),
)
def a5(r: Roles) -> DataFrame:
    pairs = r.org_types.select("id", F.struct("company_name", "organization_type").alias("pair"))
    named = pairs.select("id", F.concat_ws(":", "pair.company_name", "pair.organization_type").alias("org"))
    lists = g.ids_by(named, "id", "org", "org_types")
    return lists.select("id", "part", text_of("org_types").alias("org_types"))


@query("a6_causes", sql("SELECT id, 0::BIGINT AS part, string_agg(DISTINCT cause, ',' ORDER BY cause) AS causes FROM causes GROUP BY 1"))
def a6(r: Roles) -> DataFrame:
    return g.ids_by(r.people.causes, "id", "cause", "causes").select("id", "part", text_of("causes").alias("causes"))


@query(
    "a7_conditional_counts",
    sql("""SELECT company_name, count(*) AS n, count(*) FILTER (volunteering = 1) AS volunteers,
    count(*) FILTER (top_university = 1) AS top_university, count(*) FILTER (degree = 'Doctorate') AS doctors,
    count(*) FILTER (degree = 'Master') AS masters FROM population GROUP BY 1"""),
)
def a7(r: Roles) -> DataFrame:
    rows = co.population(r.bridge, co.eligible_companies(r.bridge, r.companies), r.engineered)
    return rows.groupBy("company_name").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("volunteering") == 1).alias("volunteers"),
        F.count_if(F.col("top_university") == 1).alias("top_university"),
        F.count_if(F.col("degree") == "Doctorate").alias("doctors"),
        F.count_if(F.col("degree") == "Master").alias("masters"),
    )


@query("a8_eligible", sql("SELECT company_name, count(DISTINCT id) AS n_members FROM bridge GROUP BY 1 HAVING count(DISTINCT id) >= 110"))
def a8(r: Roles) -> DataFrame:
    return g.eligible(r.bridge, 110)


@query(
    "a10_dedup",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1""",
)
def a10(r: Roles) -> DataFrame:
    rows = r.table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return g.dedup(rows, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"])


@query("a10_distinct", "SELECT DISTINCT source, lang FROM documents")
def a10_distinct(r: Roles) -> DataFrame:
    return r.table("documents").select("source", "lang").distinct()


@query(
    "a11_array_distinct",
    """SELECT doc_id, len(list_distinct(string_split(text, ' ')))::INTEGER AS n_words FROM documents""",
)
def a11(r: Roles) -> DataFrame:
    return r.table("documents").select("doc_id", F.size(F.array_distinct(words("text"))).alias("n_words"))


@query(
    "a12_moments",
    """SELECT event_type, grouping(event_type)::INTEGER AS is_all, count(value) AS n, round(avg(value), 6) AS mean,
    round(var_samp(value), 4) AS variance FROM events GROUP BY ROLLUP (event_type)""",
)
def a12(r: Roles) -> DataFrame:
    out = g.moments(r.table("events"), "event_type", "value")
    return out.withColumn("mean", F.round("mean", 6)).withColumn("variance", F.round("variance", 4))


# --- windows -------------------------------------------------------------------------------


@query(
    "w1_collect_over",
    sql("""SELECT p.id, p.name, coalesce(d.degrees, '') AS degrees FROM people p LEFT JOIN (
      SELECT name, string_agg(DISTINCT degree, ',' ORDER BY degree) AS degrees
      FROM levels JOIN people USING (id) GROUP BY 1) d USING (name)"""),
)
def w1(r: Roles) -> DataFrame:
    level = r.people.education.select("id", ft.degree_level(F.col("degree")).alias("level"))
    rows = r.people.people.select("id", "name").join(level, "id", "left")
    shared = g.collect_over(rows, "name", "level", DEGREES, "degrees")
    return shared.select("id", "name", text_of("degrees").alias("degrees")).distinct()


def _staff(r: Roles) -> DataFrame:
    return r.bridge.join(r.engineered, "id").select(
        "company_name", "id", "volunteering", "top_university", "average_months_of_experience", "has_master", "has_doctorate"
    )


@query(
    "w2_pct_over",
    sql("""SELECT company_name, id, round(avg(volunteering) OVER w * 100, 6) AS volunteering_percentage,
    round(avg(top_university) OVER w * 100, 6) AS top_university_percentage
    FROM bridge JOIN engineered USING (id) WINDOW w AS (PARTITION BY company_name)"""),
)
def w2(r: Roles) -> DataFrame:
    out = g.pct_over(
        _staff(r), "company_name", {"volunteering_percentage": "volunteering", "top_university_percentage": "top_university"}
    )
    return out.select(
        "company_name",
        "id",
        F.round("volunteering_percentage", 6).alias("volunteering_percentage"),
        F.round("top_university_percentage", 6).alias("top_university_percentage"),
    )


@query(
    "w3_moments_over",
    sql("""SELECT company_name, id, round(avg(average_months_of_experience) OVER w, 6) AS mean_post_duration,
    round(var_samp(average_months_of_experience) OVER w, 6) AS variance_post_duration
    FROM bridge JOIN engineered USING (id) WINDOW w AS (PARTITION BY company_name)"""),
)
def w3(r: Roles) -> DataFrame:
    out = g.moments_over(
        _staff(r), "company_name", "average_months_of_experience", "mean_post_duration", "variance_post_duration"
    )
    return out.select(
        "company_name",
        "id",
        F.round("mean_post_duration", 6).alias("mean_post_duration"),
        F.round("variance_post_duration", 6).alias("variance_post_duration"),
    )


@query(
    "w4_cond_counts_over",
    sql("""SELECT company_name, id, count(*) FILTER (has_master = 1) OVER w AS masters,
    count(*) FILTER (has_doctorate = 1) OVER w AS doctors
    FROM bridge JOIN engineered USING (id) WINDOW w AS (PARTITION BY company_name)"""),
)
def w4(r: Roles) -> DataFrame:
    out = g.cond_counts_over(
        _staff(r), "company_name", {"masters": F.col("has_master") == 1, "doctors": F.col("has_doctorate") == 1}
    )
    return out.select("company_name", "id", "masters", "doctors")


@query(
    "w5_sample_per_group",
    """SELECT o_orderpriority, o_orderkey FROM (
      SELECT o_orderpriority, o_orderkey, count(*) FILTER (o_orderstatus = 'P') OVER (PARTITION BY o_orderpriority) AS lim,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7|' || o_orderkey), o_orderkey) AS rn FROM orders)
    WHERE rn <= lim""",
)
def w5(r: Roles) -> DataFrame:
    rows = r.table("orders").select("o_orderpriority", "o_orderkey", "o_orderstatus")
    limited = g.cond_counts_over(rows, "o_orderpriority", {"lim": F.col("o_orderstatus") == "P"})
    return sample_per_group(limited, "o_orderpriority", "o_orderkey", "lim", 7).select("o_orderpriority", "o_orderkey")


# --- sort, limit, top-k --------------------------------------------------------------------


@query("t1_sort", sql("SELECT company_name, id FROM bridge ORDER BY company_name, id"))
def t1(r: Roles) -> DataFrame:
    return r.bridge.orderBy("company_name", "id")


@query("t2_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t2(r: Roles) -> DataFrame:
    return r.table("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query(
    "t3_first_row",
    """SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus = 'F'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def t3(r: Roles) -> DataFrame:
    rows = r.table("orders").filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey", "o_orderdate")
    return rk.top_per_group(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 1).select("o_custkey", "o_orderkey")


@query(
    "t4_top_per_section",
    """SELECT user_id, event_type, event_id, rank::INTEGER AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS rank FROM events)
    WHERE rank <= CASE event_type WHEN 'view' THEN 3 WHEN 'click' THEN 3 WHEN 'signup' THEN 1 WHEN 'error' THEN 1 ELSE 0 END""",
)
def t4(r: Roles) -> DataFrame:
    rows = r.table("events").select("user_id", "event_type", "event_id", "value")
    limits = {"view": 3, "click": 3, "signup": 1, "error": 1}
    order = [F.desc("value"), "event_id"]
    return rk.top_per_section(rows, ["user_id"], "event_type", order, limits).drop("value")


def tests(r: Roles) -> DataFrame:
    return co.all_tests(co.population(r.bridge, co.eligible_companies(r.bridge, r.companies), r.engineered))


@query(
    "t5_rank_features",
    sql("""SELECT company_name, feature, direction, round(p_value, 5) AS p_value, rank::INTEGER AS rank FROM ranked"""),
)
def t5(r: Roles) -> DataFrame:
    ranked = rk.rank_features(tests(r), 0.5)
    return ranked.select("company_name", "feature", "direction", F.round("p_value", 5).alias("p_value"), "rank")


# --- set operations ------------------------------------------------------------------------


@query(
    "u1_union",
    sql("""SELECT id, current_company AS company_name, 1 AS label FROM people
    UNION ALL SELECT id, company_name, 0 FROM past"""),
)
def u1(r: Roles) -> DataFrame:
    now = r.people.people.select("id", F.col("current_company").alias("company_name"), F.lit(1).alias("label"))
    past = r.people.employers.select(F.lit(0).alias("label"), "company_name", "id")
    return now.unionByName(past)


@query("u2_difference", sql("SELECT company_name, id FROM past EXCEPT SELECT current_company, id FROM people"))
def u2(r: Roles) -> DataFrame:
    past = r.people.employers.select("company_name", "id")
    return past.subtract(r.people.people.select(F.col("current_company").alias("company_name"), "id"))


@query(
    "u3_array_union",
    """SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(string_split(p_name, ' '),
    string_split(lower(p_type), 'o')))), ',') AS merged FROM part""",
)
def u3(r: Roles) -> DataFrame:
    merged = F.array_union(words(), F.split(F.lower("p_type"), "o"))
    return r.table("part").select("p_partkey", F.array_join(F.sort_array(merged), ",").alias("merged"))


@query(
    "u4_flatten",
    """SELECT p_partkey, array_to_string(list_concat(string_split(p_name, ' '),
    CASE WHEN p_brand = 'Brand#3' THEN [] ELSE string_split(p_type, 'O') END), ',') AS merged FROM part""",
)
def u4(r: Roles) -> DataFrame:
    types = F.when(F.col("p_brand") != "Brand#3", F.split("p_type", "O"))
    nested = F.array(words(), fa.or_empty(types))
    return r.table("part").select("p_partkey", F.array_join(F.flatten(nested), ",").alias("merged"))


# --- functions -----------------------------------------------------------------------------


@query(
    "f1_degree",
    sql("""SELECT e.id, e.degree, CASE degree WHEN 'BSc Economics' THEN 'Bachelor' WHEN 'Master of Arts' THEN 'Master'
    WHEN 'PhD' THEN 'Doctorate' WHEN 'Associate degree' THEN 'Associate' END AS level FROM education e"""),
)
def f1(r: Roles) -> DataFrame:
    return r.people.education.withColumn("level", ft.degree_level(F.col("degree")))


@query(
    "f2_duration",
    """SELECT o_custkey AS id, (floor(o_totalprice / 100000) * 12 + o_orderkey % 12)::INTEGER AS months FROM orders""",
)
def f2(r: Roles) -> DataFrame:
    return r.people.durations.select("id", ft.duration_months(F.col("duration_short")).alias("months"))


@query("f3_explode", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def f3(r: Roles) -> DataFrame:
    return r.table("part").select("p_partkey", F.explode(words()).alias("word"))


@query(
    "f4_explode_outer",
    """SELECT p_partkey, unnest(CASE WHEN p_brand = 'Brand#3' THEN [NULL] ELSE string_split(p_name, ' ') END) AS word FROM part""",
)
def f4(r: Roles) -> DataFrame:
    listed = F.when(F.col("p_brand") != "Brand#3", words())
    return r.table("part").select("p_partkey", F.explode_outer(listed).alias("word"))


def _word_structs() -> F.Column:
    return F.transform(words("text"), lambda w: F.struct(F.lower(w).alias("word"), F.length(w).alias("n")))


@query(
    "f5_field_distinct",
    """SELECT conv_id, turn, len(list_distinct(list_transform(string_split(text, ' '), lambda w: lower(w))))::INTEGER AS n
    FROM conversations""",
)
def f5(r: Roles) -> DataFrame:
    rows = r.table("conversations").withColumn("items", _word_structs())
    return rows.select("conv_id", "turn", F.size(fa.field_distinct(F.col("items"), "word")).alias("n"))


@query(
    "f6_membership",
    """SELECT conv_id, turn, list_contains(string_split(lower(text), ' '), 'the')::INTEGER AS has_the,
    list_contains(string_split(text, ' '), 'est')::INTEGER AS has_est FROM conversations""",
)
def f6(r: Roles) -> DataFrame:
    rows = r.table("conversations").withColumn("items", _word_structs())
    return rows.select(
        "conv_id",
        "turn",
        fa.any_field_equals(F.col("items"), "word", "the").cast("int").alias("has_the"),
        F.array_contains(words("text"), "est").cast("int").alias("has_est"),
    )


@query(
    "f7_percent_text",
    """SELECT o_custkey, 'Urgent: ' || coalesce(round(u * 100.0::DOUBLE / nullif(f, 0), 2)::VARCHAR, '') || ' %, Low: '
    || coalesce(round(l * 100.0::DOUBLE / nullif(f, 0), 2)::VARCHAR, '') || ' %' AS shares FROM (
      SELECT o_custkey, count(*) FILTER (o_orderpriority = '1-URGENT') AS u, count(*) FILTER (o_orderpriority = '5-LOW') AS l,
        count(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1)""",
)
def f7(r: Roles) -> DataFrame:
    parts = {
        "Urgent": F.count_if(F.col("o_orderpriority") == "1-URGENT"),
        "Low": F.count_if(F.col("o_orderpriority") == "5-LOW"),
    }
    total = F.count_if(F.col("o_orderstatus") == "F")
    return r.table("orders").groupBy("o_custkey").agg(ft.percent_text(parts, total).alias("shares"))


def stored_scores() -> F.Column:
    """Event values as serialised scores of one label each."""
    label = F.when(F.col("event_type").isin("view", "click"), "happy1").otherwise("neutral1")
    return F.concat(F.lit("[{score="), F.format_string("%.4f", F.col("value") / 500), F.lit(", label="), label, F.lit("}]"))


@query(
    "f8_stored_score",
    """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN printf('%.4f', value / 500)::FLOAT END AS happy
    FROM events""",
)
def f8(r: Roles) -> DataFrame:
    return r.table("events").select("event_id", ft.stored_score(stored_scores(), "happy1").alias("happy"))


@query(
    "f9_degree_code",
    sql("""SELECT id, CASE degree WHEN 'BSc Economics' THEN 1 WHEN 'Master of Arts' THEN 2 WHEN 'PhD' THEN 3
    WHEN 'Associate degree' THEN 4 ELSE 0 END AS code FROM education"""),
)
def f9(r: Roles) -> DataFrame:
    return r.people.education.select("id", ft.degree_code(ft.degree_level(F.col("degree"))).alias("code"))


@query(
    "f10_spaced_text",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#3' THEN '' ELSE
    array_to_string(list_transform(list_filter(string_split(p_name, ' '), lambda w: w <> 'red'), lambda w: w || ' '), '') END
    AS spaced FROM part""",
)
def f10(r: Roles) -> DataFrame:
    listed = F.when(F.col("p_brand") != "Brand#3", F.transform(words(), lambda w: F.nullif(w, F.lit("red"))))
    return r.table("part").select("p_partkey", ft.spaced_text(listed).alias("spaced"))


@query(
    "f11_template",
    """SELECT p_partkey, 'At ' || p_brand || ', ' || p_name || ' is ' || CASE WHEN p_size = 7 THEN '' ELSE p_type END || '; '
    || p_name || '.' AS sentence FROM part""",
)
def f11(r: Roles) -> DataFrame:
    template = F.lit("At {company name}, {core value} is {kind}; {core value}.")
    kind = F.when(F.col("p_size") != 7, F.col("p_type"))
    filled = ft.fill_template(template, {"company name": F.col("p_brand"), "core value": F.col("p_name"), "kind": kind})
    return r.table("part").select("p_partkey", filled.alias("sentence"))


@query(
    "f12_split_colon",
    """SELECT page_id, split_part(url, ':', 1) AS head, substr(url, strpos(url, ':') + 1) AS tail FROM pages""",
)
def f12(r: Roles) -> DataFrame:
    return r.table("pages").select(
        "page_id", ft.before_colon(F.col("url")).alias("head"), ft.after_colon(F.col("url")).alias("tail")
    )


@query(
    "f13_label",
    """SELECT user_id, CASE WHEN h IS NULL OR n IS NULL THEN NULL WHEN h > n THEN 'happy' ELSE 'neutral' END AS label FROM (
      SELECT user_id, max(value) FILTER (event_type = 'view') AS h, max(value) FILTER (event_type = 'click') AS n
      FROM events GROUP BY 1)""",
)
def f13(r: Roles) -> DataFrame:
    best = r.table("events").groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "view", F.col("value"))).alias("h"),
        F.max(F.when(F.col("event_type") == "click", F.col("value"))).alias("n"),
    )
    return best.select("user_id", ft.dominant_label(F.col("h"), F.col("n")).alias("label"))


@query("f14_join_array", "SELECT doc_id, array_to_string(string_split(text, chr(10)), ', ') AS joined FROM documents")
def f14(r: Roles) -> DataFrame:
    return r.table("documents").select("doc_id", F.array_join(F.split("text", "\n"), ", ").alias("joined"))


@query("f15_cause_values", sql("SELECT id, value, 'volunteering' AS source, detail FROM volunteer_values"))
def f15(r: Roles) -> DataFrame:
    return pf.volunteer_values(r.people.causes)


@query(
    "f16_size",
    """SELECT p_partkey, CASE WHEN p_brand = 'Brand#3' THEN 0 ELSE len(string_split(p_type, 'O')) END::INTEGER AS n FROM part""",
)
def f16(r: Roles) -> DataFrame:
    listed = F.when(F.col("p_brand") != "Brand#3", F.split("p_type", "O"))
    return r.table("part").select("p_partkey", fa.size0(listed).alias("n"))


@query("s2_csv_round_trip", "SELECT CAST(doc_id AS VARCHAR) AS company_name, nullif(text, '') AS scraped_data FROM documents")
def s2(r: Roles) -> DataFrame:
    """All documents through a CSV folder in the shared place."""
    path = f"{shared_folder(r.spark)}/table-{uuid.uuid4().hex}"
    docs = r.table("documents")
    io.append_scraped(docs.select(F.col("doc_id").cast("string").alias("company_name"), F.col("text").alias("scraped_data")), path)
    return io.read_scraped(r.spark, path)


@query("s3_parquet_round_trip", "SELECT doc_id, md5(text) AS digest, lang, source FROM documents")
def s3(r: Roles) -> DataFrame:
    """All documents through a Parquet table with a folder for each language."""
    path = f"{shared_folder(r.spark)}/table-{uuid.uuid4().hex}"
    docs = r.table("documents")
    io.write_table(docs, path, ["lang"])
    return io.read_table(r.spark, path, docs.schema).select("doc_id", F.md5("text").alias("digest"), "lang", "source")


@query(
    "s3_clustered_table",
    """SELECT lang, doc_id, CASE WHEN lang = (SELECT min(lang) FROM documents) THEN upper(source) ELSE source END AS source, n_chars FROM documents
    WHERE n_chars BETWEEN 500 AND 1500""",
)
def s3_clustered(r: Roles) -> DataFrame:
    """Documents in folders by language, in order of their length; one folder is replaced, and a range of lengths read back."""
    path = f"{shared_folder(r.spark)}/table-{uuid.uuid4().hex}"
    docs = r.table("documents").select("doc_id", "lang", "source", "n_chars")
    io.write_table(docs, path, ["lang"], ["n_chars"])
    first = docs.join(docs.agg(F.min("lang").alias("lang")), "lang").withColumn("source", F.upper("source")).select(docs.columns)
    io.write_table(first, path, ["lang"], ["n_chars"], only_partitions=True)
    return io.read_table(r.spark, path, docs.schema).filter("n_chars BETWEEN 500 AND 1500").select("lang", "doc_id", "source", "n_chars")
