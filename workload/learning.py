"""Queries for sampling, encoding and feature importance."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.operators import encoding as en
from fitlens.operators import forest as fr
from fitlens.operators import groups as g
from fitlens.operators.sampling import negatives
from fitlens.plans.training import training_rows
from workload.product import population
from workload.roles import Roles, query, sql

SEED = 5

NEGATIVES = f"""drawn AS (
  SELECT company_name, id FROM (
    SELECT g.company_name, c.id, n, row_number() OVER (PARTITION BY g.company_name
      ORDER BY (place - ('0x' || substr(md5('{SEED}|' || g.company_name), 1, 15))::BIGINT % total + total) % total) AS rn
    FROM (SELECT company_name, count(*) AS n FROM population GROUP BY 1) g,
      (SELECT id, row_number() OVER (ORDER BY md5('{SEED}|' || id), id) - 1 AS place, count(*) OVER () AS total
       FROM (SELECT DISTINCT id FROM population)) c
    WHERE NOT EXISTS (SELECT 1 FROM population p WHERE p.company_name = g.company_name AND p.id = c.id))
  WHERE rn <= n)"""

TRAIN = f"""{NEGATIVES},
org_texts AS (SELECT id, string_agg(organization_type || ' ', '' ORDER BY organization_type) AS organization_types
  FROM org_types GROUP BY 1),
train AS (
  SELECT l.company_name, l.id, l.label, p.top_university, p.volunteering,
    coalesce(p.average_months_of_experience, -1) AS average_months_of_experience,
    CASE p.degree WHEN 'Bachelor' THEN 1 WHEN 'Master' THEN 2 WHEN 'Doctorate' THEN 3 WHEN 'Associate' THEN 4 ELSE 0 END
      AS degree_feature,
    coalesce(o.organization_types, '') AS organization_types
  FROM (SELECT company_name, id, 1 AS label FROM population UNION ALL SELECT company_name, id, 0 FROM drawn) l
  JOIN population p ON p.id = l.id LEFT JOIN org_texts o ON o.id = l.id)"""


@query("m1_negatives", sql("SELECT company_name, id FROM drawn", NEGATIVES))
def m1(r: Roles) -> DataFrame:
    return negatives(population(r), "company_name", "id", SEED)


@query(
    "m1_negatives_all_employers",
    sql("SELECT company_name, id FROM drawn", NEGATIVES.replace("population", "bridge")),
)
def m1_all(r: Roles) -> DataFrame:
    return negatives(r.bridge, "company_name", "id", SEED)


def train(r: Roles) -> DataFrame:
    r = r.staged()
    return training_rows(population(r), r.org_types, SEED)


@query(
    "m2_training_rows",
    sql(
        """SELECT company_name, id, label, top_university, volunteering, average_months_of_experience, degree_feature,
        organization_types FROM train""",
        TRAIN,
    ),
)
def m2(r: Roles) -> DataFrame:
    return train(r).drop("degree", "organization_types_feature")


@query(
    "m3_string_index",
    """SELECT p_partkey, p_name, place::DOUBLE AS name_index FROM part JOIN (
      SELECT p_name, row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS place FROM part GROUP BY 1) USING (p_name)""",
)
def m3(r: Roles) -> DataFrame:
    return en.string_index(r.table("part").select("p_partkey", "p_name"), "p_name", "name_index")


@query(
    "m4_assemble",
    sql(
        """SELECT company_name, id, label, top_university::DOUBLE AS f0, volunteering::DOUBLE AS f1,
        average_months_of_experience AS f2, degree_feature::DOUBLE AS f3, place::DOUBLE AS f4 FROM train JOIN (
        SELECT organization_types, row_number() OVER (ORDER BY count(*) DESC, organization_types) - 1 AS place FROM train GROUP BY 1)
        USING (organization_types)""",
        TRAIN,
    ),
)
def m4(r: Roles) -> DataFrame:
    listed = en.assemble(train(r)).withColumn("v", vector_to_array("features"))
    return listed.select("company_name", "id", "label", *[F.col("v")[i].alias(f"f{i}") for i in range(5)])


def forest_sql(rows: str, features: int, depth: int = fr.MAX_DEPTH, trees: int = fr.FOREST_TREES, seed: int = SEED) -> str:
    """SQL for ``found(k, f, importance)``: forests over ``rows(k, id, y, f0, f1, ...)``, level by level with the same draws."""
    steps = " + ".join(f"(d >= {s})::INT" for s in fr.poisson_steps())
    factors = ", ".join(f"({t}, {a}::BIGINT, {b}::BIGINT)" for t, (a, b) in enumerate(fr.tree_factors(trees, seed)))
    values = " UNION ALL ".join(f"SELECT k, id, y, {i} AS f, f{i}::DOUBLE AS x FROM {rows}" for i in range(features))
    out = f"""long AS ({values}),
    places AS (SELECT k, f, x, CASE WHEN count(*) OVER g <= {fr.MAX_BINS} THEN row_number() OVER w
      ELSE (sum(n) OVER w - n) * {fr.MAX_BINS} // sum(n) OVER g END AS place
      FROM (SELECT k, f, x, count(*) AS n FROM long GROUP BY ALL) WINDOW g AS (PARTITION BY k, f), w AS (PARTITION BY k, f ORDER BY x)),
    bins AS (SELECT k, f, x, dense_rank() OVER (PARTITION BY k, f ORDER BY place) - 1 AS bin FROM places),
    binned AS (SELECT l.k, id, y, list(bin ORDER BY l.f) AS b FROM long l JOIN bins v ON v.k = l.k AND v.f = l.f AND v.x = l.x GROUP BY ALL),
    level0 AS (SELECT k, y, b, t AS code, {steps} AS w FROM (SELECT k, y, b, t, (('0x' || substr(md5('{seed}|' || id), 1, 15))::BIGINT % {fr.FIELD} * m + c) % {fr.FIELD} AS d
      FROM binned, (VALUES {factors}) factors(t, m, c)) WHERE w > 0),"""
    for level in range(depth):
        masks = [sum(1 << f for f in some) for some in fr.tried_features(features, trees, level, seed)]
        out += f"""
    hist{level} AS (SELECT k, code, f, bin, sum(w) AS n, sum(w * y) AS pos
      FROM (SELECT k, code, w, y, unnest(b) AS bin, generate_subscripts(b, 1) - 1 AS f FROM level{level}) WHERE ({masks}[code + 1] >> f) & 1 = 1 GROUP BY ALL),
    runs{level} AS (SELECT k, code, f, bin, sum(n) OVER w AS nl, sum(pos) OVER w AS pl, sum(n) OVER g AS n, sum(pos) OVER g AS pos FROM hist{level}
      WINDOW g AS (PARTITION BY k, code, f), w AS (PARTITION BY k, code, f ORDER BY bin)),
    gain{level} AS (SELECT k, code, f, bin, n, round(2 * (pos::DOUBLE / n) * (1 - pos::DOUBLE / n) - (nl * (2 * (pl::DOUBLE / nl) * (1 - pl::DOUBLE / nl))
      + (n - nl) * (2 * ((pos - pl)::DOUBLE / (n - nl)) * (1 - (pos - pl)::DOUBLE / (n - nl)))) / n, {fr.DIGITS}) AS gain FROM runs{level} WHERE nl < n),
    split{level} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, code ORDER BY gain DESC, f, bin) AS r FROM gain{level} WHERE gain > 1e-12) WHERE r = 1),
    level{level + 1} AS (SELECT l.k, y, b, code * 2 + (b[f + 1] > bin)::INT AS code, w FROM level{level} l JOIN split{level} s USING (k, code)),"""
    union = " UNION ALL ".join(f"SELECT k, code >> {level} AS tree, f, gain * n AS gain FROM split{level}" for level in range(depth))
    return out + f"""
    shares AS (SELECT k, tree, f, sum(gain) / sum(sum(gain)) OVER (PARTITION BY k, tree) AS share FROM ({union}) GROUP BY 1, 2, 3),
    parts AS (SELECT k, f, sum(share) / sum(sum(share)) OVER (PARTITION BY k) AS importance FROM shares GROUP BY 1, 2),
    found AS (SELECT k, f, coalesce(importance, 0) AS importance FROM (SELECT k, f FROM (SELECT DISTINCT k FROM {rows}), range({features}) r(f)) LEFT JOIN parts USING (k, f))"""


@query("m5_forest")
def m5(r: Roles) -> DataFrame:
    return fr.rf_importance(documents(r), DOC_FEATURES, "quality", seed=SEED)


@query(
    "m6_forest_by_company",
    sql(
        f"""SELECT k AS company_name, string_agg(feature, ',' ORDER BY round(importance, 9) DESC, feature) AS features_importance
        FROM found JOIN (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(en.FEATURES))}) names(f, feature) USING (f) GROUP BY 1""",
        TRAIN
        + """, coded AS (SELECT company_name AS k, id, label AS y, top_university AS f0, volunteering AS f1, average_months_of_experience AS f2,
        degree_feature AS f3, place AS f4 FROM train JOIN (SELECT organization_types, row_number() OVER (ORDER BY count(*) DESC, organization_types) - 1
          AS place FROM train GROUP BY 1) USING (organization_types)),
        """
        + forest_sql("coded", len(en.FEATURES)),
    ),
)
def m6(r: Roles) -> DataFrame:
    ranked = fr.rf_importance_by_group(train(r), "company_name", en.FEATURES, "label", seed=SEED, id_col="id")
    return fr.ranked_feature_names(ranked, "company_name").withColumn("features_importance", F.array_join("features_importance", ","))


DOC_FEATURES = ["n_chars", "n_words", "toxic", "lang_code"]


def documents(r: Roles) -> DataFrame:
    docs = r.table("documents").select(
        "doc_id", "source", "n_chars", F.size(F.split("text", " ")).alias("n_words"), F.ascii("lang").alias("lang_code")
    )
    return docs.join(r.table("labels"), "doc_id")


DOCS_SQL = """docs AS (SELECT source AS k, doc_id AS id, quality AS y, n_chars AS f0, len(string_split(text, ' ')) AS f1, toxic AS f2, ascii(lang) AS f3
      FROM documents JOIN labels USING (doc_id))"""


@query(
    "t7_rank_importances",
    f"""WITH {DOCS_SQL}, {forest_sql("docs", len(DOC_FEATURES))}
    SELECT k AS source, feature, round(importance, 6) AS importance, row_number() OVER (PARTITION BY k ORDER BY round(importance, 9) DESC, feature)::INT AS rank
    FROM found JOIN (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(DOC_FEATURES))}) names(f, feature) USING (f)""",
)
def t7(r: Roles) -> DataFrame:
    out = fr.rf_importance_by_group(documents(r), "source", DOC_FEATURES, "quality", seed=SEED, id_col="doc_id")
    return out.withColumn("importance", F.round("importance", 6))


@query(
    "a9_packed_rows",
    """SELECT source, 0::BIGINT AS part, count(*)::INT AS n_rows, string_agg(doc_id || ':' || quality, ',' ORDER BY doc_id) AS listed
    FROM documents JOIN labels USING (doc_id) GROUP BY 1""",
)
def a9(r: Roles) -> DataFrame:
    packed = g.pack_rows(documents(r), "source", "rows")
    listed = F.transform("rows", lambda x: F.concat_ws(":", x["doc_id"].cast("string"), x["quality"].cast("string")))
    return packed.select("source", "part", F.size("rows").alias("n_rows"), F.array_join(listed, ",").alias("listed"))


GAIN = """
    runs AS (SELECT *, sum(n) OVER w AS nl, sum(p) OVER w AS pl, sum(n) OVER g AS na, sum(p) OVER g AS pa FROM (
      SELECT k, feature, x, count(*) AS n, sum(y) AS p FROM long GROUP BY 1, 2, 3)
      WINDOW w AS (PARTITION BY k, feature ORDER BY x), g AS (PARTITION BY k, feature)),
    gains AS (SELECT k, feature, 2 * pa / na * (1 - pa / na) - (nl * 2 * (pl / nl) * (1 - pl / nl)
      + CASE WHEN na = nl THEN 0 ELSE (na - nl) * 2 * ((pa - pl) / (na - nl)) * (1 - (pa - pl) / (na - nl)) END) / na AS gain FROM (
      SELECT k, feature, nl::DOUBLE AS nl, pl::DOUBLE AS pl, na::DOUBLE AS na, pa::DOUBLE AS pa FROM runs))"""


@query(
    "m7_stump_gain",
    """WITH docs AS (SELECT source AS k, quality AS y, n_chars, len(string_split(text, ' ')) AS n_words, toxic, ascii(lang) AS lang_code
      FROM documents JOIN labels USING (doc_id)),
    long AS (SELECT k, y, 'n_chars' AS feature, n_chars::DOUBLE AS x FROM docs UNION ALL SELECT k, y, 'n_words', n_words FROM docs
      UNION ALL SELECT k, y, 'toxic', toxic FROM docs UNION ALL SELECT k, y, 'lang_code', lang_code FROM docs),"""
    + GAIN
    + "SELECT k AS source, feature, round(max(gain), 6) AS gain FROM gains GROUP BY 1, 2",
)
def m7(r: Roles) -> DataFrame:
    gains = fr.stump_gain(documents(r), "source", DOC_FEATURES, "quality")
    return gains.withColumn("gain", F.round(F.col("gain") + 0.0, 6))


@query(
    "m7_stump_gain_by_company",
    sql(
        "SELECT k AS company_name, feature, round(max(gain), 6) AS gain FROM gains GROUP BY 1, 2",
        TRAIN
        + """,
    long AS (SELECT company_name AS k, label AS y, 'average_months_of_experience' AS feature, average_months_of_experience AS x FROM train
      UNION ALL SELECT company_name, label, 'degree_feature', degree_feature FROM train
      UNION ALL SELECT company_name, label, 'top_university', top_university FROM train),"""
        + GAIN,
    ),
)
def m7_by_company(r: Roles) -> DataFrame:
    features = ["average_months_of_experience", "degree_feature", "top_university"]
    return fr.stump_gain(train(r), "company_name", features, "label").withColumn("gain", F.round("gain", 6))


STUMP_FEATURES = ["toxic", "lang_code", "length_class"]


@query(
    "m6_stump_forest",
    """WITH docs AS (SELECT source AS k, quality AS y, toxic, ascii(lang) AS lang_code, n_chars % 16 AS length_class
      FROM documents JOIN labels USING (doc_id)),
    long AS (SELECT k, y, 'toxic' AS feature, toxic::DOUBLE AS x FROM docs UNION ALL SELECT k, y, 'lang_code', lang_code FROM docs
      UNION ALL SELECT k, y, 'length_class', length_class FROM docs),"""
    + GAIN
    + """, best AS (SELECT k, feature, max(gain) AS gain FROM gains GROUP BY 1, 2),
    scored AS (SELECT k, feature, CASE WHEN gain > 1e-12 AND row_number() OVER (PARTITION BY k ORDER BY round(gain, 12) DESC,
      list_position(['toxic', 'lang_code', 'length_class'], feature)) = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM best)
    SELECT k AS source, feature, importance, row_number() OVER (PARTITION BY k ORDER BY importance DESC, feature)::INT AS rank FROM scored""",
)
def m6_stump(r: Roles) -> DataFrame:
    """A forest of one stump on all rows, whose importances follow from the gains."""
    rows = documents(r).withColumn("length_class", F.col("n_chars") % 16)
    return fr.rf_importance_by_group(rows, "source", STUMP_FEATURES, "quality", trees=1, seed=SEED, depth=1, bagging=False)


@query(
    "m5_stump",
    """WITH docs AS (SELECT 1 AS k, (n_chars % 16 + 2 * toxic >= 8)::INT AS y, toxic, ascii(lang) AS lang_code, n_chars % 16 AS length_class
      FROM documents JOIN labels USING (doc_id)),
    long AS (SELECT k, y, 'toxic' AS feature, toxic::DOUBLE AS x FROM docs UNION ALL SELECT k, y, 'lang_code', lang_code FROM docs
      UNION ALL SELECT k, y, 'length_class', length_class FROM docs),"""
    + GAIN
    + """, best AS (SELECT feature, (row_number() OVER (ORDER BY round(max(gain), 12) DESC, list_position(['toxic', 'lang_code', 'length_class'], feature)) = 1)::INT::DOUBLE
      AS importance FROM gains GROUP BY 1)
    SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature)::INT AS rank FROM best""",
)
def m5_stump(r: Roles) -> DataFrame:
    """Spark's own forest, as one tree of one split on all rows and features. The label is one that a split tells apart: Spark takes
    back splits whose sides have the same majority."""
    rows = documents(r).withColumn("length_class", F.col("n_chars") % 16)
    rows = rows.withColumn("long_class", (F.col("length_class") + 2 * F.col("toxic") >= 8).cast("int"))
    return fr.rf_importance(rows, STUMP_FEATURES, "long_class", trees=1, seed=SEED, depth=1, bagging=False)
