"""The given tables in the roles of profiles, companies and their texts.

Each role exists twice: as a DataFrame, and as a common table expression for the SQL oracles.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fitlens.plans import profiles as pf
from fitlens.session import stored
from fitlens.sources.io import dealt, lexicon_df, read_table, spread

UNIVERSITIES = ["furniture", "machinery"]

# Words of part names in the role of a lexicon, in order of precedence.
LEXICON = {
    "Community": ["hot", "widget"],
    "Contribution": ["cold", "gear", "hot"],
    "Excellence": ["red"],
    "Autonomy": ["blue", "plate"],
    "Learning": ["small"],
    "Meaningful work": ["large", "bolt"],
    "Creativity": ["new", "ring"],
    "Altruism": ["old", "rod"],
    "Environment": ["gizmo"],
    "Equity": ["anvil"],
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query on ``Roles`` and the SQL that must give the same rows."""

    def register(fn: Callable[[Roles], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Roles(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# Schemas of the given tables by path, so that a table is inferred once per process.
SCHEMAS: dict[str, StructType] = {}


class Roles:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.is_staged = False

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in SCHEMAS:
            SCHEMAS[path] = read_table(self.spark, path).schema
        return read_table(self.spark, path, SCHEMAS[path])

    def texts(self, name: str, key: str) -> DataFrame:
        """A table with heavy rows, dealt over all cores if it is one small file."""
        return spread(self.table(name), key)

    def staged(self) -> Roles:
        """The same roles with the bridge and the engineered profiles as stored tables.

        For dataflows that read them in several branches. Staged roles stay as they are.
        """
        if self.is_staged:
            return self
        out = Roles(self.spark, self.sf_dir)
        out.is_staged = True
        out.bridge = stored(self.bridge)
        out.engineered = stored(self.engineered)
        return out

    @cached_property
    def people(self) -> pf.People:
        nation = self.table("nation").select(F.col("n_nationkey"), "n_name")
        customer = self.table("customer")
        people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("id"),
            F.concat(F.lit("N"), (F.col("c_custkey") % 40).cast("string")).alias("name"),
            F.col("c_mktsegment").alias("educations_details"),
            F.col("n_name").alias("current_company"),
        )
        orders = self.table("orders")
        priority = F.substring("o_orderpriority", 1, 1)
        education = orders.select(
            F.col("o_custkey").alias("id"),
            F.when(priority == "1", "BSc Economics")
            .when(priority == "2", "Master of Arts")
            .when(priority == "3", "PhD")
            .when(priority == "4", "Diploma")
            .otherwise("Associate degree")
            .alias("degree"),
        )
        durations = orders.select(
            F.col("o_custkey").alias("id"),
            F.concat(
                F.floor(F.col("o_totalprice") / 100000).cast("string"),
                F.lit(" years "),
                (F.col("o_orderkey") % 12).cast("string"),
                F.lit(" months"),
            ).alias("duration_short"),
        )
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey")
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        employers = (
            orders.select("o_orderkey", "o_custkey")
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("o_custkey").alias("id"), F.col("n_name").alias("company_name"))
        )
        kind = F.col("event_type")
        causes = (
            self.table("events")
            .filter("value > 150")
            .select(
                F.col("user_id").alias("id"),
                F.when(kind == "signup", "Education")
                .when(kind == "click", "Environment")
                .when(kind == "view", "Arts and Culture")
                .when(kind == "purchase", "Social Services")
                .otherwise("Chess")
                .alias("cause"),
            )
            .join(customer.select(F.col("c_custkey").alias("id")), "id", "left_semi")
        )
        return pf.People(people, education, durations, employers, causes)

    @cached_property
    def companies(self) -> DataFrame:
        region = self.table("region")
        kind = (
            F.when(F.col("r_name") == "AFRICA", "Nonprofit").when(F.col("r_name") == "AMERICA", "Self-Employed").otherwise("Public")
        )
        return (
            self.table("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("name"), kind.alias("organization_type"))
        )

    @cached_property
    def company_texts(self) -> DataFrame:
        """A row for each text of a company: every part is the slogan, the about text or a scraped text of one."""
        nation = self.table("nation")
        part = self.texts("part", "p_partkey").select("p_partkey", "p_name")
        place = F.floor(F.col("p_partkey") / 25) % 3
        texts = part.join(nation, F.col("p_partkey") % 25 == F.col("n_nationkey"))
        return texts.select(
            F.col("n_name").alias("company_name"),
            F.when(place == 0, F.col("p_name")).alias("slogan"),
            F.when(place == 1, F.col("p_name")).alias("about"),
            F.when(place == 2, F.col("p_name")).alias("scraped_data"),
        )

    @cached_property
    def lexicon(self) -> DataFrame:
        return lexicon_df(self.spark, LEXICON)

    @cached_property
    def bridge(self) -> DataFrame:
        return pf.employment(self.people)

    @cached_property
    def pairs(self) -> DataFrame:
        """The bridge of staged roles, dealt by person, for matches that each pair brings several of."""
        return dealt(self.bridge, "id")

    @cached_property
    def engineered(self) -> DataFrame:
        return pf.engineer(self.people, UNIVERSITIES)

    @cached_property
    def org_types(self) -> DataFrame:
        return pf.org_types_per_profile(self.bridge, self.companies)

    @cached_property
    def profile_words(self) -> DataFrame:
        """Keywords of a profile: words of the part its number falls on."""
        part = self.table("part")
        parts = part.agg(F.count("*")).scalar()
        return (
            self.table("customer")
            .select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % parts).alias("p_partkey"))
            .join(part.select("p_partkey", "p_name"), "p_partkey")
            .select("id", F.col("p_name").alias("text"))
        )


CTES = {
    "people": """people AS (
  SELECT c_custkey AS id, concat('N', c_custkey % 40) AS name, c_mktsegment AS educations_details, n_name AS current_company
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "education": """education AS (
  SELECT o_custkey AS id, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'BSc Economics' WHEN '2' THEN 'Master of Arts'
    WHEN '3' THEN 'PhD' WHEN '4' THEN 'Diploma' ELSE 'Associate degree' END AS degree
  FROM orders)""",
    "levels": """levels AS (
  SELECT DISTINCT id, CASE degree WHEN 'BSc Economics' THEN 'Bachelor' WHEN 'Master of Arts' THEN 'Master'
    WHEN 'PhD' THEN 'Doctorate' ELSE 'Associate' END AS degree
  FROM education WHERE degree <> 'Diploma')""",
    "tenure": """tenure AS (
  SELECT o_custkey AS id, round(avg(floor(o_totalprice / 100000) * 12 + o_orderkey % 12), 1) AS months
  FROM orders GROUP BY 1)""",
    "causes": """causes AS (
  SELECT user_id AS id, CASE event_type WHEN 'signup' THEN 'Education' WHEN 'click' THEN 'Environment'
    WHEN 'view' THEN 'Arts and Culture' WHEN 'purchase' THEN 'Social Services' ELSE 'Chess' END AS cause
  FROM events WHERE value > 150 AND user_id IN (SELECT c_custkey FROM customer))""",
    "past": """past AS (
  SELECT o_custkey AS id, n_name AS company_name
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)""",
    "bridge": """bridge AS (
  SELECT current_company AS company_name, id FROM people UNION SELECT company_name, id FROM past)""",
    "companies": """companies AS (
  SELECT n_name AS name, CASE r_name WHEN 'AFRICA' THEN 'Nonprofit' WHEN 'AMERICA' THEN 'Self-Employed' ELSE 'Public' END
    AS organization_type FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "eligible": """eligible AS (
  SELECT company_name FROM bridge JOIN companies ON company_name = name GROUP BY 1 HAVING count(*) >= 20)""",
    "org_types": """org_types AS (
  SELECT id, company_name, organization_type FROM bridge JOIN companies ON company_name = name)""",
    "engineered": """engineered AS (
  SELECT p.id, p.name, p.educations_details, p.current_company,
    CASE WHEN p.educations_details IN ('FURNITURE', 'MACHINERY') THEN 1 ELSE 0 END AS top_university,
    CASE WHEN p.id IN (SELECT id FROM causes) THEN 1 ELSE 0 END AS volunteering,
    months AS average_months_of_experience,
    CASE WHEN EXISTS (SELECT 1 FROM levels l WHERE l.id = p.id AND l.degree = 'Associate') THEN 1 ELSE 0 END AS has_associate,
    CASE WHEN EXISTS (SELECT 1 FROM levels l WHERE l.id = p.id AND l.degree = 'Bachelor') THEN 1 ELSE 0 END AS has_bachelor,
    CASE WHEN EXISTS (SELECT 1 FROM levels l WHERE l.id = p.id AND l.degree = 'Doctorate') THEN 1 ELSE 0 END AS has_doctorate,
    CASE WHEN EXISTS (SELECT 1 FROM levels l WHERE l.id = p.id AND l.degree = 'Master') THEN 1 ELSE 0 END AS has_master
  FROM people p LEFT JOIN tenure USING (id))""",
    "population": """population AS (
  SELECT b.company_name, e.id, volunteering, top_university, average_months_of_experience, degree,
    CASE WHEN degree = 'Doctorate' THEN 1 ELSE 0 END AS doctorate, CASE WHEN degree = 'Master' THEN 1 ELSE 0 END AS master
  FROM (SELECT id, min(company_name) AS company_name FROM bridge JOIN eligible USING (company_name) GROUP BY id) b JOIN engineered e ON b.id = e.id
  LEFT JOIN (SELECT id, min(degree) AS degree FROM levels GROUP BY id) d ON d.id = e.id)""",
    "erfcc": """flags AS (
  SELECT company_name, feature, flag FROM (
    SELECT company_name, 'volunteering' AS feature, volunteering AS flag FROM population
    UNION ALL SELECT company_name, 'top_university', top_university FROM population
    UNION ALL SELECT company_name, 'doctorate', doctorate FROM population
    UNION ALL SELECT company_name, 'master', master FROM population)),
one AS (SELECT company_name, feature, sum(flag)::BIGINT AS x1, count(*) AS n1 FROM flags GROUP BY 1, 2),
everyone AS (SELECT feature, sum(flag)::BIGINT AS x2, count(*) AS n2 FROM flags GROUP BY 1),
rates AS (SELECT *, (x1 + x2)::DOUBLE / (n1 + n2) AS rate FROM one JOIN everyone USING (feature)),
zs AS (
  SELECT *, CASE WHEN rate > 0 AND rate < 1 THEN
    (x1::DOUBLE / n1 - x2::DOUBLE / n2) / sqrt(rate * (1 - rate) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)) END AS z FROM rates),
ztests AS (
  SELECT company_name, feature, x1, n1, x2, n2, z, sign(z)::INTEGER AS direction, exp(log_p) AS p_value, log_p FROM (
    SELECT *, ln(2) - z * z / 2 - ln(2 * pi()) / 2 + ln(h / 3 * list_sum(list_transform(range(0, 4001),
      lambda i: (CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(-abs(z) * i * h - i * h * i * h / 2)))) AS log_p
    FROM (SELECT *, 40 / (1 + abs(z)) / 4000 AS h FROM zs)))""",
    "welch": """m1 AS (
  SELECT company_name, count(average_months_of_experience) AS n1, avg(average_months_of_experience) AS mean1,
    var_samp(average_months_of_experience) AS var1 FROM population GROUP BY 1),
m2 AS (
  SELECT count(average_months_of_experience) AS n2, avg(average_months_of_experience) AS mean2,
    var_samp(average_months_of_experience) AS var2 FROM population),
welch AS (
  SELECT *, (mean1 - mean2) / sqrt(var1 / n1 + var2 / n2) AS t,
    pow(var1 / n1 + var2 / n2, 2) / (pow(var1 / n1, 2) / (n1 - 1) + pow(var2 / n2, 2) / (n2 - 1)) AS df
  FROM m1, m2 WHERE n1 > 0),
simpson AS (
  SELECT company_name, sum(abs(t) / 3000 *
    CASE WHEN i = 0 OR i = 1000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(lgamma((df + 1) / 2) - lgamma(df / 2) - (df + 1) / 2 * ln(1 + pow(abs(t) * i / 1000, 2) / df)) / sqrt(df * pi())) AS half
  FROM welch, range(1001) r(i) GROUP BY 1),
ttests AS (SELECT w.*, 1 - 2 * half AS p_value, ln(1 - 2 * half) AS log_p FROM welch w JOIN simpson USING (company_name))""",
    "tests": """tests AS (
  SELECT company_name, feature, p_value, log_p, direction FROM ztests
  UNION ALL SELECT company_name, 'average_tenure', p_value, log_p, sign(t)::INTEGER FROM ttests)""",
    "lexicon": "lexicon(priority, value, word) AS (VALUES "
    + ", ".join(f"({i}, '{v}', '{w}')" for i, (v, ws) in enumerate(LEXICON.items(), 1) for w in ws)
    + ")",
    "first_values": """first_values AS (SELECT word, arg_min(value, priority) AS value FROM lexicon GROUP BY word)""",
    "company_values": """texts AS (
  SELECT n_name AS company_name, CASE WHEN p_partkey // 25 % 3 = 0 THEN 'slogan' END AS source, p_name
  FROM part JOIN nation ON p_partkey % 25 = n_nationkey),
company_words AS (SELECT company_name, source, unnest(string_split(p_name, ' ')) AS word FROM texts),
company_values AS (SELECT DISTINCT company_name, value, source FROM company_words JOIN first_values USING (word))""",
    "feature_values": """worked AS (
  SELECT id, max(organization_type = 'Nonprofit') AS nonprofit, max(organization_type = 'Self-Employed') AS self_employed
  FROM org_types GROUP BY id),
feature_values AS (
  SELECT id, 'top_university' AS feature, unnest(['Excellence', 'Learning']) AS value FROM engineered WHERE top_university = 1
  UNION ALL SELECT id, 'degrees', unnest(['Excellence', 'Autonomy', 'Learning']) FROM engineered WHERE has_doctorate = 1
  UNION ALL SELECT id, 'organization_types', unnest(['Contribution', 'Meaningful work', 'Community']) FROM worked WHERE nonprofit
  UNION ALL SELECT id, 'organization_types', unnest(['Accountability', 'Autonomy']) FROM worked
    WHERE self_employed AND NOT nonprofit)""",
    "volunteer_values": """volunteer_values AS (
  SELECT DISTINCT id, unnest(['Community', 'Contribution', 'Meaningful work']) AS value, NULL::VARCHAR AS detail FROM causes
  UNION ALL SELECT DISTINCT id, CASE cause WHEN 'Education' THEN 'Altruism' WHEN 'Environment' THEN 'Environment'
    WHEN 'Arts and Culture' THEN 'Creativity' ELSE 'Equity' END, cause FROM causes WHERE cause <> 'Chess')""",
    "profile_values": """profile_values AS (
  SELECT DISTINCT id, value, NULL::VARCHAR AS source FROM feature_values WHERE feature <> 'top_university'
  UNION ALL SELECT id, value, CASE WHEN bool_or(src = 't') THEN 'top_university' ELSE 'volunteering' END FROM (
    SELECT id, value, 'v' AS src FROM volunteer_values
    UNION ALL SELECT id, value, 't' FROM feature_values WHERE feature = 'top_university') GROUP BY 1, 2)""",
    "ranked": """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY company_name ORDER BY log_p, feature) AS rank FROM tests WHERE p_value < 0.5)""",
    "value_matches": """value_candidates AS (
  SELECT b.id, b.company_name, p.value, p.source AS profile_source, c.source AS company_source,
    (p.source IS NOT NULL)::INTEGER + (c.source IS NOT NULL)::INTEGER AS known
  FROM bridge b JOIN profile_values p ON b.id = p.id JOIN company_values c ON b.company_name = c.company_name AND p.value = c.value),
value_matches AS (
  SELECT id, company_name, value, profile_source, company_source, known FROM value_candidates
  QUALIFY row_number() OVER (PARTITION BY id, company_name, value
    ORDER BY known DESC, company_source IS NULL, profile_source IS NOT NULL) = 1)""",
    "pattern_matches": """traits AS (
  SELECT id, 'master' AS feature, NULL::VARCHAR AS detail FROM engineered WHERE has_master = 1
  UNION ALL SELECT id, 'doctorate', NULL FROM engineered WHERE has_doctorate = 1
  UNION ALL SELECT id, 'volunteering', NULL FROM engineered WHERE volunteering = 1
  UNION ALL SELECT id, 'top_university', educations_details FROM engineered WHERE top_university = 1),
pattern_candidates AS (
  SELECT b.id, b.company_name, t.feature, t.detail, r.p_value, bool_or(t.feature = 'doctorate') OVER (PARTITION BY b.id, b.company_name) AS doctor
  FROM bridge b JOIN traits t ON b.id = t.id JOIN ranked r ON r.company_name = b.company_name AND r.feature = t.feature),
pattern_matches AS (SELECT * FROM pattern_candidates WHERE NOT (feature = 'master' AND doctor))""",
}


def sql(body: str, extra: str = "") -> str:
    """SQL with the common table expressions it names, directly or through others, put in front.

    ``extra`` holds further expressions of one query, which come after the shared ones.
    """
    wanted, text = set(), f"{extra}\n{body}"
    while True:
        new = {name for name in CTES if name not in wanted and re.search(rf"\b{ALIASES.get(name, name)}\b", text)}
        if not new:
            break
        wanted |= new
        text = "\n".join(CTES[name] for name in new)
    parts = [CTES[name] for name in CTES if name in wanted] + ([extra] if extra else [])
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# Names by which a query asks for the expressions that bear another key.
ALIASES = {
    "erfcc": "ztests", "welch": "(?:ttests|welch)", "value_matches": "value_matches", "pattern_matches": "pattern_matches",
}
