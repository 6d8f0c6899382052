"""Queries for keywords, lexicons, vectors and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitlens.constants import COMPANY_LABEL_THRESHOLD, CORE_VALUES, PROFILE_LABEL_THRESHOLD, STOPWORDS
from fitlens.operators import groups as g
from fitlens.operators import keywords as kw
from fitlens.operators import pages as pg
from fitlens.operators import vectors as vc
from fitlens.plans import companies as co
from fitlens.sources.io import clean_scraped, lexicon_df
from workload.roles import Roles, query, sql

STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOPWORDS) + "]"


def kept(text: str) -> str:
    """DuckDB list of the distinct keywords of a text."""
    tokens = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_''’-]+')"
    return (
        rf"list_filter(list_distinct({tokens}), lambda w: regexp_matches(w, '^-*\p{{L}}[\p{{L}}-]*$') "
        rf"AND NOT list_contains({STOP_SQL}, w))"
    )


@query("k1_keywords", f"SELECT doc_id, unnest({kept('text')}) AS word FROM documents")
def k1(r: Roles) -> DataFrame:
    return kw.keywords(r.texts("documents", "doc_id"), "doc_id", "text")


@query(
    "k1_nouns_and_adjectives",
    f"""SELECT doc_id, word FROM (SELECT doc_id, unnest({kept('text')}) AS word FROM documents)
    WHERE word IN (SELECT unnest({kept('text')}) FROM benchmark) AND length(word) % 3 < 2""",
)
def k1_tagged(r: Roles) -> DataFrame:
    return kw.keywords(r.texts("documents", "doc_id"), "doc_id", "text", pos_lexicon=tags(r))


def tags(r: Roles) -> DataFrame:
    """Words of the benchmark with a part of speech by their length: a third are verbs."""
    words = kw.keywords(r.table("benchmark"), "item_id", "text").select("word").distinct()
    place = F.length("word") % 3
    return words.withColumn("tag", F.when(place == 0, "NNS").when(place == 1, "JJ").otherwise("VB"))


@query(
    "k2_tagged",
    f"""SELECT DISTINCT conv_id, CASE WHEN word LIKE 't%' THEN substr(word, 1, 3) ELSE word END AS word
    FROM (SELECT conv_id, unnest({kept('text')}) AS word FROM conversations)
    WHERE word IN (SELECT unnest({kept('text')}) FROM benchmark) AND length(word) % 3 < 2""",
)
def k2_tagged(r: Roles) -> DataFrame:
    """Nouns and adjectives in a base form: of words with a t the first three letters."""
    forms = tags(r).filter("word LIKE 't%'").select(F.col("word").alias("token"), F.substring("word", 1, 3).alias("form"))
    return kw.keywords_many(r.texts("conversations", "text"), "conv_id", "text", pos_lexicon=tags(r), forms=forms)


@query(
    "k6_lemmatised",
    sql("""SELECT DISTINCT company_name, value, source FROM (
      SELECT company_name, source, CASE WHEN word LIKE 'g%' THEN 'gear' ELSE word END AS word FROM company_words
      WHERE word NOT LIKE 'b%') JOIN first_values USING (word)""".replace("first_values", "first_values /* company_values */")),
)
def k6_lemmatised(r: Roles) -> DataFrame:
    """Company values from nouns only (words with a b are verbs) in base forms (words with a g are gears)."""
    words = r.table("part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    pos = words.withColumn("tag", F.when(F.col("word").startswith("b"), "VB").otherwise("NN"))
    forms = words.filter(F.col("word").startswith("g")).select(F.col("word").alias("token"), F.lit("gear").alias("form"))
    return co.company_values(r.company_texts, r.lexicon, pos, forms)


@query("k2_keywords_many", f"SELECT DISTINCT conv_id, unnest({kept('text')}) AS word FROM conversations")
def k2(r: Roles) -> DataFrame:
    return kw.keywords_many(r.texts("conversations", "text"), "conv_id", "text")


@query(
    "k3_merge_keywords",
    """SELECT p_partkey, array_to_string(list_concat(string_split(p_name, ' '),
    CASE WHEN p_brand = 'Brand#3' THEN [] ELSE string_split(lower(p_type), 'o') END), ',') AS merged FROM part""",
)
def k3(r: Roles) -> DataFrame:
    rows = r.table("part").select(
        "p_partkey",
        F.split("p_name", " ").alias("a"),
        F.when(F.col("p_brand") != "Brand#3", F.split(F.lower("p_type"), "o")).alias("b"),
    )
    return rows.select("p_partkey", F.array_join(kw.merge_keywords(["a", "b"]), ",").alias("merged"))


def typed_lexicon(r: Roles) -> DataFrame:
    """Part names as entries of the type's word list, types in order of their first letter."""
    part = r.table("part")
    return part.select(F.ascii("p_type").alias("priority"), F.col("p_type").alias("value"), F.col("p_name").alias("word")).distinct()


@query(
    "k5_expand_lexicon",
    """WITH lex AS (SELECT DISTINCT ascii(p_type) AS priority, p_type AS value, p_name AS word FROM part),
    forms AS (SELECT DISTINCT token, substr(token, 1, 3) AS form FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part))
    SELECT priority, value, word FROM lex
    UNION SELECT priority, value, form FROM (SELECT priority, value, unnest(string_split(word, ' ')) AS token FROM lex) JOIN forms USING (token)""",
)
def k5(r: Roles) -> DataFrame:
    token = F.explode(F.split("p_name", " ")).alias("token")
    forms = r.table("part").select(token).distinct().withColumn("form", F.substring("token", 1, 3))
    return kw.expand_lexicon(typed_lexicon(r), forms)


BENCH_LEXICON = f"""blex AS (
  SELECT item_id AS priority, 'V' || item_id AS value, unnest({kept('text')}) AS word FROM benchmark),
bfirst AS (SELECT word, arg_min(value, priority) AS value FROM blex GROUP BY word)"""


def benchmark_lexicon(r: Roles) -> DataFrame:
    """Benchmark items as values, their keywords as the words that show them."""
    words = kw.keywords(r.table("benchmark"), "item_id", "text")
    return words.select(
        F.col("item_id").alias("priority"), F.concat(F.lit("V"), F.col("item_id").cast("string")).alias("value"), "word"
    )


@query(
    "k6_match_values",
    f"""WITH {BENCH_LEXICON}
    SELECT doc_id, value, count(*) AS n FROM (SELECT doc_id, unnest({kept('text')}) AS word FROM documents)
    JOIN bfirst USING (word) GROUP BY 1, 2""",
)
def k6(r: Roles) -> DataFrame:
    words = kw.keywords(r.texts("documents", "doc_id"), "doc_id", "text")
    found = kw.match_values(words, "doc_id", benchmark_lexicon(r), distinct=False)
    return found.groupBy("doc_id", "value").agg(F.count("*").alias("n"))


@query(
    "k6_match_values_distinct",
    sql("""SELECT DISTINCT company_name, value FROM company_words JOIN first_values USING (word) WHERE source IS NULL""".replace(
        "company_words JOIN first_values USING (word)", "company_values"
    )),
)
def k6_distinct(r: Roles) -> DataFrame:
    texts = r.company_texts
    words = kw.keywords(texts, "company_name", "scraped_data").union(kw.keywords(texts, "company_name", "about"))
    return kw.match_values(words, "company_name", r.lexicon, distinct=True)


ENTRIES = [word for words in CORE_VALUES.values() for word in words]
ENTRIES_SQL = "[" + ", ".join(f"'{w}'" for w in ENTRIES) + "]"
PHRASES = rf"""WITH entries(priority, value, word) AS (VALUES {", ".join(f"({i}, '{v}', '{w}')" for i, (v, ws) in enumerate(CORE_VALUES.items(), 1) for w in ws)}),
    phrases AS (SELECT regexp_extract_all(lower(word), '[\p{{L}}\p{{N}}_''’-]+') AS ph, arg_min(value, priority) AS value FROM entries GROUP BY 1),
    said AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '') || ' ' || {ENTRIES_SQL}[doc_id % {len(ENTRIES)} + 1] || '. '
      || {ENTRIES_SQL}[doc_id * 7 % {len(ENTRIES)} + 1]), '[\p{{L}}\p{{N}}_''’-]+') AS t FROM documents),
    found AS (SELECT doc_id, i, len(ph) AS n, ph, value FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM said)
      JOIN phrases ON t[i] = ph[1] AND t[i:i + len(ph) - 1] = ph)"""


def said(r: Roles) -> DataFrame:
    """Documents that say two entries of the lexicon at their end, by their id."""
    entry = lambda i: F.get(F.array(*map(F.lit, ENTRIES)), (i % len(ENTRIES)).cast("int"))
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), entry(F.col("doc_id")), F.lit(". "), entry(F.col("doc_id") * 7))
    return r.texts("documents", "doc_id").select("doc_id", text.alias("text"))


@query(
    "k4_core_values",
    f"""{PHRASES} SELECT DISTINCT doc_id, value FROM found f WHERE NOT EXISTS (SELECT 1 FROM found g
      WHERE g.doc_id = f.doc_id AND g.n > f.n AND g.i <= f.i AND g.i + g.n >= f.i + f.n)""",
)
def k4(r: Roles) -> DataFrame:
    """Core values that the documents name, by words and phrases of the whole lexicon."""
    return kw.match_phrases(said(r), "doc_id", "text", lexicon_df(r.spark, CORE_VALUES)).select("doc_id", "value").distinct()


@query(
    "k6_phrases",
    f"""{PHRASES} SELECT doc_id, array_to_string(ph, ' ') AS phrase, value, count(*) AS n FROM found f WHERE NOT EXISTS (SELECT 1 FROM found g
      WHERE g.doc_id = f.doc_id AND g.n > f.n AND g.i <= f.i AND g.i + g.n >= f.i + f.n) GROUP BY ALL""",
)
def k6_phrases(r: Roles) -> DataFrame:
    found = kw.match_phrases(said(r), "doc_id", "text", lexicon_df(r.spark, CORE_VALUES))
    return found.groupBy("doc_id", "phrase", "value").agg(F.count("*").alias("n"))


@query(
    "k7_invert_lexicon",
    "SELECT DISTINCT lower(p_name) AS word, p_type AS value FROM part",
)
def k7(r: Roles) -> DataFrame:
    return kw.invert_lexicon(typed_lexicon(r))


@query(
    "k8_labels_above",
    """SELECT user_id AS id, event_type AS label, round(value / 50, 6) AS score FROM events WHERE value / 50 >= 0.6""",
)
def k8(r: Roles) -> DataFrame:
    scores = r.table("events").select(
        F.col("user_id").alias("id"),
        F.concat("event_type", F.lit(": detail")).alias("label"),
        (F.col("value") / 50).alias("score"),
    )
    return kw.labels_above(scores, PROFILE_LABEL_THRESHOLD).withColumn("score", F.round("score", 6))


@query(
    "k8_labels_listed",
    """SELECT user_id AS id, 0::BIGINT AS part, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS labels FROM events
    WHERE value / 50 >= 0.3 GROUP BY 1""",
)
def k8_listed(r: Roles) -> DataFrame:
    scores = r.table("events").select(
        F.col("user_id").alias("id"), F.concat("event_type", F.lit(":x")).alias("label"), (F.col("value") / 50).alias("score")
    )
    lists = g.ids_by(kw.labels_above(scores, COMPANY_LABEL_THRESHOLD), "id", "label", "labels")
    return lists.select("id", "part", F.array_join("labels", ",").alias("labels"))


# --- vectors -------------------------------------------------------------------------------

VECTORS = "vecs AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
MEANS = f"""{VECTORS},
dims AS (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS pos FROM vecs)
  GROUP BY 1, 2),
means AS (SELECT label, list(m ORDER BY pos) AS v FROM dims GROUP BY 1)"""


@query("k9_mean_vector", f"WITH {MEANS} SELECT label, (pos - 1)::INTEGER AS pos, round(m, 6) AS x FROM dims")
def k9(r: Roles) -> DataFrame:
    means = vc.mean_vector(r.table("embeddings"), "label", "embedding")
    return means.select("label", F.posexplode("mean").alias("pos", "x")).withColumn("x", F.round("x", 6))


def hits(r: Roles, threshold: float) -> DataFrame:
    vecs = r.table("embeddings")
    anchors = vc.mean_vector(vecs, "label", "embedding").withColumnRenamed("label", "anchor")
    return vc.cosine_join(vecs, anchors, "vec_id", "embedding", "anchor", "mean", threshold)


J11_SQL = f"""WITH {MEANS}
    SELECT vec_id, m.label AS anchor, round(list_cosine_similarity(a.v, m.v), 6) AS cosine FROM vecs a, means m
    WHERE list_cosine_similarity(a.v, m.v) > 0.3"""


@query("j11_cosine_join", J11_SQL)
def j11(r: Roles) -> DataFrame:
    return hits(r, 0.3).withColumn("cosine", F.round("cosine", 6))


@query(
    "j11_cosine_join_large_anchors",
    f"""WITH {VECTORS}
    SELECT a.vec_id, b.vec_id AS anchor, round(list_cosine_similarity(a.v, b.v), 6) AS cosine FROM vecs a, vecs b
    WHERE list_cosine_similarity(a.v, b.v) > 0.5""",
)
def j11_large(r: Roles) -> DataFrame:
    """All vectors with all vectors."""
    vecs = r.table("embeddings")
    anchors = vecs.select(F.col("vec_id").alias("anchor"), F.col("embedding").alias("w"))
    return vc.cosine_join(vecs, anchors, "vec_id", "embedding", "anchor", "w", 0.5).withColumn("cosine", F.round("cosine", 6))


@query(
    "k10_semantic_values",
    f"""WITH {MEANS}
    SELECT DISTINCT vec_id, 'L' || (m.label % 3) AS value FROM vecs a, means m WHERE list_cosine_similarity(a.v, m.v) > 0.3""",
)
def k10(r: Roles) -> DataFrame:
    labels = r.table("embeddings").select(F.col("label").alias("anchor")).distinct()
    meanings = labels.withColumn("value", F.concat(F.lit("L"), (F.col("anchor") % 3).cast("string")))
    return vc.semantic_values(hits(r, 0.3), meanings, "vec_id", "anchor")


@query("m8_dominant_vectors")
def m8(r: Roles) -> DataFrame:
    centres = vc.dominant_vectors(r.table("embeddings"), "label", "embedding")
    return centres.select("label", "cluster", F.posexplode("centre").alias("pos", "x")).withColumn("x", F.round("x", 4))


def three_rounds(vectors: str) -> str:
    """SQL for three steps of k-means, written out: ``c3(label, c, pos, centre)`` from the expression ``vectors(label, vec_id, v)``."""
    step = """d{i} AS (
      SELECT long.label, vec_id, c, sum((x - centre) * (x - centre)) AS gap FROM long JOIN c{j} ON long.label = c{j}.label AND long.pos = c{j}.pos
      GROUP BY ALL),
    a{i} AS (SELECT label, vec_id, arg_min(c, gap + c * 1e-300) AS c FROM d{i} GROUP BY ALL),
    n{i} AS (SELECT a{i}.label, c, pos, avg(x) AS centre FROM a{i} JOIN long USING (label, vec_id) GROUP BY ALL),
    c{i} AS (
      SELECT c{j}.label, c{j}.c, c{j}.pos, coalesce(n{i}.centre, c{j}.centre) AS centre
      FROM c{j} LEFT JOIN n{i} ON n{i}.label = c{j}.label AND n{i}.c = c{j}.c AND n{i}.pos = c{j}.pos)"""
    steps = ",\n".join(step.format(i=i, j=i - 1) for i in (1, 2, 3))
    return f"""long AS (SELECT label, vec_id, unnest(v)::DOUBLE AS x, generate_subscripts(v, 1) - 1 AS pos FROM {vectors}),
    stats AS (SELECT label, pos, avg(x) AS m, var_samp(x) AS v FROM long GROUP BY ALL),
    wide AS (SELECT label, arg_min(pos, -v) AS wide, max(v) AS most FROM stats GROUP BY ALL),
    c0 AS (
      SELECT label, c, pos, CASE WHEN pos = wide THEN m + (2 * c - 1) * sqrt(most) ELSE m END AS centre
      FROM stats JOIN wide USING (label), (SELECT unnest([0, 1]) AS c)),
    {steps}"""


@query(
    "m8_three_rounds",
    f"""WITH {three_rounds("(SELECT label, vec_id, embedding AS v FROM embeddings)")}
    SELECT label, c::INT AS cluster, pos::INT AS pos, round(centre, 4) AS x FROM c3""",
)
def m8_three(r: Roles) -> DataFrame:
    """The first three rounds of k-means, which SQL can follow."""
    centres = vc.dominant_vectors(r.table("embeddings"), "label", "embedding", rounds=3)
    return centres.select("label", "cluster", F.posexplode("centre").alias("pos", "x")).withColumn("x", F.round("x", 4))


# --- pages ---------------------------------------------------------------------------------

ABOUT = ["the", "and", "est|une"]

LINKS = r"""bodies AS (
  SELECT page_id, url AS base, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'),
    '(?is)<script(?:\s[^>]*)?>.*?</script\s*>', ' ', 'g'), '(?is)<style(?:\s[^>]*)?>.*?</style\s*>', ' ', 'g') AS body FROM pages),
pieces AS (SELECT page_id, base, unnest(string_split_regex(body, '(?i)<a[\s]')[2:]) AS piece FROM bodies),
hrefs AS (
  SELECT page_id, base, regexp_extract(split_part(piece, '>', 1), '(?i)^\s*(?:.*\s)?href="([^"]*)"', 1) AS href FROM pieces
  WHERE regexp_matches(split_part(piece, '>', 1), '(?i)^\s*(?:.*\s)?href="')),
bare AS (
  SELECT page_id, unnest(regexp_extract_all(replace(replace(replace(replace(replace(replace(regexp_replace(body, '<[^>]*>', ' ', 'g'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
    '(https?://[^\s\\>"'')]+)', 1)) AS url FROM bodies),
links AS (
  SELECT page_id, regexp_extract(trim(CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
      WHEN href LIKE '//%' THEN regexp_extract(base, '^https?:') || href
      WHEN href LIKE '/%' THEN regexp_extract(base, '^(https?://[^/?#]+)', 1) || href
      WHEN href LIKE '#%' THEN regexp_extract(base, '^[^#]*') || href
      WHEN href LIKE '?%' THEN regexp_extract(base, '^[^?#]*') || href
      ELSE regexp_extract(regexp_extract(base, '^[^?#]*'), '^.*/') || href END), '^[^\s>]*') AS url,
    CASE WHEN regexp_matches(href, '^https?://[^\s\\>"'')]+') THEN 'absolute'
      WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'other' ELSE 'relative' END AS kind FROM hrefs
  UNION ALL SELECT page_id, regexp_extract(trim(url), '^[^\s>]*'), 'text' FROM bare)"""


@query("h1_links", f"WITH {LINKS} SELECT page_id, url, kind FROM links WHERE url <> ''")
def h1(r: Roles) -> DataFrame:
    return pg.links(r.texts("pages", "page_id")).select("page_id", "url", "kind")


@query(
    "h2_about_links",
    f"""WITH {LINKS} SELECT page_id, url, CASE WHEN regexp_matches(url, '(?i)the') THEN 1
    WHEN regexp_matches(url, '(?i)and') THEN 2 ELSE 3 END AS pattern FROM links
    WHERE url <> '' AND regexp_matches(url, '(?i)the|and|est|une')""",
)
def h2(r: Roles) -> DataFrame:
    return pg.about_links(pg.links(r.texts("pages", "page_id")), ABOUT).select("page_id", "url", "pattern")


def _strip(column: str) -> str:
    out = f"regexp_replace({column}, '(?s)<!--.*?-->', ' ', 'g')"
    for tag in ("script", "style", "nav", "footer", "header", "aside"):
        out = rf"regexp_replace({out}, '(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>', ' ', 'g')"
    return out


PAGE_TEXT = rf"""paragraphs AS (
  SELECT page_id, unnest(string_split_regex({_strip('html')}, '(?i)<p(?:\s[^>]*)?>')[2:]) AS part,
    generate_subscripts(string_split_regex({_strip('html')}, '(?i)<p(?:\s[^>]*)?>')[2:], 1) AS i FROM pages),
cut AS (
  SELECT page_id, i, regexp_replace(replace(replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(part, '(?is)</p\s*>.*$', ''), '\s*<[^>]*>\s*', '', 'g'),
    '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS t
  FROM paragraphs),
page_texts AS (
  SELECT page_id, coalesce(string_agg(t, chr(10) || chr(10) ORDER BY i) FILTER (t <> '' AND len(string_split_regex(t, '\s+')) > 5), '')
    AS text FROM cut GROUP BY 1)"""


@query(
    "h3_page_text",
    f"WITH {PAGE_TEXT} SELECT p.page_id, coalesce(t.text, '') AS text FROM pages p LEFT JOIN page_texts t USING (page_id)",
)
def h3(r: Roles) -> DataFrame:
    return pg.page_text(r.texts("pages", "page_id"))


@query(
    "h4_site_text",
    rf"""WITH {PAGE_TEXT},
    about AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS site, url, max(coalesce(t.text, '')) AS text
      FROM pages LEFT JOIN page_texts t USING (page_id) WHERE regexp_matches(url, '(?i)the|and|est|une') GROUP BY 1, 2),
    dealt AS (SELECT *, ('0x' || substr(md5(url), 1, 15))::BIGINT
      % greatest(ceil(sum(length(text)) OVER (PARTITION BY site) / 20000), 1)::BIGINT AS part FROM about)
    SELECT site, part, nullif(coalesce(string_agg(text, chr(10) ORDER BY url) FILTER (text <> ''), ''), '') AS text
    FROM dealt GROUP BY 1, 2""",
)
def h4(r: Roles) -> DataFrame:
    pages = r.texts("pages", "page_id").select("url", "html", F.lit("").alias("label"))
    about = pg.about_links(pages, ABOUT).select(
        F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("site"),
        "url",
        F.array_join(pg.readable_paragraphs(F.col("html")), "\n\n").alias("text"),
    )
    return pg.site_text(about, "site", "url", "text", chars=20_000)


SITES = f"""{PAGE_TEXT},
    sites AS (SELECT 'S' || page_id % 40 AS name, regexp_replace(url, '^(https?://[^/?#]*)', '\\1/p' || page_id) AS website, page_id FROM pages),
    said AS (SELECT name, website, nullif(coalesce(t.text, ''), '') AS text FROM sites s LEFT JOIN pages p ON p.page_id = s.page_id + 1 AND s.page_id % 3 <> 0
      LEFT JOIN page_texts t ON t.page_id = p.page_id)"""


def linked_sites(r: Roles) -> tuple[DataFrame, DataFrame]:
    """Each page as the home of a site, its number in its URL; two in three have a link, spelled in another way, to the page with
    the next number."""
    own = F.regexp_replace("url", "^(https?://[^/?#]*)", F.concat(F.lit("$1/p"), F.col("page_id").cast("string")))
    pages = r.table("pages").select("page_id", own.alias("url"), "html")
    after = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next"))
    rest = F.regexp_replace(F.regexp_replace("next", "^https?://[^/?#]*", ""), "#.*$", "")
    host = F.upper(F.regexp_extract("next", "^https?://([^/?#]*)", 1))
    port = F.when(F.col("next").startswith("https"), ":443").otherwise(":80")
    href = F.concat(F.upper(F.regexp_extract("next", "^https?", 0)), F.lit("://"), host, port, F.lit("/x/.."), rest, F.lit("#team"))
    link = F.concat(F.lit('<a href="'), href, F.lit('"><span>Who we are</span></a>'))
    linked = pages.join(after, "page_id", "left")
    html = F.when((F.col("page_id") % 3 != 0) & F.col("next").isNotNull(), F.concat(link, "html")).otherwise(F.col("html"))
    sites = pages.select(F.concat(F.lit("S"), (F.col("page_id") % 40).cast("string")).alias("name"), F.col("url").alias("website"))
    return sites, linked.select("url", html.alias("html"))


@query("h4_about_texts", f"WITH {SITES} SELECT name, website, 0::BIGINT AS part, text FROM said")
def h4_about(r: Roles) -> DataFrame:
    """Text of the pages that the links of each home page lead to, for sites without any as well."""
    return pg.about_texts(*linked_sites(r))


@query(
    "h_site_values",
    f"""WITH {SITES}, {BENCH_LEXICON}
    SELECT DISTINCT name, value FROM (SELECT name, unnest({kept('text')}) AS word FROM said WHERE text IS NOT NULL) JOIN bfirst USING (word)""",
)
def h_site_values(r: Roles) -> DataFrame:
    """From stored pages to values: links, about pages, text per site, rows with a text, keywords, values."""
    texts = clean_scraped(pg.about_texts(*linked_sites(r)), ["name", "text"])
    return kw.match_values(kw.keywords(texts, "name", "text"), "name", benchmark_lexicon(r), distinct=True)


BOX = "'<nav>x</nav><div class=\"scrollTarget divider\"><div><p class=\"big section-text\">' || p_name || '</p></div><p>no</p></div>'"
CARD = (
    "'<a href=\"/m\">m</a><div class=\"results\"><a href=\"https://h/' || p_partkey || '\"><div class=\"card-title\"> ' || p_name "
    "|| '</div></a><a href=\"https://h/0\"><div class=\"card-title\">second</div></a></div>'"
)


@query("h5_container_text", "SELECT p_partkey, p_name AS text FROM part")
def h5(r: Roles) -> DataFrame:
    """Every part name in a built page, and out of it again."""
    pages = r.table("part").select("p_partkey", F.expr(BOX).alias("html"))
    return pg.container_text(pages, "p_partkey", "html", "scrollTarget divider", "section-text")


@query("h6_first_result", "SELECT p_partkey, 'https://h/' || p_partkey AS url, p_name AS title FROM part WHERE p_name <> 'hot rod'")
def h6(r: Roles) -> DataFrame:
    pages = r.table("part").select("p_partkey", F.expr(CARD).alias("html"))
    return pg.first_result(pages, "p_partkey", "html", "results", "card-title", skip=["hot rod"])
