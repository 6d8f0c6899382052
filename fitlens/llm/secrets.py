"""Secret scan: patterns propose findings, a random forest on their form and surroundings removes the false ones.

Everything is column work: one regular expression cuts a text into findings and what lies between, so that places, neighbouring
words and features follow from array functions; the forest is Spark's own, grown on a small table of labelled findings.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import query, table
from fitlens.llm.secret_examples import labelled
from fitlens.sources.io import literal_rows

THRESHOLD = 0.5
TREES, DEPTH, SEED = 60, 8, 11

# Forms of findings. An assignment is a telling name, which may be the end of a longer one, a sign and a value; its
# name belongs to the text before. The value of a URL's parameter ends with the parameter.
WHOLE = r"[A-Za-z0-9_.-]*"
NAME = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credentials?)"
SIGN = r"[\"']?[ \t]{0,3}[:=][ \t]{0,3}[\"']?"
PROVIDERS = (
    ("aws", r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])"),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("google", r"AIza[0-9A-Za-z_-]{35}"),
    ("stripe", r"[sr]k_(?:live|test)_[0-9A-Za-z]{16,}"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}"),
    ("private key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?(?:-----END [A-Z ]*PRIVATE KEY-----|\z)"),
)
PARAMETER = rf"(?<=[?&])(?i:{WHOLE}{NAME}=)[^\s\"',;&#]{{6,}}"
ASSIGNED = rf"(?<![A-Za-z0-9_.-])(?i:{WHOLE}{NAME}{SIGN})[^\s\"',;]{{6,}}"
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}"
FINDING = "|".join([*(p for _, p in PROVIDERS), PARAMETER, ASSIGNED, RUN])
PREFIX = rf"^(?i:{WHOLE}{NAME}{SIGN})(?=[^\s\"',;]{{6}})"

# Words that fill names and placeholders, for dictionary coverage.
DICTIONARY = (
    "about above account action admin after again airport all and another any api app are area array article asset attribute author base "
    "because before begin between book box build button call card case change chapter check child class click client close code col color "
    "column comment config content count country create data date day default delete demo detail document domain dummy element email enable "
    "end error event example export false field file first folder font for form from function game general get global group guide has have "
    "head header height help here hidden history home host house icon image img import index info input introduction item job key label "
    "language last left level library light line link list load local log login lorem mail main make map master menu message method model "
    "module month more name new news next node none note null number object off offset old open option order page param parse part pass "
    "password path photo placeholder player point port post price product profile project prompt public query random read real record "
    "request response result right road row sample school script search second secret section select self server service set show site "
    "size small some source start state status string style summary system table tag team temp test text that the their then there this "
    "time title token top total town true type update upload url use user value version video view water weather web week width with word "
    "work world write www year you your"
).split()
SECRET_WORDS = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|credential|auth|bearer|private|login)\W*$"
HARMLESS_WORDS = r"(?i)(sha-?[0-9]*|md5|commit|revision|hash|checksum|digest|integrity|uuid|guid|request|order|isbn|invoice|file|image|id)\W{0,3}$"
TEST_PATH = r"(?i)(test|spec|example|sample|fixture|mock|doc|readme|lock|changelog)"

FEATURES = (
    "size", "runs", "mixed", "pronounced", "digits", "upper", "signs", "distinct", "hexadecimal", "covered", "secret_word", "harmless_word",
    "in_path", "test_path", "provider", "assigned", "calls",
)


def _share(value: Column, pattern: str) -> Column:
    return 1 - F.length(F.regexp_replace(value, pattern, "")) / F.length(value)


def with_features(findings: DataFrame) -> DataFrame:
    """Findings ``(path, before, value, after, kind)`` with the columns ``FEATURES``."""
    value, size = F.col("value"), F.length("value")
    # Classes of characters: a lower, A upper, 0 digit, _ other; v vowel, c consonant.
    signs = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", "_")
    sounds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(value), "[aeiouy]", "V"), "[a-z]", "C"), "[^VC]", "_")
    one_run = lambda x: F.regexp_replace(x, r"(.)\1+", "$1")
    flag = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    return findings.withColumns(
        {
            "size": F.log2(size.cast("double")),
            "runs": F.length(one_run(signs)) / size,
            "mixed": F.size(F.array_distinct(F.split(signs, ""))).cast("double"),
            "pronounced": F.size(F.regexp_extract_all(sounds, F.lit("(CV|VC)"), F.lit(1))) * 2 / size,
            "digits": _share(value, "[0-9]"),
            "upper": _share(value, "[A-Z]"),
            "signs": _share(value, "[^A-Za-z0-9]"),
            "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.least(size, F.lit(40)),
            "hexadecimal": flag(value.rlike("^[0-9a-f-]+$")),
            "covered": _share(F.lower(value), "(" + "|".join(sorted((w for w in DICTIONARY if len(w) > 2), key=len, reverse=True)) + ")"),
            "secret_word": flag(F.col("before").rlike(SECRET_WORDS)),
            "harmless_word": flag(F.col("before").rlike(HARMLESS_WORDS)),
            "in_path": flag(F.col("before").rlike(r"[/\\.@]$") | F.col("after").rlike(r"^([/\\@]|\.[a-z])")),
            "test_path": flag(F.col("path").rlike(TEST_PATH)),
            "provider": flag(~F.col("kind").isin("assigned", "run")),
            "assigned": flag(F.col("kind") == "assigned"),
            "calls": flag(value.rlike(r"[\[\](){}]")),
        }
    )


def kind_of(match: Column) -> Column:
    kind = F.when(match.rlike(PREFIX), "assigned")
    for name, pattern in PROVIDERS:
        kind = kind.when(match.rlike(f"^(?:{pattern})"), name)
    return kind.otherwise("run")


def grow_forest(spark: SparkSession) -> RandomForestClassificationModel:
    """Forest from the labelled findings, a few hundred rows."""
    label, path, before, value, after = zip(*labelled())
    columns = {"label": label, "path": path, "before": before, "value": value, "after": after}
    rows = literal_rows(spark, columns, {"label": pa.float64()} | dict.fromkeys(("path", "before", "value", "after"), pa.string()))
    by_name = F.when(F.col("before").rlike(rf"(?i){NAME}{SIGN}$"), "assigned").otherwise(kind_of(F.col("value")))
    featured = with_features(rows.withColumn("kind", by_name))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(featured).select("label", "features").coalesce(1)
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird").fit(assembled)


def _prefix_sums(lengths: str, block: int = 256) -> tuple[Column, Column]:
    """Sums before each block of an array column, and from them (column ``base``) the sum before each element."""
    add = lambda a, x: a + x
    nth = lambda i: F.floor(i / block).cast("int")
    base = F.transform(
        F.sequence(F.lit(0), nth(F.size(lengths))),
        lambda c: F.aggregate(F.slice(F.col(lengths), F.lit(1), c * block), F.lit(0).cast("long"), add),
    )
    each = F.transform(
        F.col(lengths), lambda _, i: F.aggregate(F.slice(F.col(lengths), nth(i) * block + 1, i % block), F.get(F.col("base"), nth(i)), add)
    )
    return base, each


def find_secrets(
    docs: DataFrame, forest: RandomForestClassificationModel | None = None, key: str = "doc_id", text: str = "text", path: str | None = "source"
) -> DataFrame:
    """``(key, text_hash, start, finish, kind, value, score, secret)``: all findings, with the forest's verdict.

    start and finish (exclusive) count code points of the value from 0; text_hash tells apart different texts under one id.
    Null and empty texts have no findings; repeated rows and null keys are scanned one by one; a null path, or ``path`` None, is
    no evidence. Other columns do not matter. Findings do not overlap.
    """
    forest = forest or grow_forest(docs.sparkSession)
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"), F.coalesce(where, F.lit("")).alias("path"))
    rows = rows.withColumn("matches", F.regexp_extract_all("text", F.lit(FINDING), F.lit(0))).filter(F.size("matches") > 0)
    rows = rows.select("_key", "path", "matches", F.xxhash64("text").alias("text_hash"), F.split("text", FINDING, -1).alias("between"))
    steps = F.zip_with(F.slice("between", F.lit(1), F.size("matches")), "matches", lambda a, m: (F.length(a) + F.length(m)).cast("long"))
    rows = rows.withColumn("steps", steps)
    base, before = _prefix_sums("steps")
    rows = rows.withColumn("base", base).withColumn("sums", before)
    each = F.transform(
        "matches",
        lambda m, i: F.struct(
            m.alias("match"),
            (F.get(F.col("sums"), i) + F.length(F.get(F.col("between"), i))).alias("at"),
            F.right(F.get(F.col("between"), i), F.lit(60)).alias("left"),
            F.left(F.get(F.col("between"), i + 1), F.lit(40)).alias("after"),
        ),
    )
    found = rows.select("_key", "text_hash", "path", F.inline(each))
    found = found.withColumn("kind", kind_of(F.col("match"))).withColumn("name", F.when(F.col("kind") == "assigned", F.regexp_extract("match", PREFIX, 0)).otherwise(""))
    found = found.select(
        "_key", "text_hash", "path", "kind", "after",
        (F.col("at") + F.length("name")).alias("start"),
        F.concat("left", "name").alias("before"),
        F.substr("match", F.length("name") + 1).alias("value"),
    )
    featured = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(with_features(found))
    score = vector_to_array(F.col("probability"))[1]
    scored = forest.transform(featured).withColumn("score", score)
    return scored.select(
        F.col("_key").alias(key),
        "text_hash",
        F.col("start").cast("long").alias("start"),
        (F.col("start") + F.length("value")).cast("long").alias("finish"),
        "kind",
        "value",
        "score",
        (F.col("score") >= THRESHOLD).alias("secret"),
    )


def redact(docs: DataFrame, mark: str = "[SECRET]", key: str = "doc_id", text: str = "text", path: str | None = "source", chars: str | None = "n_chars") -> DataFrame:
    """The documents with their own columns, every secret in the text replaced by ``mark``, and the column ``chars`` counted anew
    where a text changed."""
    secrets = find_secrets(docs, key=key, text=text, path=path).filter("secret")
    spans = secrets.groupBy(F.col(key).alias("id"), F.col("text_hash").alias("hash")).agg(
        F.array_sort(F.collect_set(F.struct(F.col("start").cast("int").alias("start"), F.col("finish").cast("int").alias("finish")))).alias("spans")
    )
    # The documents' own columns are one struct, so that none of them can clash with the others.
    whole = docs.select(F.struct("*").alias("row"), F.col(key).alias("own_id"), F.col(text).alias("body"))
    joined = whole.join(spans, F.col("own_id").eqNullSafe(F.col("id")) & (F.xxhash64("body") == F.col("hash")), "left")
    upto = lambda i: F.get(F.col("spans"), i - 1)["finish"]
    kept = F.concat(
        F.transform(
            "spans",
            lambda s, i: F.concat(
                F.substring(F.col("body"), F.when(i == 0, 1).otherwise(upto(i) + 1), s["start"] - F.when(i == 0, 0).otherwise(upto(i))),
                F.lit(mark),
            ),
        ),
        F.array(F.substr(F.col("body"), F.element_at("spans", -1)["finish"] + 1)),
    )
    changed = F.col("spans").isNotNull()
    out = joined.select("row", "spans", F.when(changed, F.array_join(kept, "")).otherwise(F.col("body")).alias("new"))

    def column(name: str) -> Column:
        own = F.col("row").getField(name)
        if name == text:
            return F.col("new").alias(name)
        if name == chars:
            return F.when(changed, F.char_length("new").cast(docs.schema[name].dataType)).otherwise(own).alias(name)
        return own.alias(name)

    return out.select(*map(column, docs.columns))


@query("op1_secret_forest")
def op1_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All findings in the documents with the forest's verdict; the value as a digest."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.withColumn("value", F.sha2("value", 256)).withColumnRenamed("value", "value_sha256")
