"""Keywords of texts and the core values they stand for.

Tables are long: one row per text and word. The words of one text come from its own row
without a shuffle, and a word is looked up in a table with one row per word.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fitlens.constants import STOPWORDS
from fitlens.functions.arrays import merged, or_empty
from fitlens.functions.text import before_colon
from fitlens.session import stored

# A token, and the tokens that may be keywords (letters and hyphens only).
TOKEN = r"[\p{L}\p{N}_'’-]+"
WORD = r"^-*\p{L}[\p{L}-]*$"
# Words of a lexicon entry at most.
LONGEST = 8


def keyword_array(text: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Distinct lower-case keywords of a text, in order of appearance; NULL text has none."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    # Stop words and repeats go before the test of each word: it is the dearer one.
    listed = F.split(F.lit(" ".join(stopwords)), " ") if stopwords else F.array().cast("array<string>")
    return or_empty(F.filter(F.array_except(tokens, listed), lambda w: w.rlike(WORD)))


def keywords(
    df: DataFrame, id_col: str, text: str, stopwords: Sequence[str] = STOPWORDS, pos_lexicon: DataFrame | None = None
) -> DataFrame:
    """``(id, word)`` for the keywords of each text.

    ``pos_lexicon(word, tag)`` keeps nouns (NN…) and adjectives (JJ…) only.
    """
    words = df.select(id_col, F.explode(keyword_array(F.col(text), stopwords)).alias("word"))
    return words if pos_lexicon is None else nouns_and_adjectives(words, pos_lexicon)


def nouns_and_adjectives(words: DataFrame, pos_lexicon: DataFrame) -> DataFrame:
    """Words that ``pos_lexicon(word, tag)`` knows as nouns or adjectives."""
    wanted = pos_lexicon.filter(F.col("tag").rlike("^(NN|JJ)")).select(F.lower("word").alias("word")).distinct()
    return words.join(wanted, "word", "left_semi").select(*words.columns)


def keywords_many(
    df: DataFrame,
    id_col: str,
    text: str,
    stopwords: Sequence[str] = STOPWORDS,
    pos_lexicon: DataFrame | None = None,
    forms: DataFrame | None = None,
) -> DataFrame:
    """Distinct ``(id, word)`` over all texts of an id; blank texts add nothing.

    ``pos_lexicon`` filters as in ``keywords``; ``forms(token, form)`` then puts words in their base form.
    """
    words = keywords(df.filter(F.trim(text) != ""), id_col, text, stopwords, pos_lexicon)
    return (words if forms is None else lemmatise(words, forms)).distinct()


def merge_keywords(columns: Sequence[str]) -> Column:
    """Keyword lists of several columns as one list; repeats stay."""
    return merged([F.col(c) for c in columns])


def expand_lexicon(lexicon: DataFrame, forms: DataFrame) -> DataFrame:
    """Lexicon with the stems and lemmas of each token of each word added.

    ``forms(token, form)`` holds the stems and lemmas.
    """
    tokens = lexicon.select("priority", "value", F.explode(F.split(F.lower("word"), r"\s+")).alias("token"))
    known = forms.select(F.lower("token").alias("token"), "form").dropna()
    added = tokens.join(known, "token").select("priority", "value", F.col("form").alias("word"))
    return lexicon.select("priority", "value", "word").union(added).distinct()


def first_values(lexicon: DataFrame) -> DataFrame:
    """``(word, value)`` with the value of the first lexicon entry that lists the word, in lower case as keywords are."""
    return lexicon.groupBy(F.lower("word").alias("word")).agg(F.min_by("value", "priority").alias("value"))


def match_values(words: DataFrame, id_col: str, lexicon: DataFrame, distinct: bool) -> DataFrame:
    """``(id, value)`` of each keyword in the lexicon; once per keyword, or once per value."""
    out = words.join(first_values(lexicon), "word").select(id_col, "value")
    return out.distinct() if distinct else out


def phrase_words(text: Column) -> Column:
    """Lower-case tokens of a text, in order, repeats and stop words included."""
    return or_empty(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)))


def match_phrases(df: DataFrame, id_col: str, text: str, lexicon: DataFrame, longest: int = LONGEST) -> DataFrame:
    """``(id, phrase, value, place, words)``: every place where a text says an entry of the lexicon word by word.

    Entries have one word or several, at most ``longest``, parted like texts: ``self driven`` is found in ``Self driven!``. A token
    meets the entries that begin with it together with the tokens behind it, so work grows with the tokens and not with the
    lengths of entries. An occurrence inside a longer one does not count; others may overlap. The value is that of the first
    lexicon entry with these words. place counts tokens from 0; of several texts of one id each has its own.
    """
    entries = lexicon.select("priority", "value", phrase_words(F.col("word")).alias("entry")).filter(F.size("entry").between(1, longest))
    entries = entries.groupBy("entry").agg(F.min_by("value", "priority").alias("value")).withColumn("_first", F.get("entry", 0))
    rows = df.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_text"), phrase_words(F.col(text)).alias("_words"))
    # The words are the one element of an array, so that they are cut out once and not for each token.
    ahead = F.transform(F.array("_words"), lambda words: F.transform(words, lambda _, i: F.slice(words, i + 1, F.lit(longest))))[0]
    tokens = rows.select("_id", "_text", F.posexplode(ahead).alias("place", "_ahead"))
    tokens = tokens.withColumn("_first", F.get("_ahead", 0))
    said = tokens.join(entries, "_first").filter(F.slice("_ahead", F.lit(1), F.size("entry")) == F.col("entry"))
    # Stored, so that texts are cut into tokens once: occurrences are read twice and few.
    said = stored(said.select("_id", "_text", "place", F.size("entry").alias("words"), F.array_join("entry", " ").alias("phrase"), "value"))
    # The stretches inside each longer occurrence: few, as an entry has few words.
    start = F.explode(F.sequence(F.col("place"), F.col("place") + F.col("words") - 1)).alias("place")
    inside = said.filter("words > 1").select("_id", "_text", start, (F.col("place") + F.col("words")).alias("_end"), F.col("words").alias("_whole"))
    inside = inside.select("_id", "_text", "place", "_whole", F.explode(F.sequence(F.lit(1), F.col("_end") - F.col("place"))).alias("words"))
    inside = inside.filter("words < _whole").select("_id", "_text", "place", "words").distinct()
    same = [said[c].eqNullSafe(inside[c]) for c in ("_id", "_text", "place", "words")]
    kept = said.join(inside, same[0] & same[1] & same[2] & same[3], "left_anti")
    return kept.select(F.col("_id").alias(id_col), "phrase", "value", "place", "words")


def lemmatise(words: DataFrame, forms: DataFrame) -> DataFrame:
    """Words in their base form where ``forms(token, form)`` knows one."""
    base = forms.groupBy(F.col("token").alias("word")).agg(F.min("form").alias("form"))
    out = words.join(base, "word", "left").withColumn("word", F.coalesce("form", "word"))
    return out.select(*words.columns)


def invert_lexicon(lexicon: DataFrame) -> DataFrame:
    """``(word, value)``: every value a lower-case word stands for."""
    return lexicon.select(F.lower("word").alias("word"), "value").distinct()


def labels_above(scores: DataFrame, threshold: float) -> DataFrame:
    """Labels with a score of at least ``threshold``, cut at the first colon."""
    return scores.filter(F.col("score") >= threshold).withColumn("label", before_colon(F.col("label")))
