"""Reading and writing tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fitlens.operators.positions import global_positions

SCRAPED = "company_name string, scraped_data string"
SCRAPE_OUT = "name string, website string, scraped_text string"
# Narrow rows that a task takes where each of them grows by joins.
TASK_ROWS = 100_000


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet table; with a known schema no footer is read up front."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (), only_partitions: bool = False) -> None:
    """Overwrite a Parquet table, with a folder for each value of ``partition_by``.

    With ``cluster_by`` rows are dealt to tasks by ranges of the partition and cluster columns and sorted within files, so the files
    of a folder hold ranges of their own, a large folder has several of them, and a reader's filter on a cluster column skips
    files and row groups by their statistics. With ``only_partitions`` the folders that ``df`` has rows for are replaced, the
    others stay.
    """
    keys = [*partition_by, *cluster_by]
    if cluster_by:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if only_partitions else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_scraped(spark: SparkSession, path: str, schema: str | StructType = SCRAPED) -> DataFrame:
    """CSV with a header whose quoted texts may span lines. The schema is given, not inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def append_scraped(df: DataFrame, path: str) -> None:
    """Append rows to a CSV folder that ``read_scraped`` reads back as they were."""
    df.write.mode("append").option("header", True).option("escape", '"').option("quoteAll", True).option(
        "nullValue", ""
    ).option("emptyValue", "").csv(path)


def clean_scraped(df: DataFrame, columns: Sequence[str] = ("name", "website", "scraped_text")) -> DataFrame:
    """Rows without any NULL, cut to the given columns."""
    return df.dropna().select(*columns)


def literal_rows(spark: SparkSession, columns: Mapping[str, Sequence], kinds: Mapping[str, pa.DataType]) -> DataFrame:
    """Table from Python lists. It goes through Arrow into a local relation, whose size the planner knows."""
    return spark.createDataFrame(pa.table({name: pa.array(list(values), kinds[name]) for name, values in columns.items()}))


def lexicon_df(spark: SparkSession, lexicon: Mapping[str, Iterable[str]]) -> DataFrame:
    """``(priority, value, word)`` rows; priority is the place of the value in the mapping."""
    rows = [(i, value, word) for i, (value, words) in enumerate(lexicon.items(), 1) for word in words]
    priority, value, word = zip(*rows)
    return literal_rows(
        spark,
        {"priority": priority, "value": value, "word": word},
        {"priority": pa.int32(), "value": pa.string(), "word": pa.string()},
    )


def rules_df(spark: SparkSession, rules: Mapping[str, str], key: str, value: str) -> DataFrame:
    return literal_rows(spark, {key: rules.keys(), value: rules.values()}, {key: pa.string(), value: pa.string()})


def books_df(spark: SparkSession, books: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(book, template_id, template)`` rows."""
    rows = [(book, i, text) for book, texts in books.items() for i, text in enumerate(texts)]
    book, place, text = zip(*rows)
    return literal_rows(
        spark,
        {"book": book, "template_id": place, "template": text},
        {"book": pa.string(), "template_id": pa.int64(), "template": pa.string()},
    )


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows over all cores by a unique key if the input has fewer splits than cores.

    For heavy work on the rows of one small file. An input with a split per core stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, key: str, rows: int = TASK_ROWS) -> DataFrame:
    """Rows dealt by a key to a task for each ``rows`` of them, at least one for each core.

    For narrow rows that grow by joins: the size of what is shuffled does not tell how much work they bring. ``df`` is counted, so
    it should be stored.
    """
    tasks = -(-df.count() // rows)
    return df.repartition(max(tasks, df.sparkSession.sparkContext.defaultParallelism), key)


def _border(placed: DataFrame, place: int) -> Column:
    """Sort key of the row at a 1-based place, or the last one, as a scalar subquery."""
    return placed.filter(F.col("_at") < place).agg(F.max("k")).scalar()


def slice_rows(df: DataFrame, order_cols: Sequence[str], lo: int, hi: int | None = None) -> DataFrame:
    """Rows ``lo`` (from 0) up to but without ``hi`` in the order of a unique sort key.

    Only the sort keys are placed, by ranges; the slice itself is a filter, so no other column moves.
    """
    key = F.struct(*order_cols)
    out = df
    if lo > 0 or hi:
        placed = global_positions(df.select(key.alias("k")), [F.col("k")], "_at")
    if lo > 0:
        out = out.filter(key > _border(placed, lo))
    if hi is not None:
        out = out.filter(key <= _border(placed, hi)) if hi > 0 else out.limit(0)
    return out
