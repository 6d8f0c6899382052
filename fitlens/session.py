"""Session settings and tables in the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "fitlens", cores: str = "*", **conf: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for stored tables: the one the cluster names in ``spark.checkpoint.dir``.

    Without one it is a folder of the warehouse, which all executors share as well.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        sc.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/stored")
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    For a result that several branches or rounds read: they scan its columns instead of
    computing it again, its size is known to the planner, its lineage ends here, and a lost
    executor costs no recomputation.
    """
    return _stored(df, {})


def stored_in_files(df: DataFrame, rows: int) -> DataFrame:
    """Like ``stored``, with at most ``rows`` rows in a file: for large rows, as a reader holds a file's rows in batches of thousands."""
    return _stored(df, {"maxRecordsPerFile": rows})


def _stored(df: DataFrame, options: dict[str, int]) -> DataFrame:
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the table behind a DataFrame that ``stored`` returned; it must not be read any more."""
    spark = df.sparkSession
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        if os.path.basename(folder).startswith("table-") and shared_folder(spark).rstrip("/").endswith(os.path.basename(os.path.dirname(folder))):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
