"""Helpers shared by the operators: tables, shared scratch folders, staging."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import staging_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share (it goes with the run)."""
    return staging_folder(spark, f"llm-{name}")


def staged(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet to a fresh shared folder and read it back:
    cuts the lineage, survives lost executors, and gives later joins a size
    known from the files."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (however names are compared)."""
    taken = {c.lower() for c in df.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(text: Column | str) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def crc_mod(key: Column | str, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``."""
    col = F.col(key) if isinstance(key, str) else key
    return F.crc32(col.cast("string").cast("binary")) % n


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker process, so that a
    reused worker loads a tokenizer once."""
    return sys.modules.setdefault("_headway_llm_cache",
                                  types.ModuleType("_headway_llm_cache")).__dict__


def small_batches(spark: SparkSession, rows: int = 500) -> None:
    """Hand Python workers at most ``rows`` rows at a time (a session setting;
    a smaller one of the caller stays).  Whole texts are wide rows: the usual
    10,000 of them are held several times over between JVM and Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))
