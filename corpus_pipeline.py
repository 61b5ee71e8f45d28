"""From raw documents to packed training windows, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``.  ``run`` writes each stage's rows as
Parquet into the shared folder and reads them back as the next one's input.

* language: documents go that have no letter, whose likeliest language is no more
  than ``ABOVE_CHANCE`` of the way from 1/L (L languages) to 1, or whose familiar
  share in it is below ``MIN_FIT`` of the median of held-out texts of the language.
* near_duplicates: of each component of near copies (runs of five words,
  similarity 0.8) the smallest id stays; of rows that repeat an id, one.
* secrets: every secret is masked in place; no document goes.
* mixing: a budget of nine tenths of the tokens is shared among domains,
  languages and sources; a document is taken once or not at all.
* packing: token pieces in windows of 2,048.

Null texts go in the first stage (they have no letter); null languages and
sources are values of their own; extra columns are carried along; an empty
table passes every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import langid, minhash, mixing, packing, secretscan
from headway.llm.common import crc_mod, free_name, fresh_folder, small_batches, staged, table
from headway.llm.queries import MIX_WEIGHTS, domain_of, tokenizer_path
from headway.session import staging_scope

ABOVE_CHANCE = 0.1
MIN_FIT = 0.5
BUDGET = (9, 10)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = langid.train(docs.where(crc_mod("doc_id", 4) != 2))
    names = tuple(free_name(docs, x) for x in ("lang_pred", "lang_score", "lang_fit"))
    chance = 1 / len(model.labels) if model else 0
    found = langid.predict(docs, model, names=names)
    known = F.col(names[0]) != langid.UNDETERMINED
    sure = (F.col(names[1]) >= chance + ABOVE_CHANCE * (1 - chance)) | F.lit(chance == 1)
    return found.where(known & sure & (F.col(names[2]) >= MIN_FIT)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = minhash.near_duplicates(docs)
    gone = staged(found.where(~F.col("kept")).select(F.col("id").alias("doc_id")).distinct(), "gone")
    left = docs.join(gone, "doc_id", "left_anti")
    again = staged(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
                   .select("doc_id"), "repeated")
    if again.isEmpty():
        return left.select(*docs.columns)
    single = left.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return left.join(again, "doc_id", "left_anti").unionByName(single).select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secretscan.redact(docs, fresh_folder(spark, "secrets"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    domain, tokens, copies = (free_name(docs, x) for x in ("domain", "tokens", "copies"))
    weights = {(domain if k == "domain" else k): v for k, v in MIX_WEIGHTS.items()}
    return mixing.mix(docs.withColumn(domain, domain_of(F.col("source"))), weights,
                      lambda total: total * BUDGET[0] // BUDGET[1], max_epochs=1, levels=(domain, "lang", "source"),
                      keep=tuple(docs.columns), names_out=(tokens, copies)).select(*docs.columns)


def windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixture),
    ("packing", windows),
]

#: A trained network decides in the first stage: SQL can't express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_folder(spark, f"pipeline-{name}")
        with staging_scope(spark, name):  # a stage's own tables go when its rows are written
            rows = stage(spark, docs, sf_dir)
            schema = rows.schema
            rows.write.parquet(path)
        docs = spark.read.schema(schema).parquet(path)
    return docs
