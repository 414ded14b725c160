"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again.

1. Language identification: documents without a letter, or whose most probable language is
   not even half certain, go. It learns from the languages given in the documents it gets.
2. Near-duplicates: of each group of rows linked by a similarity of 0.75 the one with the
   least id stays, a row without an id only if no other has one. Rows that repeat an id are
   one document: one of them stays at most, and a text that copies another document does
   not take the others with it.
3. Secrets: found ones are masked in the text, and n_chars is that of the new text. Every
   document stays.
4. Mixing: sources weigh 5, 2, 1 in turn for 150 % of all words; a document is dropped,
   stays, or is there twice.
5. Packing: every document left, each copy by itself, in sequences of 2048 tokens.

Stages 1 to 4 return the columns of ``documents``, other columns of the input too. Rows
without an id are documents of their own; a null text has no letter, so stage 1 drops it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import langid, mixing, packing, queries, secrets, setsketch, texts
from skyledger.sources.paths import Staging

#: A language less probable than this is none.
LEAST_PROBABLE = 0.5


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, langid.train(docs), LEAST_PROBABLE)


def _with_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """With ``llm_row``, a stored number of its own for each row, whatever its id."""
    return Staging(spark)(docs.withColumn("llm_row", F.monotonically_increasing_id()), "rows")


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row stays or goes by its own text, with or without an id; of the rows that repeat an id one stays at most."""
    rows = _with_rows(spark, docs)
    kept = setsketch.near_duplicates(rows, percent=75, row="llm_row", one_per_id=True).kept
    return rows.join(kept.withColumnRenamed("row", "llm_row"), "llm_row", "left_semi").select(*docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are taken by their own numbers, also where they repeat an id or have none."""
    rows = _with_rows(spark, docs)
    sized = rows.select("doc_id", "source", texts.word_count(F.col("text")).alias("size"), "llm_row")
    taken = mixing.mix(sized, row="llm_row").where("copies > 0").select("llm_row", F.col("copies").cast("int").alias("llm_copies"))
    joined = rows.join(taken.hint("merge"), "llm_row")  # as many as the documents: not broadcast at any size
    return joined.withColumn("llm_copy", F.explode(F.sequence(F.lit(1), F.col("llm_copies")))).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, queries.BYTES, capacity=2048, end_id=0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", identified),
    ("near_duplicates", deduplicated),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL cannot express the stages; the tests compare them with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents of ``sf_dir`` that are left."""
    stage = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
