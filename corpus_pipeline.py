"""A training-data pipeline over ``documents``: quality, language, near duplicates, secrets, packing.

Each stage takes the session, the documents left so far and the folder of tables, and returns documents, the last one
packed pieces. ``run`` applies them in order; every stage's result is written and read again, so a lost executor costs
the stage at hand only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixloom.llm import language_id, quality_pu, secret_scan
from helixloom.llm.bin_packing import pack_documents
from helixloom.llm.minhash_dedup import near_duplicates
from helixloom.llm.queries import tokenizer_path
from helixloom.llm.shared import SharedTables, dropped_after

QUALITY_CUT = 0.5
LANGUAGE_SCORE = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose quality score reaches QUALITY_CUT, as they are.

    Rows are judged one by one, so repeated rows and null ids need no special case; null texts are scored like empty ones.
    Whole texts count. Without positive labels there is no model and all rows stay; an empty table gives an empty one.
    """
    net = quality_pu.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return quality_pu.good_quality(docs, net, cut=QUALITY_CUT)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows in a recognised language, as they are.

    Null, empty and blank texts and texts without a letter have none and go. Rows are judged one by one, so repeated rows and
    null ids need no special case. If no row has a language there is nothing to learn from, nothing is recognised and
    nothing stays; an empty table gives an empty one.
    """
    return language_id.known_language(docs, language_id.fit(docs, F.lit(True)), least=LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates (five words, 0.8 or more), as it is: the row of least doc_id.

    Decided row by row: of rows that repeat an id with near texts one stays, different texts under one id are judged apart,
    and rows without an id come last in their group. Ties go to any one row. Rows with a null, empty or blank text are
    near to nothing and stay. An empty table gives an empty one.
    """
    store = SharedTables(spark, "rows")
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = store.write(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(rows, id_col=row).select(F.col(row).alias("r"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row))
    named = rows.select(row, "doc_id").join(groups, F.col(row) == F.col("r"))
    kept = named.groupBy("component_id").agg(F.min_by(row, order).alias(row)).select(row)
    return rows.join(kept, row, "left_semi").select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces each secret by a mark; n_chars follows, all else stays as it was, and so do rows without a secret.

    Null and empty texts stay as they are. Repeated rows and null ids need no special case; an empty table gives an empty one.
    """
    return secret_scan.without_secrets(docs, secret_scan.fit(docs), size_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the tokens of all rows into sequences of at most 1024 tokens; a row per piece.

    Null and empty texts are their end token alone; repeated rows and rows without an id are packed each. An empty table gives
    an empty one.
    """
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("secrets", secrets), ("packing", packing)]

#: Trained models and tokenizers can't be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage's operators keep in the shared folder goes once its result is stored, and so does
    the result before it."""
    store = SharedTables(spark, "pipeline")
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with dropped_after():
            docs = store.write(stage(spark, docs, sf_dir), name)
        store.drop(*stored)
        stored = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
