"""Corpus pipeline: language ID, near-duplicates, decontamination, secrets, token ids.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; the result is written as Parquet and
read again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.llm import byte_bpe, decontam, langid, ngram_join, secrets
from faultline.llm.common import prepare, read_table, stage
from faultline.session import broadcast_if_small


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6, learnt from the labelled rows: texts without a recognised language go.

    NULL and empty texts and those without a letter have none and go; rows without an id, repeated rows and rows
    without lang are judged by their texts like any other. No rows, no rows.
    """
    return langid.keep_known(docs, langid.fit(langid.training_rows(docs)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: one document of each group stays, that with the smallest id.

    Rows without an id and rows that share one get a number of their own above all ids, so of equal rows one stays, whatever
    their ids. NULL, empty and blank texts link with nothing: all stay.
    """
    known = docs.groupBy("doc_id").count().where("doc_id is null or count > 1").select("doc_id")
    odd_ids = stage(known, "odd_ids")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if not odd_ids.take(1):
        return docs.join(_not_first(docs), "doc_id", "left_anti").select(*columns)
    top = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0)).alias("top")).first()["top"]
    number = F.lit(top + 1) + F.monotonically_increasing_id()
    own = broadcast_if_small(odd_ids.withColumnRenamed("doc_id", "_odd"))
    odd = stage(docs.join(own, F.expr("doc_id <=> _odd"), "left_semi").withColumn("_number", number), "odd")
    rest = docs.join(own, F.expr("doc_id <=> _odd"), "left_anti")
    gone = _not_first(rest.select("doc_id", "text").union(odd.select("_number", "text")))
    return (rest.join(gone, "doc_id", "left_anti").select(*columns)
            .union(odd.join(gone.withColumnRenamed("doc_id", "_number"), "_number", "left_anti").select(*columns)))


def _not_first(docs: DataFrame) -> DataFrame:
    got = ngram_join.jaccard_components(docs)
    return stage(got.where("doc_id <> component_id").select("doc_id").distinct(), "gone")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: contaminated documents go.

    NULL and empty texts hold nothing and stay; rows without an id and repeated rows are judged each by its text.
    Without a benchmark, all rows stay.
    """
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: confirmed secrets are masked; the documents stay.

    NULL and empty texts stay as they are; rows without an id or source and repeated rows are masked like any other.
    """
    return secrets.redact(docs, secrets.fit(secrets.findings_from(docs)))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: ids of every text, with digests of the ids and of the bytes they decode to.

    One row per row: NULL and empty texts have no ids, rows without an id and repeated rows stay.
    """
    return byte_bpe.digest(byte_bpe.encode(docs, decoded=True))


STAGES = [("language ID", language_id), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("secret scan", secret_scan),
          ("byte-level BPE", token_ids)]

#: SQL can't express the language model, the forest or the merges; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
