"""Corpus pipeline: language ID, line dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of ``documents``;
the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import langid, lines, minhash, mixing, packing
from revlens.llm.common import shared_folder, table
from revlens.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def with_text_size(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text no language model accepts go; the others get the predicted language.

    Null, empty and letterless texts go with them, whatever their id. Rows that repeat an id are judged each by its text;
    further columns are dropped. Without labelled rows no language is known and nothing stays.
    """
    model = langid.fit(docs)
    kept = langid.predict(docs.select(*COLUMNS, F.col("text").alias("_text")), model, text_col="_text", keep=list(COLUMNS)).filter(~F.col("rejected"))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go; documents of which nothing is left go with them.

    A null id comes before all others. Null texts have no lines and stay; rows that repeat id and text share one result.
    """
    out = lines.dedup_lines(docs.select(*COLUMNS))
    return with_text_size(out.filter("n_removed < n_lines or n_lines = 0"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that with the smallest id.

    Of the rows that repeat a kept id, that with the longest text stays. Rows without an id are linked with nothing, nor are
    null and blank texts: all stay.
    """
    docs = docs.select(*COLUMNS)
    kept = minhash.near_duplicates(docs, size=5, percent=80).filter("kept").groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    found = docs.filter("doc_id is not null").join(kept, "doc_id")
    longest = F.max(F.struct(F.length("text"), *[F.col(c) for c in COLUMNS if c != "doc_id"])).alias("_row")
    several = found.filter("_rows > 1").groupBy("doc_id").agg(longest).select("doc_id", *[f"_row.{c}" for c in COLUMNS if c != "doc_id"])
    return docs.filter("doc_id is null").unionByName(found.filter("_rows = 1").select(*COLUMNS)).unionByName(several.select(*COLUMNS))


def row_key() -> Column:
    """Key of a row by its values; nulls count as values."""
    return F.xxhash64(*[c for name in COLUMNS for c in (F.col(name).isNull(), F.col(name))])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are sampled to the raked target weights, each by its own decision, with or without an id; equal rows share one.

    Null source, language and text are values of their own; an empty table stays empty.
    """
    docs = docs.select(*COLUMNS).withColumn("_key", row_key())
    kept = mixing.mix(docs, id_col="_key").filter("kept").select(F.col("doc_id").alias("_key")).distinct()
    return docs.join(kept, "_key", "left_semi").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows are packed, null texts as the end token alone, rows without an id with a null id."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixture", mixture), ("pack", pack)]

#: Tokenisation and the language models cannot be written in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's output is written as Parquet to the shared folder and read again; the last one's is returned."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
