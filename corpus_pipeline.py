"""A corpus pipeline over documents: each stage calls one operator and works on what the stage before it kept.

Defined results of all stages: rows with null ids are rows like others, and equal rows are judged alike. A null or empty text has
no words, so the first stage rejects it; the others, run by themselves, keep it: it is a copy of other such texts alone, holds no benchmark
item and no secret, and has no tokens. Texts are processed whole, however long. An empty table gives an empty table. Columns
other than those of documents are not carried on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlake.llm.bpe import encode_digests
from boardlake.llm.common import discard_others, table, written, written_tables
from boardlake.llm.decontaminate import drop_contaminated
from boardlake.llm.neardup import keep_one
from boardlake.llm.quality import judge_quality
from boardlake.llm.secrets import mask_secrets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and are no outliers of their language and source. Equal rows all stay or all go."""
    return judge_quality(docs).filter(F.col("kept")).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: that of the least id, null counting as -1; of rows equal in id and text one stays."""
    return keep_one(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; each of equal rows stays or goes. An empty benchmark rejects nothing."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, repeated ones too, with secrets masked; n_chars follows the text and is null for a null text."""
    return mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of tokens and the digests of ids and decoded text of each document, a row for each, repeated ones too."""
    return encode_digests(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", bpe_encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written before the next reads it; then the tables that it wrote on its way, and its input, are deleted."""
    docs, others = table(spark, sf_dir, "documents").select(*COLUMNS), written_tables()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
            discard_others(docs, *others)
    return docs


#: The robust estimate and the vocabulary's merges have no SQL form; tests check the stages against brute force.
ORACLE_SQL = None
