"""The corpus pipeline: each stage calls one operator and hands a table of documents on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.base import saved, table
from freshet.llm.exact_dedup import drop_exact_duplicates
from freshet.llm.mixing import mixed
from freshet.llm.pieces import encode, load_pieces
from freshet.llm.simhash import drop_near_duplicates
from freshet.llm.toxicity import toxicity

#: The SentencePiece model of the last stage.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    return toxicity(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, that with the largest doc_id."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that with the smallest doc_id."""
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, ids): what a training job reads."""
    text = F.coalesce("text", F.lit("")).alias("text")
    return encode(docs.select("doc_id", "source", text), load_pieces(PIECES)).select("doc_id", "source", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("sentencepiece", tokenize),
]

#: Training a classifier and balanced sampling have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
