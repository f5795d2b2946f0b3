"""A corpus pipeline over the documents table: score, drop, deduplicate, decontaminate, encode."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gripelode.llm import common, decontaminate, jaccard, lines, sentencepiece_codec, toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Folders that the stage before has staged. Its rows are written and read again before the next stage begins.
_left: list[str] = []


def tidy(stage: Stage) -> Stage:
    """A stage that first removes what the stage before has staged, unless its documents still come from there."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not any(folder in path for path in docs.inputFiles() for folder in map(_below, _left)):
            common.drop_folders(spark, _left)
            _left.clear()
        with common.staged_into(_left):
            return stage(spark, docs, sf_dir)

    return run


def _below(folder: str) -> str:
    """A folder's path without its store, which paths of files name in more than one way."""
    return folder.split(":", 1)[-1].replace("//", "/").rstrip("/") + "/"


@tidy
def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not call toxic; rows with a null id stay."""
    scores = toxicity.score(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = scores.where("predicted = 1").select(F.col("doc_id").alias("_toxic")).distinct()
    return docs.join(toxic, docs["doc_id"] == F.col("_toxic"), "left_anti")


@tidy
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents hold stay in one of them; n_chars follows the text."""
    out = lines.deduplicated(docs)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


@tidy
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingle similarity the one with the smallest id; rows with a null id stay."""
    gone = jaccard.classes(docs).where("doc_id > component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("_gone"), "left_anti")


@tidy
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@tidy
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of the texts that are left."""
    return sentencepiece_codec.encode(docs).select("doc_id", "n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", keep_clean),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", drop_leaks),
    ("sentencepiece", encode),
]

#: Learned scores, fingerprints and tokens are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
