"""The corpus pipeline: documents in, packed token sequences out, one stage after the other."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import decision_lists, minhash_forest, mixing, packing, toxicity
from freshet.llm.common import free_all, table
from freshet.session import run_dir
from freshet.streaming.shared_files import SharedFiles

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of the kept tokens that the mixture may use, at most one epoch of each source.
MIXED_SHARE = 0.9


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base tests nor the learned rules reject; a null text is rejected."""
    judged = decision_lists.judge(docs, table(spark, sf_dir, "labels"), carry_text=True)
    return judged.where("kept").select(*COLUMNS)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below their language's calibrated threshold; languages without one take 0.7."""
    labels = table(spark, sf_dir, "labels")
    marks = labels.where("toxic is not null").select("doc_id").distinct()
    model = toxicity.train(docs, labels)
    known = toxicity.scored(docs.join(marks, "doc_id", "left_semi"), model).drop("text")
    limit = F.lit(0.7)
    for lang, value in toxicity.calibrated(known, labels).items():
        limit = F.when(F.col("lang") == lang, value).otherwise(limit)
    return toxicity.scored(docs, model).where(F.col("score") < limit).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id; rows without an id stay."""
    judged = minhash_forest.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    named = docs.join(judged, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id is null")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The share of each source that the target weights give it."""
    return mixing.mix(docs, MIXED_SHARE, epochs=1, weights=mixing.TARGET).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces and places of all documents."""
    return packing.pack(docs)


def _after_the_last(stage):
    """``stage`` on documents that stand as a table: what the stages before it have stored can go."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        free_all(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    (name, _after_the_last(stage))
    for name, stage in (
        ("quality rules", quality), ("toxicity", toxic), ("near copies", near_copies), ("mixing", mixed), ("packing", packed)
    )
]

#: Learned rules, a classifier and a tokenizer are beyond SQL; tests/llm tests the operators, the chain has no test of its own yet.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out = run_dir(spark, name.replace(" ", "-"))
        made = stage(spark, docs, sf_dir)
        made.write.parquet(out)
        docs, before, path = spark.read.schema(made.schema).parquet(out), path, out
        if before:
            SharedFiles(spark).remove(before)
    return docs
