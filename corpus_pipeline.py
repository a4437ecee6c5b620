"""A corpus pipeline: each stage calls one operator on all that the stage before it kept.

quality    drops documents that cost the language model more than their language's threshold
near_dups  keeps one document of each group of near-duplicates (5-word shingles, similarity 0.8)
secrets    replaces secrets in texts
mixing     repeats or drops documents so that sources get their weights; a document at the border stays whole
tokens     encodes texts and checks that they decode to themselves

Cases: null and empty texts go with `quality`, texts without a word with `mixing` at the latest. Rows that agree in doc_id and text count once
after `near_dups`; rows with a null doc_id go if their group has any other. Texts of any length go through whole. Columns that
an operator doesn't know are kept, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm import bpe, kneser, mixing, neardup, secrets
from linkloom.llm.common import materialize, shielded, table
from linkloom.llm.queries import VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hidden, back = shielded(docs, ("doc_id", "text", "lang"))
    judged = kneser.classify(hidden, table(spark, sf_dir, "labels"), keep=tuple(hidden.columns))
    return back(judged.where("not rejected"))


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hidden, back = shielded(docs, ("doc_id", "text"))
    return back(neardup.deduplicate(hidden, width=5, percent=80))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hidden, back = shielded(docs, ("doc_id", "text"))
    found = secrets.scan(hidden, keep=tuple(c for c in hidden.columns if c not in ("doc_id", "text")))
    clean = back(found.withColumn("text", secrets.redacted(F.col("text"), F.col("spans"))))
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hidden, back = shielded(docs, ("doc_id", "text", "source"))
    kept = tuple(c for c in hidden.columns if c not in ("doc_id", "source"))
    taken = mixing.mix_sources(hidden, keep=kept).where("taken > 0")
    return back(taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int")))))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(docs.select("doc_id", "text", "lang", "source"), VOCABULARY)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [("quality", quality), ("near_dups", near_dups), ("secrets", no_secrets), ("mixing", mixed), ("tokens", tokens)]

#: Hashes, models and seeded choices are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
