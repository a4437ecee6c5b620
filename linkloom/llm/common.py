"""Helpers that the operators share: columns, the cluster's shared folder, tables written there."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.storage import discard, materialize, shared_dir
from linkloom.workers import BATCH_BYTES, bound_batches, give_back, sparing

#: What separates words: space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def n_words(column: Column) -> Column:
    """Number of words; null counts as an empty text."""
    return F.size(F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(WORD), F.lit(0))).cast("long")


def split_join(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """left joined with right, which has one row a key. left is read twice.

    A key that many of left's rows share is dealt over several tasks by a hash of `spread`, and right's row of it copied to
    each. Such keys are few: each has more than a quarter of an even partition's rows.
    """
    partitions = 4 * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(1000, left.count() // partitions)
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    hot = F.broadcast(materialize(counts.select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_copies")), "hot-keys"))  # as many rows as `partitions` at most
    dealt = left.join(hot, key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(spread), F.col("_copies")).cast("int"), F.lit(0))).drop("_copies")
    parts = F.sequence(F.lit(0), F.coalesce(F.col("_copies") - 1, F.lit(0)))
    copied = right.join(hot, key, "left").withColumn("_part", F.explode(parts)).drop("_copies")
    return dealt.join(copied, [key, "_part"]).drop("_part")


def grid(left: DataFrame, right: DataFrame, row: Column, column: Column) -> DataFrame:
    """Each row of left (counted) beside each row of right, both blocks of many: dealt to the places of a grid by numbers `row` and
    `column`, and joined by equal places. There are about as many places as partitions, so a block is copied to a row or a column of these."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = max(1, min(left.count(), isqrt(n)))
    columns = -(-n // rows)
    own = left.withColumns({"_i": F.pmod(row, F.lit(rows)).cast("int"), "_j": F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))})
    data = right.withColumns({"_j": F.pmod(column, F.lit(columns)).cast("int"), "_i": F.explode(F.sequence(F.lit(0), F.lit(rows - 1)))})
    return own.join(data, ["_i", "_j"]).drop("_i", "_j")


def shielded(df: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df with all columns but `used` under names of our own, and what gives such rows their names back, in df's order."""
    names = {c: c if c in used else f"_column_{i}" for i, c in enumerate(df.columns)}
    hidden = df.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    return hidden, lambda out: out.select(*(F.col(n).alias(c) for c, n in names.items()))


__all__ = ["BATCH_BYTES", "WORD", "bound_batches", "discard", "give_back", "grid", "materialize", "n_words", "shared_dir", "shielded", "sparing", "split_join", "table", "text_or_empty"]
