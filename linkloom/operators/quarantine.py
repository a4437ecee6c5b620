"""Responses that can't be looked through, each with the stage that stopped it and the reason.

    good, bad = fine(responses), held(responses)      # each row of responses is in one of them

Stages, in order: `archive` (a record that couldn't be read: column `error`), `gate` (nothing to search, or not to be searched),
`address` (nothing resolves against it), `charset` (no such charset: column `decode_error`, of decode_bytes). Columns that responses lack stop nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import urls
from linkloom.sources.pages import searchable


def judged(responses: DataFrame, in_scope: Column | None = None) -> DataFrame:
    """responses with stage and reason; both null if there is nothing against a row."""
    own = responses.columns
    said = lambda c: F.col(c).isNotNull() if c in own else F.lit(False)
    steps = (
        (said("error"), "archive", F.col("error") if "error" in own else F.lit(None)),
        (F.coalesce(F.length("body"), F.lit(0)) == 0, "gate", F.lit("no body")),
        (F.col("content_type").isNull(), "gate", F.lit("no content type")),
        (~searchable(F.col("content_type")), "gate", F.lit("content type not searched")),
        (F.col("url").isNull(), "gate", F.lit("no address")),
        (F.lit(False) if in_scope is None else ~F.coalesce(in_scope, F.lit(False)), "gate", F.lit("out of scope")),
        (~urls.is_address(F.col("url")), "address", F.lit("not an address")),
        (said("decode_error"), "charset", F.col("decode_error") if "decode_error" in own else F.lit(None)),
    )
    held = F.lit(None).cast("struct<stage:string,reason:string>")
    for stops, stage, reason in reversed(steps):
        held = F.when(stops, F.struct(F.lit(stage).alias("stage"), reason.cast("string").alias("reason"))).otherwise(held)
    return responses.withColumn("_held", held).select(*own, F.col("_held.stage").alias("stage"), F.col("_held.reason").alias("reason"))


def fine(responses: DataFrame, in_scope: Column | None = None) -> DataFrame:
    return judged(responses, in_scope).where("stage is null").select(*responses.columns)


def held(responses: DataFrame, in_scope: Column | None = None) -> DataFrame:
    """session_id, page_id, url, stage, reason: without bodies."""
    return judged(responses, in_scope).where("stage is not null").select("session_id", "page_id", "url", "stage", "reason")
