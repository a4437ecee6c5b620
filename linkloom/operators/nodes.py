"""What is written down about a discovered address, and counts for each page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import constants as C
from linkloom.operators import extract


def placeholder_nodes(targets: DataFrame) -> DataFrame:
    note = F.when(F.col("is_new_subdomain"), F.lit(C.NEW_SUBDOMAIN + C.NOTE)).otherwise(F.lit(C.NOTE))
    return targets.select("session_id", "page_id", F.lit("GET").alias("method"), "uri", "resolved", "host", "is_new_subdomain", note.alias("note"), F.lit(C.ENTRY_TYPE).alias("entry_type"), F.col("url").alias("source_url"))


def page_metrics(responses: DataFrame, javascript: bool = True) -> DataFrame:
    """session_id, page_id, n_bytes looked through, n_candidates. Bodies are looked through once; pages without a candidate are there too."""
    sized = responses.withColumn("n_bytes", F.octet_length("body").cast("long"))
    none = F.lit(None).cast("long")
    raw = extract.raw_candidates(sized, javascript, ("n_bytes",), empty=True).unionByName(extract.header_candidates(responses).withColumn("n_bytes", none))
    return extract.judged(raw, javascript).groupBy("session_id", "page_id").agg(F.max("n_bytes").alias("n_bytes"), F.countDistinct("candidate").alias("n_candidates"))
