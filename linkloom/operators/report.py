"""How many links lead where, rolled up from folders to hosts to sessions. An extension: a summary of what the other operators find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's registers: 4,096, so distinct counts have a standard error of 1.04 / 64 = 1.6 %, and small ones hardly any.
SKETCH = 12
LEVELS = ("session_id", "host", "folder")


def folder(resolved: Column) -> Column:
    """The first part of an address's path, with its slashes."""
    return F.regexp_extract(resolved, r"^[^:]*://[^/?#]*(/[^/?#]*/|/?)", 1)


def sketched(targets: DataFrame) -> DataFrame:
    """session_id, host, folder, n_links, pages: sums and a sketch of the pages that link there. Such rows can be kept and rolled up with later ones."""
    return targets.groupBy("session_id", "host", folder(F.col("resolved")).alias("folder")).agg(F.count(F.lit(1)).alias("n_links"), F.hll_sketch_agg("page_id", SKETCH).alias("pages"))


def rolled_up(sketches: DataFrame) -> DataFrame:
    """session_id, host, folder, level (0: a folder, 1: a host, 2: a session, 3: all), n_links, n_pages (an estimate). What a level adds up is null."""
    level = F.when(F.grouping("session_id") == 1, 3).when(F.grouping("host") == 1, 2).when(F.grouping("folder") == 1, 1).otherwise(0)
    return sketches.rollup(*LEVELS).agg(level.alias("level"), F.sum("n_links").alias("n_links"), F.hll_sketch_estimate(F.hll_union_agg("pages")).alias("n_pages")).select(*LEVELS, "level", "n_links", "n_pages")
