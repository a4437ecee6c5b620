"""From candidates to addresses on the web, and which of them lead to another host."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions import rules, urls
from linkloom.operators.extract import once


def base_host(url):
    """The lower-cased host of a page's address."""
    server = rules.replaced(F.regexp_extract(url, r"^[^/?#]*://([^/?#]*)", 1), r"^[^@]*@")
    return F.lower(F.substring_index(server, ":", 1))


def targets(candidates: DataFrame, discover_subdomains: bool = True) -> DataFrame:
    """Candidates with resolved, host, is_new_subdomain and uri; those without a usable address go, and those with a fragment."""
    parts = F.struct("resolved", "host", "path", "ref")  # worked out once: filters on them would be worked out before them otherwise
    found = once(urls.resolve(candidates, "url", "candidate").select(*candidates.columns, parts.alias("_parts")), _found=F.col("_parts"))
    solved = found.select(*candidates.columns, "_found.*").where("resolved is not null and coalesce(ref, '') = ''")
    hosted = solved.withColumn("host", F.lower("host")).where(rules.valid_hostname(F.col("host")) & ~rules.junk_token(F.concat("host", "path")))
    flagged = hosted.withColumn("is_new_subdomain", F.col("host") != base_host(F.col("url")))
    if not discover_subdomains:
        flagged = flagged.where("not is_new_subdomain")
    rooted = flagged.withColumn("resolved", urls.root_slash(F.col("resolved"), F.col("path"), F.col("is_new_subdomain")))
    return rooted.withColumn("uri", urls.encoded(F.col("resolved"))).select(*candidates.columns, "resolved", "host", "is_new_subdomain", "uri")
