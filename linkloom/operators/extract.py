"""From responses to candidates: links as they stand in bodies and headers, one row for each place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from linkloom.functions import rules, text, urls
from linkloom.functions.patterns import DOMAIN, active

BODY, HEADER = 0, 2


def once(df: DataFrame, **columns) -> DataFrame:
    """df with columns that are worked out once however often they are used: a generator keeps plans from copying them."""
    made = F.struct(*(c.alias(n) for n, c in columns.items()))
    return df.select("*", F.explode_outer(F.array(made)).alias("_once")).select(*df.columns, *(F.col(f"_once.{n}").alias(n) for n in columns))


def raw_candidates(responses: DataFrame, javascript: bool = True, kept: tuple[str, ...] = (), empty: bool = False, repeats: bool = True) -> DataFrame:
    """session_id, page_id, url, pass, chunk_no, pattern_no, ord, raw of all finds in bodies, and the columns `kept`. empty: a row without a find for pages that have none.
    repeats=False: what a page has at several places comes with the first of them only."""
    own = ("session_id", "page_id", "url", *kept)
    parts = once(once(responses.select(*own, "body"), decoded=text.decode_entities(F.col("body"))), chunks=text.chunks(F.col("decoded")))
    finds = text.candidates(F.col("chunks"), active(javascript))
    found = parts.select(*own, F.explode_outer(finds if repeats else text.first_finds(finds, active(javascript))).alias("c"))
    return (found if empty else found.where("c is not null")).select(*own, F.lit(BODY).alias("pass"), "c.chunk_no", "c.pattern_no", "c.ord", "c.raw")


def header_candidates(responses: DataFrame) -> DataFrame:
    """The same shape, from source-map headers: trimmed, resolved against the page where they can be."""
    headers = F.array(F.col("source_map"), F.col("x_source_map"))
    each = responses.select("session_id", "page_id", "url", F.posexplode(headers).alias("ord", "raw")).withColumn("raw", rules.trimmed(F.col("raw"))).where("raw <> ''")
    solved = urls.resolve(each, "url", "raw")
    return solved.select("session_id", "page_id", "url", F.lit(HEADER).alias("pass"), F.lit(0).alias("chunk_no"), F.lit(0).alias("pattern_no"), "ord", F.coalesce("resolved", "raw").alias("raw"))


def _is_domain(javascript: bool) -> Column:
    names = [p.name for p in active(javascript)]
    return (F.col("pass") == BODY) & (F.col("pattern_no") == names.index(DOMAIN))


def _tidy(marked: DataFrame) -> DataFrame:
    """Finds with the `candidate` that they stand for, normalised (bodies) but not checked."""
    known = once(marked, _plain=rules.plain(F.col("raw")))
    odd = (F.col("pass") == BODY) & ~F.col("_plain")
    cut = once(once(known, _tidy=F.when(odd, rules.tidied(F.col("raw")))), _cut=rules.bracket_cut(F.col("_tidy")))
    link = F.when(odd, rules.finished(F.col("_cut"))).otherwise(F.col("raw"))
    return once(cut, candidate=F.when(F.col("_plain"), F.col("raw")).otherwise(rules.trimmed(link))).drop("_plain", "_tidy", "_cut")


def accepted(raw: DataFrame, javascript: bool = True) -> DataFrame:
    """Finds that are links."""
    domain = _is_domain(javascript)
    marked = raw.where(~domain | rules.valid_domain(F.col("raw"))).withColumn("raw", F.when(domain, F.concat(F.lit("//"), "raw")).otherwise(F.col("raw")))
    return _tidy(marked).where(rules.usable(F.col("candidate")))


def judged(raw: DataFrame, javascript: bool = True) -> DataFrame:
    """All finds; their candidate is null if they are no link."""
    domain = F.coalesce(_is_domain(javascript), F.lit(False))
    marked = raw.withColumn("raw", F.when(~domain, F.col("raw")).when(rules.valid_domain(F.col("raw")), F.concat(F.lit("//"), "raw")))
    return _tidy(marked).withColumn("candidate", F.when(rules.usable(F.col("candidate")), F.col("candidate")))


def seen_pages(responses: DataFrame, counter: Observation | str | None) -> DataFrame:
    """Counts pages and bytes on their way: in an Observation, or under a name that a stream's progress has."""
    return responses if counter is None else responses.observe(counter, F.count(F.lit(1)).alias("n_pages"), F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).cast("long").alias("n_bytes"))


def seen_links(found: DataFrame, counter: Observation | str | None) -> DataFrame:
    return found if counter is None else found.observe(counter, F.count(F.lit(1)).alias("n_candidates"))


def found_candidates(responses: DataFrame, javascript: bool = True, headers: bool = True, counter: Observation | str | None = None, repeats: bool = True) -> DataFrame:
    """Every find that is a link, with its place."""
    raw = raw_candidates(seen_pages(responses, counter), javascript, repeats=repeats)
    if headers:
        raw = raw.unionByName(header_candidates(responses))
    found = accepted(raw, javascript)
    return found.select("session_id", "page_id", "url", "candidate", F.struct("pass", "chunk_no", "pattern_no", "ord").alias("place"))


def distinct_candidates(found: DataFrame) -> DataFrame:
    """One row for each page and candidate: its first place."""
    return found.groupBy("session_id", "page_id", "url", "candidate").agg(F.min("place").alias("place"))


def extract_candidates(responses: DataFrame, javascript: bool = True, headers: bool = True, counter: Observation | str | None = None) -> DataFrame:
    return distinct_candidates(found_candidates(responses, javascript, headers, counter, repeats=False))
