"""All queries of the link-discovery operators and the SQL that they are checked against."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom import oracle as O  # noqa: E741, N812
from linkloom.functions import rules, text, urls
from linkloom.functions.patterns import DOMAIN, PATTERNS, Pattern
from linkloom.operators import dedupe, extract, nodes, report, targets
from linkloom.operators.quarantine import held
from linkloom.options import Options
from linkloom.plans.discover import discover, found_targets
from linkloom.samples import ARCHIVED_SQL, RESPONSES_SQL, archived, responses
from linkloom.sources import pages, warc
from linkloom.storage import materialize, shared_dir
from linkloom.streaming import stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


HOST = "lower(regexp_extract(url, '^[^:]*://([^/?#:]*)', 1))"


@query(f"with {O.all_candidates(gate=O.GATE)}, {O.targets()} select host, count(*) as n_links, count(distinct page_id) as n_pages, sum(is_new_subdomain::int)::bigint as n_new from targets group by host")
def link_graph_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many links lead to each host, from how many pages."""
    found = found_targets(responses(spark, sf_dir), Options())
    n = lambda c: F.count(c)
    return found.groupBy("host").agg(n(F.lit(1)).alias("n_links"), F.countDistinct("page_id").alias("n_pages"), F.sum(F.col("is_new_subdomain").cast("long")).alias("n_new"))


@query(f"with {RESPONSES_SQL} select page_id, content_type from responses where regexp_matches(lower(content_type), 'html|javascript|json|xml|css')")
def gate_content_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses(spark, sf_dir).where(pages.searchable(F.col("content_type"))).select("page_id", "content_type")


@query(f"with {RESPONSES_SQL} select page_id, {HOST} as host from responses where {O.GATE} and {HOST}[1:4] = 'www.'")
def gate_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = targets.base_host(F.col("url"))
    return pages.gated(responses(spark, sf_dir), F.startswith(host, F.lit("www."))).select("page_id", host.alias("host"))


@query(f"with {RESPONSES_SQL}, {O.headers()} select page_id, ord, candidate from h2")
def source_map_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.header_candidates(responses(spark, sf_dir)).select("page_id", "ord", F.col("raw").alias("candidate"))


@query(f"with {RESPONSES_SQL}, {O.DECODED} select page_id, length(body) as n_chars, sha256(body) as body_sha256 from decoded")
def decode_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.once(responses(spark, sf_dir).select("page_id", "body"), d=text.decode_entities(F.col("body")))
    return found.select("page_id", F.length("d").cast("long").alias("n_chars"), F.sha2("d", 256).alias("body_sha256"))


@query(f"with {RESPONSES_SQL}, {O.DECODED}, {O.CHUNKS} select page_id, chunk_no, length(chunk) as n_chars, sha256(chunk) as chunk_sha256 from chunks")
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract.once(responses(spark, sf_dir).select("page_id", "body"), d=text.decode_entities(F.col("body")))
    parts = found.select("page_id", F.posexplode(text.chunks(F.col("d"))).alias("chunk_no", "chunk"))
    return parts.select("page_id", "chunk_no", F.length("chunk").cast("long").alias("n_chars"), F.sha2("chunk", 256).alias("chunk_sha256"))


def _extraction(no: int, pattern: Pattern) -> None:
    domain = pattern.name == DOMAIN
    where = f"where {O.valid_domain('raw')}" if domain else ""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = extract.once(extract.once(responses(spark, sf_dir).select("page_id", "body"), d=text.decode_entities(F.col("body"))), c=text.chunks(F.col("d")))
        raw = found.select("page_id", F.explode("c").alias("chunk")).select("page_id", F.explode_outer(text.finds(F.col("chunk"), pattern)).alias("raw")).where("raw is not null")
        if domain:
            raw = raw.where(rules.valid_domain(F.col("raw")))
        return raw.groupBy("page_id", "raw").agg(F.count(F.lit(1)).alias("n"))

    run.__name__ = f"extract_{pattern.name}"
    query(f"with {RESPONSES_SQL}, {O.DECODED}, {O.CHUNKS}, {O.raw((pattern,))} select page_id, raw, count(*) as n from raw {where} group by page_id, raw")(run)


for _no, _pattern in enumerate(PATTERNS):
    _extraction(_no, _pattern)


#: Host names to try, made of a page's own and its id.
HOSTS = ("{h}", "s{n}-.{h}", "{h}.{n}.", ".{h}", "{h}..", "n{n}_m.{h}", "_{h}", "10.{n}.0.9", "intra{n}", "tab\t{h}", "{h}_", "ö.{h}")


def _hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    one = F.element_at(F.array(*map(F.lit, HOSTS)), (F.col("page_id") % len(HOSTS) + 1).cast("int"))
    return table.select("page_id", F.replace(F.replace(one, F.lit("{h}"), targets.base_host(F.col("url"))), F.lit("{n}"), F.col("page_id").cast("string")).alias("host"))


_DOMAINS = next(p for p in PATTERNS if p.name == DOMAIN)


@query(f"""with {RESPONSES_SQL}, {O.DECODED}, {O.CHUNKS}, {O.raw((_DOMAINS,))},
h as (select page_id, replace(replace([{", ".join(map(O.q, HOSTS))}][page_id % {len(HOSTS)} + 1], '{{h}}', {HOST}), '{{n}}', page_id::varchar) as host from pages union select page_id, split_part(raw, '/', 1) from raw)
select page_id, host, {O.valid_hostname("host")} as valid from h""")
def valid_hostname(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names made of each page's own, and all that looks like one in its body."""
    found = extract.once(extract.once(responses(spark, sf_dir).select("page_id", "body"), d=text.decode_entities(F.col("body"))), c=text.chunks(F.col("d")))
    names = found.select("page_id", F.explode("c").alias("chunk")).select("page_id", F.explode_outer(text.finds(F.col("chunk"), _DOMAINS)).alias("raw")).where("raw is not null").select("page_id", F.substring_index("raw", "/", 1).alias("host"))
    return _hosts(spark, sf_dir).unionByName(names).distinct().select("page_id", "host", rules.valid_hostname(F.col("host")).alias("valid"))


@query(f"with {RESPONSES_SQL}, {O.DECODED}, {O.CHUNKS}, {O.raw(PATTERNS)}, {O.normal('raw', 'page_id, pattern_no, raw')} select distinct page_id, raw, candidate from t4")
def normalize_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = extract.raw_candidates(responses(spark, sf_dir)).select("page_id", "raw").distinct()
    return raw.withColumn("candidate", rules.normalised(F.col("raw")))


#: Texts with brackets of all sorts.
BRACKETED = ("/x(a)b(c{n}", "a(b]c{n}", "/p{id}/q{n}", "/q[{n}]{[()]}", "]{n}", "((({n})))", "({n}[)]", "plain{n}", "{a{b}{n}", "x)y(z{n})")


@query(rf"""with {RESPONSES_SQL}, {O.DECODED}, {O.CHUNKS}, {O.raw(PATTERNS)},
b as (select page_id, replace([{", ".join(map(O.q, BRACKETED))}][page_id % {len(BRACKETED)} + 1], '{{n}}', page_id::varchar) as s from pages union select page_id, {O.tidied("raw")} from raw)
select page_id, s, substr(s, 1, length(regexp_extract({O.masked("s")}, '^[^()\[\]{{}}]*'))) as cut from b""")
def bracket_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with brackets of all sorts, and all finds of all pages. (The SQL takes eight levels of brackets at most.)"""
    one = F.element_at(F.array(*map(F.lit, BRACKETED)), (F.col("page_id") % len(BRACKETED) + 1).cast("int"))
    made = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.replace(one, F.lit("{n}"), F.col("page_id").cast("string")).alias("s"))
    finds = extract.once(extract.raw_candidates(responses(spark, sf_dir)).select("page_id", "raw"), s=rules.tidied(F.col("raw"))).select("page_id", "s")
    return made.unionByName(finds).distinct().withColumn("cut", rules.bracket_cut(F.col("s")))


def _filter(name: str, keep: Callable, sql: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = extract.raw_candidates(responses(spark, sf_dir)).select("page_id", "raw").distinct()
        tidy = extract.once(raw, candidate=rules.trimmed(rules.normalised(F.col("raw")))).where("candidate is not null")
        return tidy.select("page_id", "candidate").distinct().where(keep(F.col("candidate")))

    run.__name__ = name
    normal = O.normal("raw", "page_id")
    query(f"with {RESPONSES_SQL}, {O.DECODED}, {O.CHUNKS}, {O.raw(PATTERNS)}, {normal}, t5 as (select distinct page_id, {O.trimmed('candidate')} as candidate from t4 where candidate is not null) select * from t5 where {sql}")(run)


_filter("filter_junk_ext", lambda c: ~rules.junk_extension(c), f"not regexp_matches(candidate, {O.JUNK_EXTENSION})")
_filter("filter_scheme", lambda c: ~rules.dropped_scheme(c), f"not regexp_matches(candidate, {O.BAD_SCHEME})")
_filter("filter_shape", lambda c: ~rules.odd_shape(c), f"not {O.odd_shape('candidate')}")
_filter("filter_junk_token", lambda c: ~rules.junk_token(c), f"not {O.junk_token('candidate')}")


@query(f"with {O.all_candidates()} select page_id, candidate from candidates")
def page_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_candidates(responses(spark, sf_dir)).select("page_id", "candidate")


@query(f"with {O.all_candidates(False)} select page_id, candidate from candidates")
def page_distinct_no_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_candidates(responses(spark, sf_dir), javascript=False).select("page_id", "candidate")


#: Links of the sorts that pages hold.
LINKS = ("d{n}.html", "/r/{n}", "//h{n}.example.com/p", "HTTPS://H{n}.com", "?x={n}", "./v/{n}", "a//b/../c{n}", "/m/../n{n}", "wss://ws.example.com/{n}", "x.js:{n}", "#/r{n}", "http://h:9x/", "http://h.example.com:8080/{n}?q=/a#b", "sub/dir/{n}?a=b/../c", "")
_MADE = f"select 0 as session_id, page_id, url, replace([{', '.join(map(O.q, LINKS))}][page_id % {len(LINKS)} + 1], '{{n}}', page_id::varchar) as link from pages"
#: The links above and all that pages hold, resolved: v1 to v5. (Four pairs of dots at most.)
_LINKED = f"{O.all_candidates()}, l as ({_MADE} union select 0, page_id, url, candidate from candidates), " + re.sub(r"\bu([1-5])\b", r"v\1", O.resolved("l", "page_id, url, link", "link"))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.element_at(F.array(*map(F.lit, LINKS)), (F.col("page_id") % len(LINKS) + 1).cast("int"))
    made = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", F.replace(one, F.lit("{n}"), F.col("page_id").cast("string")).alias("link"))
    return made.unionByName(extract.extract_candidates(responses(spark, sf_dir)).select("page_id", "url", F.col("candidate").alias("link"))).distinct()


@query(f"with {_LINKED} select page_id, link, resolved, host from l left join (select page_id, link, resolved, host from v5) using (page_id, link)".replace("lower(regexp_extract(r, '^[^:]*://([^/?#:]*)', 1)) as host", "regexp_extract(r, '^[^:]*://([^/?#:]*)', 1) as host"))
def resolve_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.resolve(_links(spark, sf_dir), "url", "link").select("page_id", "link", "resolved", "host")


@query(f"with {_LINKED} select page_id, resolved from v5 where coalesce(ref, '') = ''")
def drop_fragment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.resolve(_links(spark, sf_dir), "url", "link").where("resolved is not null and coalesce(ref, '') = ''").select("page_id", "resolved")


_TARGETS = f"with {O.all_candidates()}, {O.targets()}"


def _targets(spark: SparkSession, sf_dir: str, subdomains: bool = True) -> DataFrame:
    return targets.targets(extract.extract_candidates(responses(spark, sf_dir)), subdomains)


@query(f"{_TARGETS} select page_id, candidate, host, is_new_subdomain from targets")
def new_subdomain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _targets(spark, sf_dir).select("page_id", "candidate", "host", "is_new_subdomain")


@query(f"{_TARGETS} select page_id, candidate, resolved from targets where not is_new_subdomain")
def same_host_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _targets(spark, sf_dir, False).select("page_id", "candidate", "resolved")


@query(f"{_TARGETS} select page_id, candidate, resolved from targets where is_new_subdomain")
def root_slash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _targets(spark, sf_dir).where("is_new_subdomain").select("page_id", "candidate", "resolved")


@query(f"{_TARGETS} select session_id, resolved, min(page_id) as page_id from targets group by all")
def global_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.first_pages(_targets(spark, sf_dir)).select("session_id", "resolved", "page_id")


@query(f"{_TARGETS} select distinct session_id, resolved from targets where length(resolved) % 2 = 1")
def anti_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all targets' addresses are known."""
    found = materialize(_targets(spark, sf_dir).select("session_id", "resolved", "uri"), "anti-known")  # searched for once
    known = found.where(F.length("resolved") % 2 == 0).select("session_id", "uri")
    return dedupe.unknown(found, known).select("session_id", "resolved").distinct()


@query(f"{_TARGETS} select distinct session_id, resolved from targets where length(resolved) % 3 > 0")
def anti_known_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all targets' addresses are known, in a table of buckets."""
    found = materialize(_targets(spark, sf_dir).select("session_id", "resolved", "uri"), "anti-known")
    name = f"tree_{uuid.uuid4().hex}"
    tree = dedupe.save_tree(found.where(F.length("resolved") % 3 == 0), name, int(spark.conf.get("spark.sql.shuffle.partitions")), f"{shared_dir(spark)}/linkloom/{name}")
    return dedupe.unknown(found.distinct(), tree).select("session_id", "resolved")


_FOLDER = "regexp_extract(resolved, '^[^:]*://[^/?#]*(/[^/?#]*/|/?)', 1)"


@query(f"""{_TARGETS} select session_id, host, folder, case when grouping(session_id) = 1 then 3 when grouping(host) = 1 then 2 when grouping(folder) = 1 then 1 else 0 end as level,
  count(*) as n_links, count(distinct page_id) as n_pages, true as sketch_fits from (select session_id, page_id, host, {_FOLDER} as folder from targets) group by rollup (session_id, host, folder)""")
def link_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and linking pages by folder, host and session; the pages exactly, and whether those of the merged sketches are within 5 % of them."""
    found = materialize(_targets(spark, sf_dir).select("session_id", "page_id", "host", "resolved"), "rollup")
    rolled = report.rolled_up(report.sketched(found))
    exact = found.withColumn("folder", report.folder(F.col("resolved"))).rollup(*report.LEVELS).agg(F.grouping_id(*report.LEVELS).alias("g"), F.countDistinct("page_id").alias("exact"))
    exact = exact.select(*(F.col(c).alias(f"_{c}") for c in report.LEVELS), F.expr("case g when 7 then 3 when 3 then 2 when 1 then 1 else 0 end").alias("_level"), "exact")
    same = F.col("level") == F.col("_level")
    for c in report.LEVELS:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    fits = F.abs(F.col("n_pages") - F.col("exact")) <= F.greatest(F.lit(1), F.col("exact") * 0.05)
    return rolled.join(exact, same).select(*report.LEVELS, "level", "n_links", F.col("exact").alias("n_pages"), fits.alias("sketch_fits"))


#: A cap that bites in small tables too.
FEW = 5
#: All that decides who brings in what; the rest of a link isn't worked out for these queries.
_ASKED = ("session_id", "page_id", "resolved", "place")


@query(f"with recursive {O.all_candidates()}, {O.targets()}, {O.capped(FEW)}")
def insert_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which page brings in which address: all links of all pages, with a cap that most pages reach."""
    return dedupe.capped(_targets(spark, sf_dir).select(*_ASKED), FEW).select("session_id", "page_id", "resolved")


@query(f"with recursive {O.all_candidates()}, {O.targets()}, {O.capped(Options().most_inserts)}")
def insert_cap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the design's cap."""
    return dedupe.capped(_targets(spark, sf_dir).select(*_ASKED), Options().most_inserts).select("session_id", "page_id", "resolved")


@query(f"""with {O.all_candidates(gate=O.GATE)}, {O.targets()},
first as (select session_id, resolved, min(page_id) as page_id from targets group by all)
select session_id, page_id, 'GET' as method, {O.encoded('resolved')} as uri, resolved, host, is_new_subdomain, case when is_new_subdomain then '[NEW SUBDOMAIN] ' else '' end || 'Discovered via passive link extraction - NOT requested' as note, 'USER' as entry_type, url as source_url
from (select distinct session_id, page_id, url, resolved, host, is_new_subdomain from targets) join first using (session_id, page_id, resolved)""")
def placeholder_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discover(responses(spark, sf_dir)).select("session_id", "page_id", "method", "uri", "resolved", "host", "is_new_subdomain", "note", "entry_type", "source_url")


@query(f"with {O.all_candidates()} select page_id, strlen(body) as n_bytes, coalesce(n, 0) as n_candidates from responses left join (select page_id, count(*) as n from candidates group by page_id) using (page_id)")
def page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nodes.page_metrics(responses(spark, sf_dir)).select("page_id", "n_bytes", "n_candidates")


@query(f"with {O.all_candidates()}, {O.targets()} select distinct resolved, {O.encoded('resolved')} as uri from targets")
def encode_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _targets(spark, sf_dir).select("resolved", "uri").distinct()


@query(f"""with {RESPONSES_SQL}, m as (select page_id, case when page_id % 5 <> 1 then url end as url,
  case page_id % 5 when 2 then null when 3 then '' else body end as body, case when page_id % 5 <> 4 then content_type end as content_type from responses)
select page_id from m where {O.GATE}""")
def gate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses without an address, a body or a type are passed over."""
    kind = F.col("page_id") % 5
    partial = responses(spark, sf_dir).withColumns({"url": F.when(kind != 1, F.col("url")), "body": F.when(kind == 3, "").when(kind != 2, F.col("body")), "content_type": F.when(kind != 4, F.col("content_type"))})
    return pages.gated(partial).select("page_id")


def _archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses, as they come back from archives."""
    folder = f"{shared_dir(spark)}/linkloom/archived-{uuid.uuid4().hex}"
    warc.write_archives(warc.as_archived(archived(spark, sf_dir)), folder)
    return pages.decode_bytes(warc.archived_responses(warc.read_archives(spark, folder)), "body", "charset")


@query(f"""with {RESPONSES_SQL} select session_id, page_id, url, 200 as status, case when content_type is not null then {ARCHIVED_SQL} end as charset,
  split_part(content_type, ';', 1) || '; charset=' || {ARCHIVED_SQL} as content_type, {O.trimmed("source_map")} as source_map, {O.trimmed("x_source_map")} as x_source_map, length(body) as n_chars, sha256(body) as body_sha256 from responses""")
def archived_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses in mixed charsets, written to archives and read back in byte ranges."""
    found = _archive(spark, sf_dir).withColumns({"n_chars": F.length("body").cast("long"), "body_sha256": F.sha2("body", 256)})
    return found.select("session_id", "page_id", "url", "status", "charset", "content_type", "source_map", "x_source_map", "n_chars", "body_sha256")


@query(f"with {O.all_candidates(gate=O.GATE)}, {O.targets()} select session_id, page_id, candidate, resolved from targets")
def archive_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What archived responses link to, from bytes to addresses."""
    return found_targets(_archive(spark, sf_dir).select(*pages.RESPONSES.names), Options()).select("session_id", "page_id", "candidate", "resolved")


#: The stream's pages come in so many batches; a session forgets each time that so many pages (and 10 more for each session's number) have come.
STREAM_BATCHES, FORGETS_EACH = 2, 40
_FORGOT = f"page_id // ({FORGETS_EACH} + 10 * (page_id % 3))"


@query(f"with recursive {O.all_candidates(gate=O.GATE)}, {O.targets()}, {O.capped(FEW)}".replace("page_id % 3 as session_id", f"page_id % 3 + 3 * ({_FORGOT}) as session_id").replace("select session_id, page_id, unnest(fresh)", "select session_id % 3 as session_id, page_id, unnest(fresh)"))
def stream_with_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a stream of batches, with sessions that forget at fixed places: what each page brings in, five addresses at most."""
    folder = f"{shared_dir(spark)}/linkloom/stream-{uuid.uuid4().hex}"
    sink, most = f"{folder}/sink", spark.read.parquet(f"{sf_dir}/pages.parquet").agg(F.max("page_id")).first()[0]
    length = F.lit(FORGETS_EACH) + 10 * F.col("session_id")
    own = spark.range(3).select(F.col("id").alias("session_id"))
    times = own.select("session_id", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.lit(most) / length) + 1)).alias("k")).select("session_id", (F.col("k") * (F.lit(FORGETS_EACH) + 10 * F.col("session_id"))).alias("at"))
    control = times.select("session_id", "at", F.lit(stream.FORGETTING[0]).alias("event"), F.lit(None).cast("string").alias("resolved"), F.current_timestamp().alias("written_at"))
    step = most // STREAM_BATCHES + 1
    for k in range(STREAM_BATCHES):
        inside = lambda c, k=k: (F.col(c) >= k * step) & (F.col(c) < (k + 1) * step)
        responses(spark, sf_dir).where(inside("page_id")).write.mode("append").parquet(f"{folder}/pages")
        control.where(inside("at")).write.mode("append").parquet(f"{sink}/control")
        stream.start(spark.readStream.schema(pages.RESPONSES).parquet(f"{folder}/pages"), sink, Options(most_inserts=FEW))
    return stream.written(spark, sink).select("session_id", "page_id", "resolved")


@query(f"""with {RESPONSES_SQL}, m as (select page_id, case page_id % 9 when 1 then null when 5 then 'nothing/' || page_id when 6 then 'http://h:9x/' || page_id when 8 then 'http://[::1/' else url end as url,
  case page_id % 9 when 2 then null when 3 then '' else body end as body, case when page_id % 9 <> 4 then content_type end as content_type, page_id % 9 = 7 as odd from responses),
j as (select page_id, case when coalesce(length(body), 0) = 0 then 'gate:no body' when content_type is null then 'gate:no content type' when not regexp_matches(lower(content_type), 'html|javascript|json|xml|css') then 'gate:content type not searched'
  when url is null then 'gate:no address' when page_id % 9 in (5, 6, 8) then 'address:not an address' when odd then 'charset:unknown charset no-such-charset' end as held from m)
select page_id, split_part(held, ':', 1) as stage, split_part(held, ':', 2) as reason from j where held is not null""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which responses can't be looked through, and why; of a table in which a good part of the rows are odd."""
    kind = F.col("page_id") % 9
    odd = responses(spark, sf_dir).withColumns({
        "url": F.when(kind == 5, F.concat(F.lit("nothing/"), "page_id")).when(kind == 6, F.concat(F.lit("http://h:9x/"), "page_id")).when(kind == 8, "http://[::1/").when(kind != 1, F.col("url")),
        "body": F.when(kind == 3, "").when(kind != 2, F.col("body")), "content_type": F.when(kind != 4, F.col("content_type")), "charset": F.when(kind == 7, "no-such-charset"),
    })
    read = pages.decode_bytes(odd.withColumn("body", F.col("body").cast("binary")), "body", "charset", "decode_error")
    return held(read).select("page_id", "stage", "reason")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph_flagship(spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
