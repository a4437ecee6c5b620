"""SQL for DuckDB that says again what the operators should find, without look-around and without their expressions.

Patterns are written out here once more. Shared are the fixed lists (`constants`) and the snippets that responses are made of (`samples`).
"""

from __future__ import annotations

from linkloom.functions import constants as C
from linkloom.functions.patterns import DOMAIN, PATTERNS, TEMPLATE, Pattern, active
from linkloom.samples import RESPONSES_SQL

BRACKET_ROUNDS = 8


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(values) -> str:
    return "(" + ", ".join(map(q, values)) + ")"


def escaped(words_) -> str:
    return "|".join(w.replace(".", r"\.").replace("$", r"\$").replace("\\=", "=") for w in words_)


def trimmed(s: str) -> str:
    return rf"regexp_replace({s}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def decoded(s: str) -> str:
    found = f"coalesce({s}, '')"
    for regex, character in C.ENCODED:
        found = f"regexp_replace({found}, {q(regex)}, {q(character)}, 'gi')"
    return found


DECODED = f"decoded as (select session_id, page_id, url, {decoded('body')} as body from responses)"
CHUNKS = f"""chunks as (
  select session_id, page_id, url, 0 as chunk_no, body as chunk from decoded where length(body) <= {C.CHUNK_ABOVE}
  union all
  select session_id, page_id, url, (s // {C.CHUNK_STEP})::integer, substr(body, s + 1, {C.CHUNK})
  from (select *, unnest(range(0, length(body), {C.CHUNK_STEP})) as s from decoded where length(body) > {C.CHUNK_ABOVE}))"""


_LABEL = r"[a-zA-Z0-9\x{80}-\x{FFFF}](?:[a-zA-Z0-9\x{80}-\x{FFFF}_-]*[a-zA-Z0-9\x{80}-\x{FFFF}])?"
_QUOTED = r"""["']([^"']+)["']"""
_BARE = r"""(?:^|["' ])(%s)(?:$|["'\n\r ])"""
#: Each pattern as a regex and its group. Where it begins or ends at a separator, texts are searched with each of these twice.
REGEXES = {
    "attr": (r"""(?i)(?:^|[^\w:.])[\w:]*?(?:href|src|action|poster|cite|formaction|background|longdesc|usemap|manifest|codebase|profile)\s*=\s*["']{2}([^"'#\s>]+)["']""", 1),
    "meta_refresh": (r"""(?is)<meta[^>]*?url\s*=\s*([^"'#\s>]+)""", 1),
    "css_url": (r"""(?i)url\(\s*["']?([^"')\s]+)["']?\s*\)""", 1),
    "absolute": (r"""(?i)\bhttps?://[^\s"'<>)]+""", 0),
    "protocol_relative": (rf"""(?:["'(]|^|\s)(//{_LABEL}(?:\.{_LABEL}){{0,24}}\.[a-zA-Z]{{2,}}[^\s"'<>)]*)""", 1),
    "source_mapping": (r"""(?i)sourceMappingURL\s*=\s*([^\s"'<>]+)""", 1),
    "bare_domain": (rf"""(?:^|[^\w.:/])((?:{_LABEL}\.){{0,24}}{_LABEL}\.[a-zA-Z]{{2,24}}(?:/[^\s"'<>()\[\]{{}}]{{0,500}})?)""", 1),
    "fetch": (r"(?i)fetch\(\s*" + _QUOTED, 1),
    "xhr_open": (r"""(?i)\.open\(\s*["'][a-z]+["']\s*,\s*""" + _QUOTED, 1),
    "import_from": (r"(?i)(?:import|from)\s+" + _QUOTED, 1),
    "dynamic_import": (r"(?i)\bimport\s*\(\s*" + _QUOTED, 1),
    "require": (r"(?i)\brequire(?:\.resolve)?\(\s*" + _QUOTED, 1),
    "location": (r"(?i)(?:window\.)?location(?:\.href)?\s*=\s*" + _QUOTED, 1),
    "window_open": (r"(?i)window\.open\(\s*" + _QUOTED, 1),
    "jquery_ajax": (r"(?i)\$\.ajax\(\s*\{[^}]*?url\s*:\s*" + _QUOTED, 1),
    "jquery_call": (r"(?i)\$\.(?:get|post|getjson)\(\s*" + _QUOTED, 1),
    "axios": (r"(?i)axios(?:\.(?:get|post|put|patch|delete|head|request))?\(\s*" + _QUOTED, 1),
    "web_socket": (r"(?i)new\s+websocket\(\s*" + _QUOTED, 1),
    "event_source": (r"(?i)new\s+eventsource\(\s*" + _QUOTED, 1),
    "beacon": (r"(?i)navigator\.sendbeacon\(\s*" + _QUOTED, 1),
    "template_literal": (r"`([^`]*\$\{[^`]*\}[^`]*)`", 1),
    "path_literal": (_BARE % r"""(?:#?/|\.\.?/)[^"'><,;| *()%$^/\\\[\]][^"'><,;|()\s]{1,255}""", 1),
    "path_ext": (_BARE % r"""[a-zA-Z0-9_\-/]+/[a-zA-Z0-9_\-/.]{1,255}\.(?:[a-zA-Z]{1,4}|php3|php5|action|xhtml|config|bzip2|tar\.gz|js\.map)(?:[?/][^"']{0,1000}|)""", 1),
    "file_ext": (_BARE % r"""[a-zA-Z0-9_\-.]{1,255}\.(?:php|php3|php5|asp|aspx|ashx|cfm|cgi|pl|jsp|jspx|json|js|action|html|xhtml|htm|bak|do|txt|wsdl|wadl|xml|xls|xlsx|bin|conf|config|bz2|bzip2|gzip|tar\.gz|tgz|log|src|zip|js\.map)(?:\?[^"']{0,255}|)""", 1),
}
#: Patterns whose separators are used up by a find on either side.
TWICE = ("attr", "path_literal", "path_ext", "file_ext")


def finds(pattern: Pattern, chunk: str = "chunk") -> str:
    """A list of all finds."""
    regex, group = REGEXES[pattern.name]
    if pattern.name in TWICE:
        twice = f"""replace(replace(replace({chunk}, '"', '""'), '''', ''''''), ' ', '  ')"""
        return f"list_transform(regexp_extract_all({twice}, {q(regex)}, {group}), lambda x: replace(x, '  ', ' '))"
    found = f"regexp_extract_all({chunk}, {q(regex)}, {group})"
    if pattern.name == TEMPLATE:
        found = rf"list_transform({found}, lambda x: regexp_replace(x, '\$\{{[^}}]*\}}', '__DYNAMIC__', 'g'))"
    return found


def raw(patterns: tuple[Pattern, ...]) -> str:
    """CTE raw: every find with its place; ord counts a pattern's finds in a chunk."""
    parts = " union all ".join(f"select session_id, page_id, url, 0 as pass, chunk_no, {PATTERNS.index(p)} as pattern_no, unnest(l) as raw, unnest(range(len(l))) as ord from (select *, {finds(p)} as l from chunks)" for p in patterns)
    return f"raw as ({parts})"


HOSTNAME = r"'^[A-Za-z0-9]([A-Za-z0-9_-]{0,61}[A-Za-z0-9])?(\.[A-Za-z0-9]([A-Za-z0-9_-]{0,61}[A-Za-z0-9])?)*\.?$'"


def valid_hostname(s: str) -> str:
    return f"coalesce(regexp_matches({s}, {HOSTNAME}) and length(regexp_replace({s}, '\\.$', '')) <= {C.LONGEST_HOST}, false)"


def valid_domain(s: str) -> str:
    labels = f"string_split(rtrim(split_part({s}, '/', 1), '.'), '.')"
    last, second = f"lower({labels}[-1])", f"lower({labels}[-2])"
    return f"({valid_hostname(f"split_part({s}, '/', 1)")} and {last} in {words(sorted(set(C.TLDS) - set(C.EXCLUDED_SUFFIXES)))} and length({second}) > 2 and {second} not in {words(C.EXCLUDED_DOMAINS)})"


def tidied(s: str) -> str:
    ends = r"""["''\n\r( ]+"""
    s = f"regexp_replace({trimmed(s)}, '^{ends}|{ends}$', '', 'g')"
    s = rf"replace(replace(replace({s}, '\n', ''), '\r', ''), '\.', '.')"
    mark = r"""(?:\\[nr]|["''\n\r])"""
    s = rf"regexp_replace({s}, '(?s)^{mark}(.*){mark}$', '\1')"
    return rf"split_part(regexp_replace(regexp_replace({s}, '\\+$', ''), '[>;,]+$', ''), '`', 1)"


def masked(s: str) -> str:
    none = r"[^()\[\]{}]*"
    for _ in range(BRACKET_ROUNDS):
        s = rf"regexp_replace({s}, '\(({none})\)|\[({none})\]|\{{({none})\}}', '<\1\2\3>', 'g')"
    return s


def normal(source: str, keep: str, column: str = "raw") -> str:
    """CTEs t1 to t4: `keep` and candidate."""
    return rf"""t1 as (select {keep}, {tidied(column)} as t from {source}),
t2 as (select {keep}, substr(t, 1, length(regexp_extract({masked("t")}, '^[^()\[\]{{}}]*'))) as t from t1),
t3 as (select {keep}, split_part(t, '</', 1) as t from t2),
t4 as (select {keep}, nullif(case when regexp_matches(t, '^\.[^./]') then substr(t, 2) else t end, '') as candidate from t3)"""


JUNK_EXTENSION = rf"'(?i)\.({'|'.join(C.JUNK_EXTENSIONS)})([?#]|$)'"
BAD_SCHEME = f"'(?i)^({'|'.join(C.DROPPED_SCHEMES)})'"


def junk_token(s: str) -> str:
    return f"regexp_matches(split_part(lower({s}), '?', 1), {q(escaped(C.JUNK_TOKENS))})"


def odd_shape(s: str) -> str:
    return rf"""(length({s}) = 0 or length({s}) > {C.LONGEST_LINK} or regexp_matches({s}, '^#([^/]|$)') or {s}[1:1] in ('$', '\', '-') or {s}[1:2] = '/=' or {s}[1:3] = '...'
  or regexp_matches({s}, '[\x00-\x20\x7f-\x9f]|\\[sS]') or not regexp_matches({s}, '[0-9a-zA-Z]') or regexp_matches({s}, '(?i)^({'|'.join(C.MIME_TYPES)})/'))"""


def usable(s: str) -> str:
    return f"not (regexp_matches({s}, {JUNK_EXTENSION}) or regexp_matches({s}, {BAD_SCHEME}) or {odd_shape(s)} or {junk_token(s)})"


def candidates(patterns: tuple[Pattern, ...], gate: str = "true") -> str:
    """CTEs up to `accepted`: session_id, page_id, url, pattern_no, candidate."""
    domain = PATTERNS.index(next(p for p in PATTERNS if p.name == DOMAIN))
    keep = "session_id, page_id, url, pattern_no, chunk_no, pass, ord"
    return f"""{RESPONSES_SQL},
gated as (select * from responses where {gate}),
{DECODED.replace("from responses", "from gated")},
{CHUNKS},
{raw(patterns)},
r2 as (select {keep}, case when pattern_no = {domain} then '//' || raw else raw end as raw from raw where pattern_no <> {domain} or {valid_domain("raw")}),
{normal("r2", keep)},
accepted as (select {keep}, {trimmed("candidate")} as candidate from t4 where candidate is not null and {usable(trimmed("candidate"))})"""


GATE = "length(body) > 0 and url is not null and coalesce(regexp_matches(lower(content_type), 'html|javascript|json|xml|css'), false)"


def base(url: str = "url") -> dict[str, str]:
    return {
        "root": f"regexp_extract({url}, '^[^:]*://[^/?#]*')",
        "scheme": f"lower(regexp_extract({url}, '^([^:]*):', 1))",
        "path": f"regexp_extract({url}, '^[^:]*://[^/?#]*([^?#]*)', 1)",
        "host": f"lower(regexp_extract({url}, '^[^:]*://(?:[^/?#@]*@)?([^/?#:]*)', 1))",
    }


def resolved(source: str, keep: str, spec: str) -> str:
    """CTEs u1 to u4: `keep`, resolved (null if none), ref. For addresses without user names, and dots in relative paths only."""
    b = base()
    undotted = "regexp_replace(p, '/\\.(/)', '\\1', 'g')"
    for _ in range(4):
        undotted = rf"regexp_replace({undotted}, '/([^/.][^/]*|\.[^/.][^/]*)/\.\./', '/')"
    return rf"""u1 as (select {keep}, {trimmed(spec)} as s, {b["root"]} as root, {b["scheme"]} as bs, {b["path"]} as bp, case when bp = '' then '' else regexp_replace(bp, '[^/]*$', '') end as folder from {source}),
u2 as (select *, lower(regexp_extract(s, '^([A-Za-z][A-Za-z0-9.+-]*):', 1)) as own, case when position('#' in s) > 0 then substr(s, position('#' in s) + 1) when s = '' and position('#' in url) > 0 then substr(url, position('#' in url) + 1) end as ref, split_part(s, '#', 1) as m from u1),
u3 as (select *, case when own not in ('', 'http', 'https', 'ftp', 'file') then null
  when own <> '' then own || substr(m, length(own) + 1)
  when m[1:2] = '//' then bs || ':' || m
  when m[1:1] = '/' then root || m
  when m = '' then root || regexp_extract(url, '^[^:]*://[^/?#]*([^#]*)', 1)
  when m[1:1] = '?' then root || case when bp = '' then '/' else folder end || m
  else null end as whole,
  case when own = '' and m <> '' and m[1:1] not in ('/', '?') then case when folder = '' then '/' else folder end || split_part(m, '?', 1) end as p,
  case when position('?' in m) > 0 then substr(m, position('?' in m)) else '' end as query from u2),
u4 as (select {keep}, ref, coalesce(whole, root || {undotted} || query) || coalesce('#' || ref, '') as r from u3 where own in ('', 'http', 'https', 'ftp', 'file')),
u5 as (select {keep}, ref, r as resolved, lower(regexp_extract(r, '^[^:]*://([^/?#:]*)', 1)) as host, regexp_extract(r, '^[^:]*://[^/?#]*([^?#]*)', 1) as path from u4
  where regexp_matches(r, '^[^:]*://[^/?#:]*(:[0-9]*)?([/?#]|$)'))"""


def headers(gate: str = "true") -> str:
    """CTEs h0 to h2 and u1 to u5; h2: session_id, page_id, url, candidate."""
    keep = "session_id, page_id, url, ord, raw"
    return f"""h0 as (select session_id, page_id, url, 0 as ord, {trimmed("source_map")} as raw from responses where {gate} union all select session_id, page_id, url, 1, {trimmed("x_source_map")} from responses where {gate}),
h1 as (select * from h0 where raw <> ''),
{resolved("h1", keep, "raw")},
h2 as (select h1.session_id, h1.page_id, h1.url, h1.ord, coalesce(u5.resolved, h1.raw) as candidate from h1 left join u5 on h1.page_id = u5.page_id and h1.ord = u5.ord)"""


def targets(own: str = "candidates") -> str:
    """CTEs v1 to v5 (resolved) and targets: from a table (session_id, page_id, url, candidate)."""
    keep = "session_id, page_id, url, candidate"
    renamed = resolved(own, keep, "candidate")
    for k in range(1, 6):
        renamed = renamed.replace(f"u{k}", f"v{k}")
    return f"""{renamed},
targets as (select {keep}, host, host <> {base()["host"]} as is_new_subdomain,
    case when host <> {base()["host"]} and path = '' then regexp_replace(resolved, '^([^?#]*)', '\\1/') else resolved end as resolved
  from v5 where coalesce(ref, '') = '' and {valid_hostname("host")} and not {junk_token("host || path")})"""


def all_candidates(javascript: bool = True, gate: str = "true") -> str:
    return f"""{candidates(active(javascript), gate)},
{headers(gate)},
placed as (select session_id, page_id, url, candidate, min(place) as place from (
  select session_id, page_id, url, candidate, [pass, chunk_no, pattern_no, ord] as place from accepted
  union all select session_id, page_id, url, candidate, [2, 0, 0, ord] from h2 where {usable("candidate")}) group by all),
candidates as (select session_id, page_id, url, candidate from placed)"""


def capped(most: int) -> str:
    """CTEs p and f, and a query of them: page by page, the first `most` links that no earlier page of the session brought in."""
    return f"""links as (select session_id, page_id, resolved, min(place) as place from targets join placed using (session_id, page_id, candidate) group by all),
p as materialized (select session_id, page_id, row_number() over (partition by session_id order by page_id) as k, list(resolved order by place, resolved) as own from links group by session_id, page_id),
f(session_id, k, seen, fresh) as (
  select distinct session_id, 0::bigint, []::varchar[], []::varchar[] from p
  union all
  select session_id, k, list_concat(seen, fresh), fresh from (
    select f.session_id, p.k, f.seen, list_filter(p.own, lambda x: not list_contains(f.seen, x))[1:{most}] as fresh from f join p on p.session_id = f.session_id and p.k = f.k + 1))
select session_id, page_id, unnest(fresh) as resolved from f join p using (session_id, k)"""


def encoded(s: str) -> str:
    """All but the safe characters as percent signs and hex digits; `+` and `?` stay in queries only."""

    def part(x: str, safe: str) -> str:
        found = f"url_encode({x})"
        for c in safe:
            found = f"replace({found}, '%{ord(c):02X}', {q(c)})"
        return found

    head, more = f"split_part({s}, '?', 1)", f"substr({s}, position('?' in {s}) + 1)"
    return f"""{part(head, "/:@&=$,;!*'()")} || case when position('?' in {s}) > 0 then '?' || {part(more, "/:@&=$,;!*'()+?#")} else '' end"""
