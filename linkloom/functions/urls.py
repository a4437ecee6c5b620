r"""Resolving a link against its page's address, as expressions.

The rules are those of java.net.URL, not of RFC 3986: a query alone takes the page's folder; dot segments go only
from relative paths, and surplus ones stay; a scheme without handler, or a port that is no number, has no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.functions import constants as C
from linkloom.functions.rules import replaced, trimmed

#: What may stand as it is before the query, and from there on. An address counts as not encoded yet, so a percent sign is encoded too.
SAFE, SAFE_QUERY = r"A-Za-z0-9_.!~*'()\-;/:@&=$,", r"A-Za-z0-9_.!~*'()\-;/?:@&=$,+#"


def _after(s: Column, mark: str) -> Column:
    """What follows the first mark; null if there is none."""
    at = F.instr(s, mark)
    return F.when(at > 0, s.substr(at + 1, F.length(s)))


def _without_dots(path: Column) -> Column:
    """A relative path's dot segments, taken out one pair at a time from the left."""
    first_pair = r"(?s)^((?=/\.\./).+?|(?!/\.\./).*?)/[^/]*/\.\.(?=/)(.*)$"
    p = replaced(path, r"/\.(?=/)")
    steps = F.sequence(F.lit(1), F.greatest(F.size(F.regexp_extract_all(p, F.lit(r"/\.\.(?=/)"), F.lit(0))), F.lit(1)))
    p = F.aggregate(steps, p, lambda a, _: replaced(a, first_pair, "$1$2"))
    p = replaced(p, r"(?s)^((?:(?!/\.\.).)*(?!/\.\.)/)(?:(?!/\.\.)[^/])*/\.\.(?:.*/\.\.)?\z", "$1")
    return replaced(replaced(p, r"(?s)^\./(?=.)"), r"/\.\z", "/")


def is_address(url: Column) -> Column:
    """Whether links can resolve against it: a known scheme, and after // a host and a port that can be one."""
    authority = r"//(?:[^/?#]*@)?(?:\[[^\]/?#]*\]|[^/?#:\[]*)(?::\d{0,9})?(?:[/?#].*)?"
    return F.coalesce(trimmed(url).rlike(rf"(?is)^(?:{'|'.join(C.SCHEMES)}):(?:{authority}|(?!//).*)\z"), F.lit(False))


def resolve(df: DataFrame, base: str, spec: str) -> DataFrame:
    """df with scheme, authority, host, path, query, ref and resolved; all null where a link has no address."""
    b, s = F.col(base), "_spec"
    steps = df.withColumns({
        "_spec": trimmed(F.col(spec)),
        "_base_scheme": F.lower(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9.+-]*):", 1)),
        "_base_authority": F.regexp_extract(b, r"^[^/?#]*://([^/?#]*)", 1),
        "_base_path": F.regexp_extract(b, r"^[^/?#]*://[^/?#]*([^?#]*)", 1),
        "_base_query": _after(F.substring_index(b, "#", 1), "?"),
    }).withColumn("_scheme", F.lower(F.regexp_extract(s, r"^([A-Za-z][A-Za-z0-9.+-]*):", 1)))
    own = F.col("_scheme")
    inherits = (own == "") | (own == F.col("_base_scheme")) & F.startswith(F.col("_base_path"), F.lit("/"))
    rest = F.when(own == "", F.col(s)).otherwise(_after(F.col(s), ":"))
    steps = steps.withColumns({"_inherits": inherits, "_rest": rest}).withColumns({"_main": F.substring_index("_rest", "#", 1), "ref": _after(F.col("_rest"), "#")})
    steps = steps.withColumns({"_p": F.substring_index("_main", "?", 1), "_q": _after(F.col("_main"), "?")})
    p = F.col("_p")
    named = p.rlike(r"^//(?!//)")
    steps = steps.withColumns({
        "scheme": F.when(own == "", F.col("_base_scheme")).otherwise(own),
        "_named": named,
        "authority": F.when(named, F.regexp_extract(p, r"^//([^/]*)", 1)).when(F.col("_inherits"), F.col("_base_authority")).otherwise(""),
        "_tail": F.when(named, F.regexp_extract(p, r"(?s)^//[^/]*(.*)", 1)).otherwise(p),
        "_from": F.when(F.col("_inherits") & ~(named & (F.regexp_extract(p, r"^//([^/]*)", 1) != "")), F.col("_base_path")).otherwise(""),
    })
    tail, start = F.col("_tail"), F.col("_from")
    folder = replaced(start, r"(?s)[^/]*\z")
    joined = F.when(F.startswith(tail, F.lit("/")), tail)
    joined = joined.when((tail != "") & (start != ""), _without_dots(F.concat(folder, tail)))
    joined = joined.when(tail != "", F.concat(F.when(F.col("_inherits") | F.col("_named"), F.lit("/")).otherwise(""), tail))
    joined = joined.when((F.col("_main") != "") & (p == ""), F.concat(replaced(folder, r"/\z"), F.lit("/"))).otherwise(start)
    bare = (F.col("_main") == "") & F.col("_inherits")
    steps = steps.withColumns({
        "path": joined,
        "query": F.when(bare, F.col("_base_query")).otherwise(F.col("_q")),
        "ref": F.when(bare, F.coalesce("ref", _after(b, "#"))).otherwise(F.col("ref")),
        "_server": F.when(F.col("authority").rlike("@.*@"), "").otherwise(replaced(F.col("authority"), r"^[^@]*@")),
    })
    port = F.regexp_extract("_server", r"(?s):(.*)\z", 1)
    fine = F.col("scheme").isin(*C.SCHEMES) & (port.rlike(r"^\d{0,9}\z") | F.startswith(F.col("_server"), F.lit("[")))
    optional = lambda mark, c: F.coalesce(F.concat(F.lit(mark), F.col(c)), F.lit(""))
    whole = F.concat("scheme", F.lit(":"), F.when(F.col("authority") != "", F.concat(F.lit("//"), "authority")).otherwise(""), "path", optional("?", "query"), optional("#", "ref"))
    steps = steps.withColumns({"host": F.when(F.startswith(F.col("_server"), F.lit("[")), F.col("_server")).otherwise(F.substring_index("_server", ":", 1)), "resolved": whole, "_fine": F.coalesce(fine, F.lit(False))})
    parts = ("scheme", "authority", "host", "path", "query", "ref", "resolved")
    return steps.withColumns({c: F.when(F.col("_fine"), F.col(c)) for c in parts}).select(*df.columns, *parts)


def _escaped(s: Column, safe: str) -> Column:
    runs = F.regexp_extract_all(s, F.lit(rf"[{safe}]+|[^{safe}]+"), F.lit(0))
    one = lambda x: F.when(x.rlike(rf"^[{safe}]"), x).otherwise(F.replace(F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")))
    return F.when(s.rlike(rf"^[{safe}]*\z"), s).otherwise(F.array_join(F.transform(runs, one), ""))


def encoded(url: Column) -> Column:
    """Percent-encoded as UTF-8, as an address that isn't yet: `%` becomes `%25`, and before the query `+` becomes `%2B`."""
    return F.concat(_escaped(F.substring_index(url, "?", 1), SAFE), F.coalesce(F.concat(F.lit("?"), _escaped(_after(url, "?"), SAFE_QUERY)), F.lit("")))


def root_slash(resolved: Column, path: Column, other_host: Column) -> Column:
    """An address on another host without a path gets one, before its query."""
    return F.when(other_host & (path == ""), replaced(resolved, r"^([^?#]*)", "$1/")).otherwise(resolved)
