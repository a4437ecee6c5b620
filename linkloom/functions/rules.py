r"""What is a host name, a bare domain, a usable link: expressions over one string each.

Patterns end in \z where the whole text is meant, as $ would also match before a last line end.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions import constants as C

BRACKETS = r"[()\[\]{}]"
ENDS = r"""["'\n\r( ]"""


def any_of(words, escape: bool = True) -> str:
    return "|".join(re.escape(w) if escape else w for w in words)


def replaced(s: Column, regex: str, by: str = "") -> Column:
    return F.regexp_replace(s, F.lit(regex), F.lit(by))


def valid_hostname(host: Column) -> Column:
    """Labels of 1 to 63 letters, digits, inner hyphens and underscores; one last dot and single labels are fine."""
    label = r"[A-Za-z0-9](?:[A-Za-z0-9_-]{0,61}[A-Za-z0-9])?"
    return F.coalesce(host.rlike(rf"^{label}(?:\.{label})*\.?\z") & (F.length(replaced(host, r"\.\z")) <= C.LONGEST_HOST), F.lit(False))


def valid_domain(find: Column) -> Column:
    """Whether a bare host.tld[/path] is a plausible host: known suffix, a label before it of over two letters, none excluded."""
    host = F.substring_index(find, "/", 1)
    suffix = F.lower(F.regexp_extract(host, r"\.([^.]*)\.*\z", 1))
    label = F.lower(F.regexp_extract(host, r"([^.]*)\.[^.]*\.*\z", 1))
    plausible = suffix.isin(C.TLDS) & ~suffix.isin(C.EXCLUDED_SUFFIXES) & (F.length(label) > 2) & ~label.isin(C.EXCLUDED_DOMAINS)
    return valid_hostname(host) & plausible


def trimmed(s: Column) -> Column:
    return replaced(s, r"^[\x00-\x20]+|[\x00-\x20]+\z")


def bracket_cut(s: Column) -> Column:
    """Up to the first bracket without a partner.

    The brackets alone are gone through, once, with a stack of the closing ones that are due. Where one is closed that isn't due, or
    at the end, the lowest bracket that is still open has no partner; if none is open, the closing one has none.
    """
    start = F.struct(F.lit(b"").alias("due"), F.lit(0).alias("lowest"), F.lit(0).alias("at"), F.lit(False).alias("over"))

    def step(a: Column, b: Column) -> Column:
        due, at = a["due"], a["at"]
        state = lambda due, lowest, at, over: F.struct(due.alias("due"), lowest.alias("lowest"), at.alias("at"), F.lit(over).alias("over"))
        opens = F.lit("([{").contains(b)
        opened = state(F.concat(F.translate(b, "([{", ")]}").cast("binary"), due), F.when(F.octet_length(due) == 0, at).otherwise(a["lowest"]), at + 1, False)
        closed = state(F.substring(due, F.lit(2), F.octet_length(due)), a["lowest"], at + 1, False)
        return F.when(a["over"], a).when(opens, opened).when(F.substring(due, 1, 1) == b.cast("binary"), closed).otherwise(state(due, a["lowest"], at, True))

    def cut(paired: Column) -> Column:
        gaps = F.slice(F.split(s, BRACKETS, -1), 1, paired + 1)
        return F.substring(s, F.lit(1), F.aggregate(gaps, paired, lambda n, g: n + F.length(g)))

    paired = F.aggregate(F.regexp_extract_all(s, F.lit(BRACKETS), F.lit(0)), start, step, lambda a: F.when(F.octet_length(a["due"]) > 0, a["lowest"]).otherwise(a["at"]))
    return F.when(s.rlike(BRACKETS), F.element_at(F.transform(F.array(paired), cut), 1)).otherwise(s)


def plain(raw: Column) -> Column:
    """Whether nothing in raw is for tidied(), bracket_cut(), finished() or trimmed() to change: what most finds are."""
    return raw.rlike(r"^[A-Za-z0-9/#?_][A-Za-z0-9/#?_.:=&%+~-]*\z")


def tidied(raw: Column) -> Column:
    """The first half of normalising: ends, escapes, quotes on both ends, trailing marks, back-ticks."""
    s = replaced(trimmed(raw), rf"^{ENDS}+|{ENDS}+\z")
    s = F.replace(F.replace(F.replace(s, F.lit("\\n"), F.lit("")), F.lit("\\r"), F.lit("")), F.lit("\\."), F.lit("."))
    mark = r"""(?:\\[nr]|["'\n\r])"""
    s = replaced(s, rf"(?s)^{mark}(.*){mark}\z", "$1")
    return F.substring_index(replaced(replaced(s, r"\\+\z"), r"[>;,]+\z"), "`", 1)


def finished(cut: Column) -> Column:
    """The second half, after bracket_cut(): closing tags and a leading dot. Null if nothing is left."""
    return F.nullif(replaced(F.substring_index(cut, "</", 1), r"(?s)^\.(?=[^./])"), F.lit(""))


def normalised(raw: Column) -> Column:
    bound = F.transform(F.array(tidied(raw)), lambda s: finished(bracket_cut(s)))
    return F.element_at(bound, 1)


def junk_extension(s: Column) -> Column:
    return s.rlike(rf"(?i)\.(?:{any_of(C.JUNK_EXTENSIONS, False)})(?:[?#]|$)")


def junk_token(s: Column) -> Column:
    return F.lower(F.substring_index(s, "?", 1)).rlike(any_of(C.JUNK_TOKENS))


def dropped_scheme(s: Column) -> Column:
    return s.rlike(rf"(?i)^(?:{any_of(C.DROPPED_SCHEMES)})")


def odd_shape(s: Column) -> Column:
    """Too long or empty; begins like code; holds control characters, white space, no letter or digit, regex leftovers; a MIME type."""
    starts = any_of(C.DROPPED_STARTS)
    size = F.length(s)
    return (size == 0) | (size > C.LONGEST_LINK) | s.rlike(rf"^(?:#(?!/)|{starts})") | s.rlike(r"[\x00-\x1f\x7f-\x9f]|\s|\\[sS]") | ~s.rlike("[0-9a-zA-Z]") | s.rlike(rf"(?i)^(?:{any_of(C.MIME_TYPES)})/")


def usable(s: Column) -> Column:
    """s has been trimmed."""
    return ~(junk_extension(s) | dropped_scheme(s) | odd_shape(s) | junk_token(s))
