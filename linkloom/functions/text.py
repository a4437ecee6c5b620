"""Decoding, chunks and candidates of a page body, as expressions."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions import constants as C
from linkloom.functions.patterns import DOMAIN, TEMPLATE, Pattern

#: What bodies decode to with F.decode; other charsets need decode_bytes().
CHARSETS = ("utf-8", "us-ascii", "iso-8859-1", "utf-16", "utf-16be", "utf-16le", "utf-32")


def decode_entities(body: Column) -> Column:
    """Encoded / : & = " and hard spaces, in that order; null becomes an empty text."""
    found = whole = F.coalesce(body, F.lit(""))
    for (regex, character), starts in zip(C.ENCODED, C.ENCODED_STARTS, strict=True):
        found = F.element_at(F.transform(F.array(found), lambda s: _decoded(s, regex, character, starts)), 1)  # noqa: B023
    return F.when(_has(whole, C.ENCODED_SIGNS), found).otherwise(whole)


def _has(s: Column, texts: tuple[str, ...]) -> Column:
    return reduce(or_, (F.contains(s, F.lit(t)) for t in texts))


def _decoded(s: Column, regex: str, character: str, starts: tuple[str, ...]) -> Column:
    """s with one character decoded: gone through by the regex only where it holds the beginning of an encoded form."""
    return F.when(_has(s, starts), F.regexp_replace(s, F.lit(rf"(?i)(?=[&%\\])(?:{regex})"), F.lit(character))).otherwise(s)


def chunks(body: Column) -> Column:
    """The whole body as the only chunk, or overlapping windows of a long one."""
    n = F.length(body)
    windows = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(C.CHUNK_STEP)), lambda s: F.substring(body, s + 1, F.lit(C.CHUNK)))
    return F.when(n <= C.CHUNK_ABOVE, F.array(body)).otherwise(windows)


def finds(chunk: Column, pattern: Pattern) -> Column:
    """All finds of a pattern, in order, as they are normalised later on."""
    raw = F.regexp_extract_all(chunk, F.lit(pattern.regex), F.lit(pattern.group))
    if pattern.name == TEMPLATE:
        raw = F.transform(raw, lambda x: F.regexp_replace(x, F.lit(r"\$\{[^}]*\}"), F.lit("__DYNAMIC__")))
    return raw


def may_match(lowered: Column, pattern: Pattern) -> Column | None:
    """Whether a chunk (in lower case) has what a pattern needs: a search for plain texts, which is much cheaper than the regex. None if it needs nothing."""
    groups = [_has(lowered, texts) for texts in pattern.needs]
    return reduce(and_, groups) if groups else None


def candidates(parts: Column, patterns: tuple[Pattern, ...]) -> Column:
    """array<struct<chunk_no, pattern_no, ord, raw>> of all chunks: by chunk, pattern and place."""

    none = F.array().cast("array<struct<chunk_no:int,pattern_no:int,ord:int,raw:string>>")

    def of(no: int, pattern: Pattern, chunk: Column, k: Column, lowered: Column) -> Column:
        found = F.transform(finds(chunk, pattern), lambda x, i: F.struct(k.alias("chunk_no"), F.lit(no).alias("pattern_no"), i.alias("ord"), x.alias("raw")))
        may = may_match(lowered, pattern)
        return found if may is None else F.when(may, found).otherwise(none)

    def all_of(chunk: Column, k: Column) -> Column:
        bound = F.transform(F.array(F.lower(chunk)), lambda low: F.concat(*(of(no, p, chunk, k, low) for no, p in enumerate(patterns))))
        return F.element_at(bound, 1)

    return F.flatten(F.transform(parts, all_of))


def first_finds(found: Column, patterns: tuple[Pattern, ...]) -> Column:
    """Of candidates(), each text once, at its first place; bare domains for themselves, as they stand for other links."""
    domain = [p.name for p in patterns].index(DOMAIN)
    keyed = F.sort_array(F.transform(found, lambda c: F.struct(c["raw"], (c["pattern_no"] == domain).alias("domain"), c["chunk_no"], c["pattern_no"], c["ord"])))
    again = lambda a, x, i: (i > 0) & F.get(a, i - 1)["raw"].eqNullSafe(x["raw"]) & (F.get(a, i - 1)["domain"] == x["domain"])
    return F.element_at(F.transform(F.array(keyed), lambda a: F.filter(a, lambda x, i: ~again(a, x, i))), 1)


__all__ = ["CHARSETS", "DOMAIN", "candidates", "chunks", "decode_entities", "finds", "first_finds", "may_match"]
