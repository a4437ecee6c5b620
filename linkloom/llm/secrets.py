"""Secret scans by a trigram inverted index, as DataFrame functions only.

From each rule's regex a Boolean query of trigrams is derived: in which sets of trigrams one must occur in full for
the regex to match. Only trigrams that some query names are indexed, in lower case. Documents are dealt to shards by a
hash; a shard's posting lists, of a bounded number of documents, are intersected and united as each query says;
what comes out are the documents where the rule's regex is run. Rules without mandatory trigrams (such as a run
of hex digits) are run on all documents.

A rule's spans are its leftmost matches that don't overlap each other, less those whose group is too short.
Each pattern passes over a text in linear time, and sums over its matches go by blocks of a square root of their
number, so long texts and many matches cost little more than their size.

Cases: a null text counts as empty, without spans; places count code points, the end is exclusive; repeated
rows give their spans each; an empty table gives no rows; further columns are ignored but for those that `keep` names.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import shielded, text_or_empty


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 1  # code points of the group


#: What counts as a secret. The first three are the base rules.
RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    # lines of a header (of encrypted keys, and of PGP), the body, and the end if it is there
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----(?:[\\rn\r\n]{1,4}[A-Z][A-Za-z-]{1,30}: [^\\\r\n]*){0,8}[A-Za-z0-9+/=\\\r\n]*(?:-----END [A-Z ]{0,20}PRIVATE KEY(?: BLOCK)?-----)?"),
    Rule("code_host", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"sk_live_[A-Za-z0-9]{16,}"),
    # the rest is optional and asked for as a group, so that a run without it is passed over as a whole rather than tried from each eyJ in it
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}(\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})?", 1, 1),
)
BASE = 3
#: Rules whose runs can be found faster by asking for the least length at once; a shorter run has no other match inside.
RUNS = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
#: Documents of a shard.
SHARD = 2000
#: Strings, and sets of trigrams, that a query holds at most while it is derived; beyond, it asks for less.
WIDE = 64

Query = frozenset[frozenset[str]]
ALWAYS: Query = frozenset([frozenset()])


def _least(query: Query) -> Query:
    """Without sets that hold another one."""
    return frozenset(a for a in query if not any(b < a for b in query))


def _both(a: Query, b: Query) -> Query:
    found = _least(frozenset(x | y for x in a for y in b))
    return found if len(found) <= WIDE else min(a, b, key=len)


def _of(strings: set[str]) -> Query:
    return _least(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def _walk(items) -> tuple[set[str] | None, Query]:
    """(all strings that items match, in lower case, or None if they are many; a query that holds for a match)"""
    exact, query, whole = {""}, ALWAYS, True

    def end() -> None:
        nonlocal exact, query, whole
        query, exact, whole = _both(query, _of(exact)), {""}, False

    for kind, value in items:
        strings, own = None, ALWAYS
        if kind is kinds.LITERAL:
            strings = {chr(value).lower()}
        elif kind is kinds.IN and all(k is kinds.LITERAL for k, _ in value):
            strings = {chr(v).lower() for _, v in value}
        elif kind is kinds.SUBPATTERN:
            strings, own = _walk(value[3])
        elif kind is kinds.BRANCH:
            found = [_walk(x) for x in value[1]]
            strings = set().union(*(s for s, _ in found)) if all(s is not None for s, _ in found) else None
            own = _least(frozenset().union(*(_both(q, _of(s)) if s is not None else q for s, q in found)))
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
            least, most, inner = value
            strings, own = _walk(inner)
            if least == 0:
                strings, own = (strings | {""} if strings is not None and most == 1 else None), ALWAYS
            elif most != 1:
                own, strings = _both(own, _of(strings)) if strings is not None else own, None
        if strings is not None and len(strings) * len(exact) <= WIDE:
            exact = {a + b for a in exact for b in strings}
        else:
            end()
            query = _both(query, own if strings is None else _of(strings))
    if whole:
        return exact, query
    end()
    return None, query


def trigram_query(pattern: str) -> Query | None:
    """Sets of trigrams, one of which a lower-cased text must hold for the pattern to match; None: no mandatory ones."""
    strings, query = _walk(parser.parse(pattern))
    query = _both(query, _of(strings)) if strings is not None else query
    return None if any(not s for s in query) else query


#: Letters and marks that are the most common ones in texts of many languages, and how many trigrams of a set are asked for.
COMMON, ASKED = set(" etaoinsrhldcu"), 3


def rarest(query: Query) -> Query:
    """The query with ASKED trigrams of each set only, those with the fewest common letters: it holds wherever the whole one does."""
    order = lambda t: (sum(c in COMMON for c in t), t)
    return _least(frozenset(frozenset(sorted(s, key=order)[:ASKED]) for s in query))


def keyed(documents: DataFrame) -> DataFrame:
    docs = documents.select("doc_id", text_or_empty().alias("text"))
    return docs.withColumn("key", F.xxhash64("doc_id", "text"))


def index(docs: DataFrame, trigrams: list[str], shards: int) -> DataFrame:
    """shard, lists: a map of each trigram to the keys of the shard's documents that hold it."""
    low = F.lower("text")
    held = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams)))
    postings = docs.select(F.pmod(F.col("key"), F.lit(shards)).alias("shard"), "key", F.explode(held).alias("trigram"))
    lists = postings.groupBy("shard", "trigram").agg(F.collect_set("key").alias("keys"))
    return lists.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))


def candidates(lists: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """key, rules: the numbers of the rules whose query the document meets."""
    none = F.array().cast("array<bigint>")
    of = lambda t: F.coalesce(F.element_at("lists", F.lit(t)), none)
    met = lambda q: reduce(F.array_union, (reduce(F.array_intersect, map(of, sorted(s))) for s in sorted(q, key=sorted)))
    each = F.array(*(F.struct(F.lit(k).alias("rule"), met(q).alias("keys")) for k, q in queries.items()))
    found = lists.select(F.explode(each).alias("e")).select("e.rule", F.explode("e.keys").alias("key"))
    return found.groupBy("key").agg(F.collect_list("rule").alias("rules"))


def bound(value: Column, use) -> Column:
    """use(value), with value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _step(n: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.sqrt(n))).cast("int")


def _blocks(xs: Column) -> Column:
    """xs cut into about as many parts as a part has elements."""
    step = _step(F.size(xs))
    return F.when(F.size(xs) > 0, F.transform(F.sequence(F.lit(1), F.size(xs), step), lambda i: F.slice(xs, i, step))).otherwise(F.array(xs))


def running(xs: Column, with_: Callable[[Column, Column], Column]) -> Column:
    """array<int>: the sum (or what `with_` does) of each element and all before it; 0 comes before the first."""

    def plain(part: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: bound(with_(acc["at"], x).cast("int"), lambda now: F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out")))
        return F.aggregate(part, start, step, lambda acc: acc["out"])

    def joined(parts: Column) -> Column:
        ends = plain(F.transform(parts, lambda p: F.coalesce(F.get(p, F.size(p) - 1), F.lit(0))))
        whole = lambda e: F.flatten(F.transform(parts, lambda p, i: bound(F.coalesce(F.get(e, i - 1), F.lit(0)), lambda before: F.transform(p, lambda x: with_(before, x).cast("int")))))
        return bound(ends, whole)

    return bound(xs, lambda own: bound(F.transform(_blocks(own), plain), joined))


NO_SPANS = "array<struct<start:int,no:int,end:int>>"


def spans_of(rule: Rule, no: int, text: Column) -> Column:
    """array<struct<start, no, end>> of a rule's spans in a text."""
    pattern = RUNS.get(rule.kind, rule.pattern)
    sizes = lambda xs: F.transform(xs, lambda s: F.length(s))
    whole = sizes(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    group = sizes(F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))) if rule.group else whole
    gaps = sizes(F.split(text, pattern, -1))

    def made(w: Column) -> Column:
        ends = running(F.zip_with(F.slice(gaps, 1, F.size(w)), w, lambda g, n: g + n), lambda a, b: a + b)
        each = F.arrays_zip(ends.alias("end"), w.alias("n"), (group if rule.group else w).alias("g"))
        return F.transform(F.filter(each, lambda x: x["g"] >= rule.least), lambda x: F.struct((x["end"] - x["n"]).alias("start"), F.lit(no).alias("no"), x["end"].alias("end")))

    return F.when(text.rlike(pattern), bound(whole, made)).otherwise(F.array().cast(NO_SPANS))


def scan(documents: DataFrame, rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text (and `keep`), spans: array<struct<start, no, end>> by start, then rule. A kept column of one of these names gives way."""
    queries = {k: rarest(q) for k, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    keep = tuple(c for c in keep if c not in ("doc_id", "text", "spans"))
    hidden, _ = shielded(documents.select("doc_id", "text", *(F.col(f"`{c}`") for c in keep)), ("doc_id", "text"))
    kept = hidden.columns[2:]
    docs = keyed(hidden)
    shards = max(1, ceil(documents.count() / SHARD))
    lists = index(docs, sorted({t for q in queries.values() for s in q for t in s}), shards)
    found = candidates(lists, queries)
    whole = hidden.select("doc_id", text_or_empty().alias("text"), *kept).withColumn("key", F.xxhash64("doc_id", "text"))
    joined = whole.join(found, "key", "left")
    none = F.array().cast(NO_SPANS)
    each = [F.when(F.array_contains("rules", k), spans_of(r, k, F.col("text"))).otherwise(none) if k in queries else spans_of(r, k, F.col("text")) for k, r in enumerate(rules)]
    return joined.select("doc_id", "text", *(F.col(h).alias(c) for h, c in zip(kept, keep, strict=True)), F.explode(F.array(F.array_sort(F.concat(*each)))).alias("spans"))


def named(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of all spans, joined by commas."""
    kind = lambda s: F.element_at(F.array(*(F.lit(r.kind) for r in rules)), s["no"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def digests(documents: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["no"] < BASE)
    n = lambda k: F.size(F.filter("spans", lambda s: s["no"] == k)).cast("long")
    return scan(documents).select("doc_id", *(n(k).alias(f"n_{RULES[k].kind}") for k in range(BASE)), F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column, put: str = "[SECRET]") -> Column:
    """The text with each span, overlapping ones together, replaced."""

    def made(own: Column, reached: Column) -> Column:
        """reached: up to where the spans so far go."""
        before = lambda i: F.coalesce(F.get(reached, i - 1), F.lit(0))
        gaps = F.filter(F.transform(own, lambda s, i: F.struct(before(i).alias("from"), s["start"].alias("to"))), lambda g: g["to"] >= g["from"])
        cut = lambda s, a, b: s.substr(a + 1, b - a)

        def part(block: Column) -> Column:
            """The gaps of a block, cut out of the block's own part of the text."""
            low, high = F.element_at(block, 1)["from"], F.element_at(block, -1)["to"]
            return bound(cut(text, low, high), lambda r: F.array_join(F.transform(block, lambda g: F.concat(cut(r, g["from"] - low, g["to"] - low), F.lit(put))), ""))

        kept = F.array_join(bound(gaps, lambda g: F.transform(_blocks(g), part)), "")
        return F.concat(kept, text.substr(F.element_at(reached, -1) + 1, F.length(text)))

    ends = lambda own: running(F.transform(own, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    return F.when(F.size(spans) > 0, bound(spans, lambda own: bound(ends(own), lambda reached: made(own, reached)))).otherwise(text)
