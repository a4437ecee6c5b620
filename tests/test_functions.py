"""Single expressions: host names, decoding, brackets, addresses."""

import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.functions import rules, text, urls
from linkloom.functions.patterns import PATTERNS
from linkloom.options import Options
from linkloom.sources import pages

BASES = ["http://h/a/b/c.html", "https://H.com:8080/x?y=1#top", "http://h", "http://u:p@h.com/a/", "http://h/", "http://www.e.com/p/q?z#f"]
LINKS = (
    "d.html /r //h2/p HTTPS://HH/x ?x=1 ../u ./v ../../../../z ../../../../../../q /m/../n /m/./n a//b/../c http:rel https:/one wss://x ws:foo x.js:12 "
    "ftp://f/x jar:foo file:///x //h3 //h3?q=1 //h3#f http://h:80a/ http://h:99/ {id} /api/{id} #/route a#b . .. ./ ../ a/. a/.. a/b/../../c ./../x "
    "////unc http://u:p@q.com/x http://a@b@c/x /é /%20 a:b/c 1a:b /x?u=http://y /x:y ?a#b //h:1 ///p x/../../y/.. a/./b/. http:// http: ../..c/../d ..a/.."
).split()


def values(spark, inputs, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_hostnames(spark):
    long = ".".join(["b" * 60] * 4)
    bad = ["cdn-.site.org", "-.org", "_dmarc.site.org", "x_.y", ".org", "site..org", "two words", "site.org..", "ö.org", "\n", None, "", "c" * 64 + ".org", long + ".toolonghere", "a/b"]
    good = ["site.org", "site.org.", "x", "9.9.9.9", "a-b_c.d-e.org", "b" * 63 + ".org", "UPPER.Org", long, "1"]
    assert values(spark, bad + good, rules.valid_hostname) == [False] * len(bad) + [True] * len(good)


def test_decoding(spark):
    asked = {"q%3D1%26r&equals;2": "q=1&r=2", "https%3A\\/\\/h%2Fp": "https://h/p", "&amp;quot;x&#x22;": '"x"', "&amp;#x3a;": "&#x3a;", "&#47;&apos;&lt;": "&#47;&apos;&lt;", "\\u002F&#2F&#02f": "///", "a&nbsp;b": "a b", "%252f": "%252f"}
    assert values(spark, [*asked, None], text.decode_entities) == [*asked.values(), ""]


def test_many_brackets(spark):
    deep = "(" * 1500 + "x" + ")" * 1500
    asked = ["/a" + "(" * 20_000, "()" * 10_000 + "]", deep, deep + "(z", "a" * 5000 + "[b" + deep]
    assert values(spark, asked, rules.bracket_cut) == ["/a", "()" * 10_000, deep, deep, "a" * 5000]


def test_brackets_take_one_pass(spark):
    df = spark.createDataFrame([("(" * n + ")" * n,) for n in (2_500, 20_000)], "s string").cache()
    seconds = []
    for n in (2_500, 20_000, 2_500, 20_000):
        began = time.perf_counter()
        assert df.where(F.length("s") == 2 * n).select(F.length(rules.bracket_cut(F.col("s")))).first()[0] == 2 * n
        seconds.append(time.perf_counter() - began)
    assert seconds[3] < 3 and seconds[3] < 20 * seconds[2]


def test_brackets(spark):
    asked = ["/x(a)b(c", "a(b]c", "/p{id}/q", "([)]", "]x", "a)b(c)", "plain", "((a)(b)", "{[()]}", ""]
    assert values(spark, asked, rules.bracket_cut) == ["/x(a)b", "a", "/p{id}/q", "", "", "a", "plain", "", "{[()]}", ""]


def _cut(s):
    stack = []
    for i, c in enumerate(s):
        if c in "([{":
            stack.append(i)
        elif c in ")]}":
            if stack and s[stack[-1]] + c in ("()", "[]", "{}"):
                stack.pop()
            else:
                return s[: min([i, *stack])]
    return s[: stack[0]] if stack else s


@settings(max_examples=2, deadline=None)
@given(st.lists(st.text("()[]{}ab", max_size=24), min_size=50, max_size=100))
def test_brackets_by_a_stack(spark, asked):
    assert values(spark, asked, rules.bracket_cut) == [_cut(s) for s in asked]


@settings(max_examples=2, deadline=None)
@given(st.lists(st.text("""ab./\\n`"'(){}<>;, \r\né#?$-""", max_size=20), min_size=50, max_size=100))
def test_what_is_usable_holds_to_the_rules(spark, asked):
    for link in values(spark, asked, lambda x: F.when(rules.usable(rules.trimmed(rules.normalised(x))), rules.trimmed(rules.normalised(x)))):
        if link is not None:
            assert 0 < len(link) <= 2000 and not any(c.isspace() or ord(c) < 32 for c in link) and any(c.isascii() and c.isalnum() for c in link)
            assert not link.startswith(("$", "\\", "/=", "-", "...")) and "`" not in link and "</" not in link


def test_addresses_as_the_jdk_has_them(spark):
    rows = [(b, x) for b in BASES for x in LINKS]
    url = spark._jvm.java.net.URL

    def jdk(b, x):
        try:
            found = url(url(b), x)
            return found.toExternalForm(), found.getHost() or ""
        except Exception:
            return None, None

    for r in urls.resolve(spark.createDataFrame(rows, "b string, s string"), "b", "s").collect():
        assert (r["resolved"], r["host"]) == jdk(r["b"], r["s"]), (r["b"], r["s"])


def test_addresses_are_addresses_to_the_jdk(spark):
    asked = [*BASES, *LINKS, "http://[::1]/x", "http://[::1]:80", "http://[::1", "http://h:1:2/", "http://u:p@h:8/", " http://h ", "HTTP:", "x y://h", "http://h/[x]:y", "http://h?a:b@c:d"]
    url = spark._jvm.java.net.URL

    def jdk(x):
        try:
            return url(x) is not None
        except Exception:
            return False

    assert values(spark, asked, urls.is_address) == [jdk(x) for x in asked]


def test_encoding(spark):
    asked = {"http://h.com:8/é x": "http://h.com:8/%C3%A9%20x", "/a%20b%zz": "/a%2520b%25zz", "/a+b?b=c+d&e?%1": "/a%2Bb?b=c+d&e?%251", "/{id}[0]|^": "/%7Bid%7D%5B0%5D%7C%5E", "/a*(b)!~'c;d,$": "/a*(b)!~'c;d,$", "": "", "/😀?": "/%F0%9F%98%80?"}
    assert values(spark, list(asked), urls.encoded) == list(asked.values())


SCRAPS = [*(t for p in PATTERNS for texts in p.needs for t in texts), "IMPORT", "From", "New\tWebSocket(", "new  EventSource(", "<META x ", "URL", "URL=", " = ", "'", '"', "'/a/b'", '"c.js"', "`", "${x}", "(", ")", " ", "\n", "//h.example.com", "x", "{", "}", ":", ",", "post", ".get", "İ", "K"]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SCRAPS), max_size=12).map("".join), min_size=150, max_size=200))
def test_no_find_is_lost(spark, asked):
    """A pattern that finds something in a text has all that it needs there."""
    df = spark.createDataFrame([(x,) for x in asked], "x string")
    lost = [F.sum((F.size(text.finds(F.col("x"), p)) > 0).cast("int") * (~text.may_match(F.lower("x"), p)).cast("int")).alias(p.name) for p in PATTERNS if p.needs]
    assert not any(df.select(*lost).first())


def test_chunks(spark):
    short, long = values(spark, ["a" * 50_000, "b" * 75_001], text.chunks)
    assert [len(c) for c in short] == [50_000] and [len(c) for c in long] == [40_000, 40_000, 5_001]


def test_gates(spark):
    rows = [(0, i, u, t, None, None, b) for i, (u, t, b) in enumerate([("http://a/", "Text/HTML", "x"), (None, "text/html", "x"), ("http://a/", None, "x"), ("http://a/", "text/plain", "x"), ("http://b/", "image/svg+xml", "x"), ("http://a/", "text/css", ""), ("http://a/", "text/css", None)])]
    df = spark.createDataFrame(rows, pages.RESPONSES)
    ids = lambda d: sorted(r["page_id"] for r in d.collect())
    assert ids(pages.gated(df)) == [0, 4]
    assert ids(pages.gated(df, F.col("url") == "http://a/")) == [0]


def test_charsets(spark):
    df = spark.createDataFrame([(1, "é€".encode("cp1252"), "windows-1252"), (2, "é".encode(), None), (3, "é".encode(), "no-such"), (4, None, "utf-8")], "i int, body binary, charset string")
    assert {r["i"]: r["body"] for r in pages.decode_bytes(df, "body", "charset").collect()} == {1: "é€", 2: "é", 3: "é", 4: None}


def test_options_in_effect(spark):
    """A scan of one split is spread over so many threads; stored options come back as they were."""
    path = "/root/testdata/sf0.001/pages.parquet"
    assert pages.read_pages(spark, path, Options().with_threads(5)).rdd.getNumPartitions() == 5
    assert Options.load({**Options().store(), "threads": 1, "discover_subdomains": False}) == Options(discover_subdomains=False)


def test_options():
    assert Options().with_threads(99).threads == 8 and Options().with_threads(1).threads == 2
    assert Options.load({"threads": 99, "other": 1}).threads == 99 and Options.load({"threads": 0}).threads == 2
    assert Options.load(Options(parse_javascript=False).store()) == Options(parse_javascript=False)
