"""What makes the search quicker changes nothing that it finds."""

import random

from pyspark.sql import functions as F

from linkloom.functions import constants as C
from linkloom.functions import rules, text
from linkloom.functions.patterns import BY_NAME, LETTER, PATTERNS
from linkloom.operators import extract
from linkloom.sources.pages import RESPONSES


#: What begins with a look-ahead, without it.
PLAIN = {
    "attr": r"""(?i)(?<![\w:.])[\w:]*?(?:href|src|action|poster|cite|formaction|background|longdesc|usemap|manifest|codebase|profile)\s*=\s*["']([^"'#\s>]+)["']""",
    "bare_domain": BY_NAME["bare_domain"].regex.replace(rf"(?=[{LETTER}][{LETTER}_-]*+\.[{LETTER}])", ""),
    "path_literal": BY_NAME["path_literal"].regex.replace("(?=[#/.])", "").replace("""(?<![^"' ])""", """(?:^|(?<=["' ]))"""),
    "path_ext": BY_NAME["path_ext"].regex.replace(r"(?=[a-zA-Z0-9_\-/][a-zA-Z0-9_\-]*+/)", "").replace("""(?<![^"' ])""", """(?:^|(?<=["' ]))"""),
    "file_ext": BY_NAME["file_ext"].regex.replace(r"(?=[a-zA-Z0-9_\-\.][a-zA-Z0-9_\-]*+\.)", "").replace("""(?<![^"' ])""", """(?:^|(?<=["' ]))"""),
}


def test_a_look_at_what_must_follow_changes_no_find(spark):
    rng, parts = random.Random(5), ["href", "href=", "src ='", "=\"", "x:src", "-action", " = ", "=", "'", '"', "/", "#/", "../", ".", "a", "b-", "_", "é", "Z9", ".js", ".php?x=1", "www", "com", " ", "\n", ":", "-", "/a/b.html", ";", "//"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(40_000)]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for name, plain in PLAIN.items():
        pattern = BY_NAME[name]
        assert plain != pattern.regex
        was, now = (F.regexp_extract_all("x", F.lit(r), F.lit(pattern.group)) for r in (plain, pattern.regex))
        n = df.agg(F.sum((~was.eqNullSafe(now)).cast("int")), F.sum(F.size(now))).first()
        assert n[0] == 0 and n[1] > 100, name


def test_only_encoded_texts_are_decoded(spark):
    """As by the regexes alone; and each form in ENCODED has its beginning in ENCODED_STARTS."""
    rng, parts = random.Random(6), ["&#", "x2f;", "X2F;", "2f", "02F", "%2", "%25", "f", "F", "%3a", "%3A", "%3D", "%26", "&amp;", "&AMP;", "#38;", "#038;", "\\u00", "\\U00", "26", "2F", "3d", "3a", "\\/", "&", "quot;", "QUOT;", "equals;", "Equals;", "nbsp;", "Nbsp;", "#61;", "%22", "#34;", "x"]
    df = spark.createDataFrame([("".join(rng.choices(parts, k=rng.randint(1, 8))),) for _ in range(20_000)], "x string")
    was = F.col("x")
    for regex, character in C.ENCODED:
        was = F.regexp_replace(was, F.lit(f"(?i){regex}"), F.lit(character))
    n = df.agg(F.sum((was != text.decode_entities(F.col("x"))).cast("int")), F.sum((was != F.col("x")).cast("int"))).first()
    assert n[0] == 0 and n[1] > 5000


def test_signs_are_in_all_encoded_beginnings():
    assert all(any(sign in start for sign in C.ENCODED_SIGNS) for starts in C.ENCODED_STARTS for start in starts)


def test_plain_finds_stay_as_they_are(spark):
    """What is taken for plain is what normalising wouldn't change; most finds of pages are."""
    rng, parts = random.Random(7), ["a", "Z9", "/", "//", ".", "..", "-", "_", "?", "#", "x=1", "&", "%2f", "+", "~", ":", ",", ";", ">", "<", "</", "`", "\\", "\\n", "\n", "\r", " ", "\x00", "(", ")", "[", "]", "{", "}", "'", '"', "é", "$"]
    texts = ["".join(rng.choices(parts[: rng.choice((16, 16, len(parts)))], k=rng.randint(0, 7))) for _ in range(40_000)]
    df = spark.createDataFrame([(t,) for t in texts], "x string").where(rules.plain(F.col("x")))
    n = df.agg(F.count(F.lit(1)), F.sum((~rules.trimmed(rules.normalised(F.col("x"))).eqNullSafe(F.col("x"))).cast("int"))).first()
    assert n[0] > 10_000 and n[1] == 0


def test_a_text_found_again_is_normalised_once(spark):
    """Candidates and their first places are those of all finds; what a page has at several places, or for several patterns, is one row before it's normalised."""
    links = "<a href='/a'> <a href='/a,'> <a href='/b'> '/a' \"/a\" fetch('/a') see www.example.com/x '//www.example.com/x' https://www.example.com/x '/c.js' 'c.js' "
    bodies = {0: links, 1: links * 3, 2: links * 600, 3: "no link", 4: ""}  # the third is long enough for chunks
    rows = [(0, p, "http://h.com/", "text/html", "/a", " /a ", b) for p, b in bodies.items()]
    df = spark.createDataFrame(rows, RESPONSES)
    every = extract.found_candidates(df)
    was, now = (sorted(x.collect()) for x in (extract.distinct_candidates(every), extract.extract_candidates(df)))
    assert was == now and {r["page_id"] for r in now} == set(bodies)
    once = extract.raw_candidates(df, repeats=False)
    domain = F.col("pattern_no") == [p.name for p in PATTERNS].index("bare_domain")
    n = once.groupBy("page_id", "raw", domain.alias("d")).count().agg(F.sum("count"), F.count(F.lit(1))).first()
    assert n[0] == n[1] == once.count() < 100 < extract.raw_candidates(df).count()
