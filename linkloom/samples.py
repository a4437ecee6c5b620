"""Responses made from the pages table, by page_id, so that every pattern and rule has something to find.

The same snippets make the Spark table and the SQL that queries are checked against. {n} stands for the page_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.sources.pages import encode_bytes

SNIPPETS = (
    """<a href="/profile/{n}">x</a><link data-href='/static/app{n}.css'><form action="/login?n={n}"></form>""",
    """<img src="/img/logo{n}.png"><a xlink:href="/x{n}"src="/y{n}"> x.href="/no" href="/with#frag" href="/font.woff2?v=1" """,
    """<meta http-equiv="refresh" content="0;url=/next/{n}"> <META content="5; URL = /later/{n}#top">""",
    """<style>a{background:url(/bg/{n}.html)} b{background:url( "/bg/{n}.css" )} c{x:url('/font{n}.eot')}</style>""",
    """see https://docs{n}.example.com/guide/{n}?q=1 or HTTP://API.example.com:8080/v1/{n}. (https://en.example.org/wiki)""",
    """load "//cdn{n}.example.net/lib.js" or (//rel.example.com/api/{n}) or //a.b.c.example.com/x now""",
    """/*# sourceMappingURL = /maps/site{n}.css.map */\n//@ sourceMappingURL=lib.{n}.js.map""",
    """ask mirror{n}.example.net, db-1.internal or x.bootstrap.com, a.b, z.co.uk, -m.example.net, sale.top, self.com, desk@post{n}.example.net""",
    """fetch('/api/v{n}/orders'); fetch( "/api/v1/carts/{n}" ); FETCH('/upper/{n}')""",
    """x.open('GET', '/xhr/{n}'); r.open("post" , "/xhr/post/{n}")""",
    """import a from '/mod/{n}.js'; import "/mod/side{n}.js"; import('/lazy/{n}.js'); import ( "/lazy/b{n}.js" )""",
    """require('./lib/{n}'); require.resolve("../up/{n}"); var c = require('config.json')""",
    """location.href = '/logout/{n}'; window.location="/home/{n}"; location = '/plain/{n}'; window.open('/admin/{n}')""",
    """$.ajax({type: 'POST', url: '/ajax/{n}'}); $.get('/jq/{n}'); $.getJSON("/jq/{n}.json")""",
    """axios.get("/ax/{n}"); axios('/ax/base/{n}'); axios.delete('/ax/d/{n}')""",
    """new WebSocket('wss://ws.example.com/{n}'); new EventSource("/events/{n}"); navigator.sendBeacon('/beacon/{n}')""",
    """const u = `/api/items/${id}/edit/{n}`; const v = `/plain/{n}`; const w = `/t/${a.b}/${c}`""",
    """const a = '/api/v2/items/{n}'; const b = 'api/v2/export{n}.json'; const c = 'config{n}.json'; d = 'x.tar.gz' e = "#/route/{n}" """,
    """p "./rel/{n}" q "../up/{n}" 'a/b/c{n}.php?x=1 2' "dir/file.js.map" 'one.js' 'two.php?id={n}' \t'/tab/{n}'\n'/line/{n}'""",
    """axios('%2Fenc%2fone{n}'); location='https&#x3A;&#2f&#x2F;e{n}.example.net&#x2f;in'; k = '\\u002Forders\\u002f{n}'""",
    """href=&quot;/quoted/{n}&quot; href=%22/pct/{n}%22 a&amp;quot;b &#38;amp; x&equals;y &nbsp;&#061;&#2f;&#X2F; \\/esc\\/{n} &amp;#x2f;""",
    """let s="/tick/{n}`more"; p = '/open/{k'; r = '/pair/{n}{k}'; url('/tag{n}</i'); t = "/f(g)h(i" v = "/l[0]]{n}" """,
    """fetch('javascript:alert({n})'); fetch('data:text/html,x'); fetch('mailto:a@b.c'); fetch('tel:1{n}'); fetch('#frag'); fetch('#/app/{n}')""",
    """fetch('$x/{n}'); fetch('/=a'); fetch('-opt'); fetch('...'); fetch('text/html'); fetch('image/png'); fetch('a b'); fetch('/é'); fetch('.hid/{n}')""",
    """fetch('/go?u=https://www.facebook.com/{n}'); fetch('/login/google/{n}'); fetch('https://cdn.jsdelivr.net/x'); fetch('/wp-content/{n}'); fetch('/ok/{n}?google')""",
    """fetch('/dup/{n}'); axios.get('/dup/{n}'); fetch('/dup/{n}'); <a href="/dup/{n}"> <a href="/dup/{n},"> <a href="/dup/{n};>">""",
    """fetch('https://Other{n}.Example.org'); fetch('https://other{n}.example.org?x=1'); fetch('//bad_.example.org/x'); fetch('http://h:9x/y'); fetch('ftp://ftp.example.org/{n}')""",
    """fetch('\\n/esc/{n}\\n'); fetch('(/paren/{n}'); fetch('/back/{n}\\\\'); fetch('/dot\\.js/{n}'); fetch(' /space/{n} ')""",
)

CONTENT_TYPES = ("text/html", "text/plain", "Application/JavaScript", "image/svg+xml", "image/png", "application/json; charset=utf-8", None, "text/css")
SOURCE_MAPS = (" /maps/a{n}.map ", None, "", "  ", "b{n}.js.map", "//maps.example.com/{n}.map", "blob:x{n}", "/m/{n}.png")


def _quoted(text: str | None) -> str:
    if text is None:
        return "null"
    return "'" + text.replace("'", "''") + "'"


def _chosen(texts: tuple[str | None, ...], key: Column, n: Column) -> Column:
    picked = F.element_at(F.array(*(F.lit(t) for t in texts)), (key % len(texts) + 1).cast("int"))
    return F.replace(picked, F.lit("{n}"), n.cast("string"))


def _chosen_sql(texts: tuple[str | None, ...], key: str) -> str:
    return f"replace([{', '.join(map(_quoted, texts))}][({key}) % {len(texts)} + 1], '{{n}}', cast(page_id as varchar))"


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with a snippet before it; every 25th is repeated until it is long enough for chunks."""
    n, html = F.col("page_id"), F.coalesce("html", F.lit(""))
    long = F.when(n % 25 == 3, F.repeat(html, 12)).otherwise(html)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").repartition(spark.sparkContext.defaultParallelism)  # one split otherwise
    return pages.select(
        (n % 3).alias("session_id"), "page_id", "url",
        _chosen(CONTENT_TYPES, n, n).alias("content_type"),
        _chosen(SOURCE_MAPS, n, n).alias("source_map"), _chosen(SOURCE_MAPS, F.floor(n / 8), n).alias("x_source_map"),
        F.concat(_chosen(SNIPPETS, n, n), F.lit("\n"), long).alias("body"),
    )


#: Charsets of archived responses, and what of a text they can't say; such a text is in UTF-8.
ARCHIVE_CHARSETS = (("utf-8", None), ("iso-8859-1", r"[^\x{0}-\x{FF}]"), ("windows-1252", r"[^\x{0}-\x{7F}\x{A0}-\x{FF}]"), ("utf-16", None), ("gb18030", None), ("shift_jis", r"[^\x{20}-\x{5B}\x{5D}-\x{7D}\n]"))


def archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The responses with bodies as bytes, in a charset that their content type names; those without a type are in UTF-8."""
    texts = responses(spark, sf_dir)
    named = F.lit("utf-8")
    for i, (name, lacks) in enumerate(ARCHIVE_CHARSETS):
        own = (F.col("page_id") % len(ARCHIVE_CHARSETS) == i) & F.col("content_type").isNotNull()
        named = F.when(own if lacks is None else own & ~F.col("body").rlike(lacks), name).otherwise(named)
    kind = F.concat(F.substring_index("content_type", ";", 1), F.lit("; charset="), F.col("charset"))
    return encode_bytes(texts.withColumn("charset", named).withColumn("content_type", kind), "body", "charset").drop("charset")


ARCHIVED_SQL = "case page_id % " + str(len(ARCHIVE_CHARSETS)) + "".join(
    f" when {i} then " + (f"'{name}'" if lacks is None else f"case when regexp_matches(body, '{lacks}') then 'utf-8' else '{name}' end") for i, (name, lacks) in enumerate(ARCHIVE_CHARSETS)
) + " end"

RESPONSES_SQL = f"""responses as (
  select page_id % 3 as session_id, page_id, url, {_chosen_sql(CONTENT_TYPES, "page_id")} as content_type,
    {_chosen_sql(SOURCE_MAPS, "page_id")} as source_map, {_chosen_sql(SOURCE_MAPS, "page_id // 8")} as x_source_map,
    {_chosen_sql(SNIPPETS, "page_id")} || chr(10) || case when page_id % 25 = 3 then repeat(coalesce(html, ''), 12) else coalesce(html, '') end as body
  from pages)"""
