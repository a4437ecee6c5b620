"""Which links come out of which bodies."""

import pytest

from linkloom.operators.extract import extract_candidates
from linkloom.sources.pages import RESPONSES

#: name: (body, with scripts, links that come out, links that don't)
CASES = {
    "quoted attributes of any name": ('<area HREF = "/map/1"><video poster=\'p/still.html\' data-src="/lazy"><q cite="./ref"><object longdesc="../about.txt"><td background="/bg.php">', True, {"/map/1", "p/still.html", "/lazy", "./ref", "../about.txt", "/bg.php"}, set()),
    "no attributes of objects, none without quotes": ('window.src="/no1" <a href=/no2> node.parent.href = "/no3" <a hrefs="/no4">', False, set(), {"/no1", "/no2", "/no3", "/no4"}),
    "fragments end an attribute's match": ('<a href="/doc#part"> <a href="/whole">', False, {"/whole"}, {"/doc", "/doc#part"}),
    "refresh": ('<meta content="9; url=/moved.html#x" http-equiv=refresh>', False, {"/moved.html"}, set()),
    "styles": ("i{background:url( 'theme/dark.css' )} b{src:url(/f/a.woff2) u{c:url(/plain)}", False, {"theme/dark.css", "/plain"}, {"/f/a.woff2"}),
    "addresses in prose": ("Read HTTPS://Wiki.example.net:8443/a_b(c) first, then (//mirror.example.net/z).", False, {"HTTPS://Wiki.example.net:8443/a_b", "//mirror.example.net/z"}, {"//mirror"}),
    "maps of sources": ("/*# sourceMappingURL = ../maps/site.css.map */ //@ sourceMappingURL=lib.js.map", False, {"../maps/site.css.map", "lib.js.map"}, set()),
    "calls": ("fetch(`/t`); fetch( '/orders?id=7' ); req.open( 'DELETE' , \"/orders/8\" ); $.getJSON('/j'); axios.put('/put/9', x); axios(\"/bare\"); navigator.sendBeacon('/b/1')", True, {"/orders?id=7", "/orders/8", "/j", "/put/9", "/bare", "/b/1"}, {"/t"}),
    "modules": ("import z from './z/index'; export * from \"../lib/y.mjs\"; const m = await import( '/m.js' ); require.resolve('pkg/main')", True, {"./z/index", "../lib/y.mjs", "/m.js", "pkg/main"}, set()),
    "places": ("window.location.href='/next' ; location = \"/there\"; window.open( '/pop' )", True, {"/next", "/there", "/pop"}, set()),
    "sockets": ("new WebSocket( 'wss://live.example.net/feed' ); new EventSource('/sse')", True, {"wss://live.example.net/feed", "/sse"}, set()),
    "options of calls": ("$.ajax({ cache: false,\n url : '/opt/1', type: 'GET' })", True, {"/opt/1"}, set()),
    "templates": ("let a = `/u/${user.id}/posts?p=${n}`; let b = `/static/none`; let c = `${host}/x`", True, {"/u/__DYNAMIC__/posts?p=__DYNAMIC__", "__DYNAMIC__/x"}, set()),
    "without scripts": ("fetch('/only/script'); \"/literal/path\" <form action='/always'>", False, {"/always"}, {"/only/script", "/literal/path"}),
    "literals": ("a='/v3/ping' b=\"../up/one\" c='#/route/2' d='dir/page.aspx?x=1' e='report.xlsx' f='notes.doc'", True, {"/v3/ping", "../up/one", "#/route/2", "dir/page.aspx?x=1", "report.xlsx"}, {"notes.doc"}),
    "literals between spaces, not tabs": ("go ./near/by now\t./far/off\tor", True, {"./near/by"}, {"./far/off"}),
    "pictures, fonts, odd schemes": ("href='/a.PNG' href='/b.jpeg?v=2' href='/c.ico' src='JavaScript:go()' href='tel:112' href='mailto:x@y.z' src='data:,x' href='/d.png.html'", False, {"/d.png.html"}, {"/a.PNG", "/b.jpeg?v=2", "/c.ico", "JavaScript:go()", "tel:112", "mailto:x@y.z", "data:,x"}),
    "undone encodings": ("fetch('%2Fapi%2Forders%3Fid%3d3'); href=&quot;\\/esc\\/aped&quot; open&#x28; src='/q?a=1&amp;b=2' href='http&#x3A;\\u002f\\u002Fenc.example.net'", True, {"/api/orders%3Fid=3", "/esc/aped", "/q?a=1&b=2", "http://enc.example.net"}, set()),
    "tails that don't belong": ("href='/semi;' href='/comma,' href='/gt>' fetch('/tick`rest') fetch('/tag</b') fetch('/back\\\\') href='(/open'", True, {"/semi", "/comma", "/tick", "/tag", "/back", "/open"}, {"/tick`rest", "/tag</b"}),
    "brackets without partners": ("fetch('/f(x') fetch('/g[0]/h') fetch('/i}j') fetch('/k{id}')", True, {"/f", "/g[0]/h", "/i", "/k{id}"}, {"/f(x", "/i}j"}),
    "bare hosts": ("ask mirror.example.net, db-1.internal or build.example.org/log?x=1 but not node.js, e.g. or a.bc", False, {"//mirror.example.net", "//db-1.internal", "//build.example.org/log?x=1"}, {"//node.js", "//a.bc"}),
    "hosts that aren't": ("-mirror.example.net mirror-.example.net style.rest cheap.top x.co.uk this.com", False, {"//mirror.example.net"}, {"//-mirror.example.net", "//mirror-.example.net", "//style.rest", "//cheap.top", "//x.co.uk", "//this.com"}),
    "many labels": ("q.w.e.r.t.z.u.i.o.p.example.net (//aa.bb.cc.dd.ee.example.org/deep)", False, {"//q.w.e.r.t.z.u.i.o.p.example.net", "//aa.bb.cc.dd.ee.example.org/deep"}, set()),
    "mail": ("send it to desk@post.example.net", False, {"//post.example.net"}, set()),
    "mixed quotes": ("<a href='/left\"> <a href=\"/right'>", False, {"/left", "/right"}, set()),
    "needs a letter or digit": ("href='/ß' href='/---' href='/1'", False, {"/1"}, {"/ß", "/---"}),
    "words that are junk anywhere in a path": ("fetch('/auth/facebook/start') fetch('/ok?next=facebook') fetch('https://www.w3.org/ns')", True, {"/ok?next=facebook"}, {"/auth/facebook/start", "https://www.w3.org/ns"}),
    "starts like code": ("fetch('$var') fetch('-flag') fetch('...rest') fetch('/=eq') fetch('#top') fetch('#/app') fetch('image/webp') fetch('two words')", True, {"#/app"}, {"$var", "-flag", "...rest", "/=eq", "#top", "image/webp", "two words"}),
}


def responses(spark, bodies):
    rows = [(0, i, f"http://h{i}.com/", "text/html", None, None, b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, RESPONSES)


@pytest.mark.parametrize("javascript", [True, False])
def test_cases(spark, javascript):
    own = [(name, c) for name, c in CASES.items() if c[1] == javascript]
    found = extract_candidates(responses(spark, [c[0] for _, c in own]), javascript).collect()
    for i, (name, (_, _, there, absent)) in enumerate(own):
        links = {r["candidate"] for r in found if r["page_id"] == i}
        assert there <= links, (name, there - links)
        assert not absent & links, (name, absent & links)


def test_one_row_a_page_and_link(spark):
    body = "axios('/twice/1') $.get('/twice/1') <a href='/twice/1'> '/twice/1'"
    assert [r["candidate"] for r in extract_candidates(responses(spark, [body])).collect()] == ["/twice/1"]


def test_null_empty_and_long_bodies(spark):
    long = "<p>" + "x" * 60_000 + "</p><a href='/late'>" + "(" * 3000 + "a-" * 30_000
    found = extract_candidates(responses(spark, [None, "", long])).collect()
    assert [(r["page_id"], r["candidate"]) for r in found] == [(2, "/late")]


def test_headers_come_last(spark):
    rows = [(0, 1, "http://h.com/a/b", "text/html", " x.map ", "blob:y", "<a href='/z'>"), (0, 2, "http://h.com/", "text/html", "", None, "z")]
    found = extract_candidates(spark.createDataFrame(rows, RESPONSES)).orderBy("place").collect()
    assert [(r["page_id"], r["candidate"]) for r in found] == [(1, "/z"), (1, "http://h.com/a/x.map"), (1, "blob:y")]
