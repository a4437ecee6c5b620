r"""The extraction patterns, in order, put together from a small grammar.

Each pattern has a name, a regex of java.util.regex, and the group that is the find. Q is a quote, V a quoted value.
START and END are where a bare literal may begin and end: at the text's ends, quotes and spaces (END: also line ends). What the patterns match is a fixed value, all of them.

A look-ahead at a pattern's beginning says again, without going back, what must follow there in any case, so that most words of a
text are passed over after one look. It changes no match (tested).
"""

from __future__ import annotations

from dataclasses import dataclass

Q, V = r"""["']""", r"""([^"']+)"""
LETTER = r"a-zA-Z0-9\x{0080}-\x{FFFF}"
#: A label of a host, without going back: a dot must follow, which no label holds, so only all of a run can match.
QUICK_LABEL = f"[{LETTER}](?:[{LETTER}_-]*+(?<=[{LETTER}]))?+"
MOST_LABELS = 24
START, END = r"""(?<![^"' ])""", r"""(?=$|["'\n\r ])"""
#: Attributes, extensions, and characters that don't begin a path.
ATTRIBUTES = "href src action poster cite formaction background longdesc usemap manifest codebase profile".split()
ODD_EXTENSIONS = r"php3 php5 action xhtml config bzip2 tar\.gz js\.map".split()
FILES = (
    r"php php3 php5 asp aspx ashx cfm cgi pl jsp jspx json js action html xhtml htm bak do txt wsdl wadl xml xls xlsx bin conf "
    r"config bz2 bzip2 gzip tar\.gz tgz log src zip js\.map"
).split()
NO_PATH_START = r"""[^"'><,;| *()%$^/\\\[\]]"""


@dataclass(frozen=True)
class Pattern:
    name: str
    regex: str
    group: int = 1
    javascript: bool = False
    #: Where it matches, there is one of each of these groups of texts (in lower case).
    needs: tuple[tuple[str, ...], ...] = ()


def _call(name: str, before: str, *needs: str) -> Pattern:
    return Pattern(name, f"(?i){before}{Q}{V}{Q}", 1, True, (needs,))


# a prefix may hold hyphens too, but what follows a hyphen begins a match as well, so long runs needn't be tried from each
_attribute = r"[\w:]*?(?:" + "|".join(ATTRIBUTES) + r")\s*=\s*"
_value = r"""([^"'#\s>]+)"""
_host = lambda label, tail: rf"(?:{label}\.){{0,{MOST_LABELS}}}{label}\.{tail}"
_domain = lambda label: _host(label, rf"""[a-zA-Z]{{2,24}}(?:/[^\s"'<>()\[\]{{}}]{{0,500}})?""")
_path = rf"""(?:(?:#?/|\.\./|\./){NO_PATH_START}[^"'><,;|()\s]{{1,255}})"""
_path_ext = rf"""(?=[a-zA-Z0-9_\-/][a-zA-Z0-9_\-]*+/)([a-zA-Z0-9_\-/]{{1,}}/[a-zA-Z0-9_\-/\.]{{1,255}}\.(?:[a-zA-Z]{{1,4}}|{"|".join(ODD_EXTENSIONS)})(?:[?/][^"']{{0,1000}}|))"""
_file_ext = rf"""(?=[a-zA-Z0-9_\-\.][a-zA-Z0-9_\-]*+\.)([a-zA-Z0-9_\-\.]{{1,255}}\.(?:{"|".join(FILES)})(?:\?[^"']{{0,255}}|))"""

_relative = lambda label: rf"""(?:["'(]|^|\s)(//{label}(?:\.{label}){{0,{MOST_LABELS}}}\.[a-zA-Z]{{2,}}[^\s"'<>)]*)"""

DOMAIN, TEMPLATE = "bare_domain", "template_literal"

HTML = (
    Pattern("attr", rf"(?i)(?<![\w:.])(?=[\w:]++\s*+=\s*+{Q}){_attribute}{Q}{_value}{Q}"),
    Pattern("meta_refresh", r"""(?is)<meta[^>]*?url\s*=\s*([^"'#\s>]+)""", needs=(("<meta",), ("url",))),
    Pattern("css_url", r"""(?i)url\(\s*["']?([^"')\s]+)["']?\s*\)""", needs=(("url(",),)),
    Pattern("absolute", r"""(?i)\bhttps?://[^\s"'<>)]+""", 0, needs=(("http://", "https://"),)),
    Pattern("protocol_relative", _relative(QUICK_LABEL), needs=(("//",),)),
    Pattern("source_mapping", r"""(?i)sourceMappingURL\s*=\s*([^\s"'<>]+)""", needs=(("sourcemappingurl",),)),
    Pattern(DOMAIN, rf"(?<![\w.:/])(?=[{LETTER}][{LETTER}_-]*+\.[{LETTER}]){_domain(QUICK_LABEL)}", 0),
)
SCRIPT = (
    _call("fetch", r"fetch\(\s*", "fetch("),
    _call("xhr_open", rf"\.open\(\s*{Q}[A-Za-z]+{Q}\s*,\s*", ".open("),
    _call("import_from", r"(?:import|from)\s+", "import", "from"),
    _call("dynamic_import", r"\bimport\s*\(\s*", "import"),
    _call("require", r"\brequire(?:\.resolve)?\(\s*", "require"),
    _call("location", r"(?:window\.)?location(?:\.href)?\s*=\s*", "location"),
    _call("window_open", r"window\.open\(\s*", "window.open("),
    _call("jquery_ajax", r"\$\.ajax\(\s*\{[^}]*?url\s*:\s*", "$.ajax("),
    _call("jquery_call", r"\$\.(?:get|post|getJSON)\(\s*", "$.get(", "$.post(", "$.getjson("),
    _call("axios", r"axios(?:\.(?:get|post|put|patch|delete|head|request))?\(\s*", "axios"),
    _call("web_socket", r"new\s+WebSocket\(\s*", "websocket("),
    _call("event_source", r"new\s+EventSource\(\s*", "eventsource("),
    _call("beacon", r"navigator\.sendBeacon\(\s*", "navigator.sendbeacon("),
    Pattern(TEMPLATE, r"`([^`]*\$\{[^`]*\}[^`]*)`", 1, True, (("`",), ("${",))),
    Pattern("path_literal", "(?=[#/.])" + START + _path + END, 0, True),
    Pattern("path_ext", START + _path_ext + END, 1, True),
    Pattern("file_ext", START + _file_ext + END, 1, True),
)
PATTERNS = HTML + SCRIPT
BY_NAME = {p.name: p for p in PATTERNS}


def active(javascript: bool) -> tuple[Pattern, ...]:
    return PATTERNS if javascript else HTML
