"""The lists that decide what is a link."""

#: Encoded forms of a character, in the order in which they are decoded (case-insensitive regexes).
ENCODED = (
    (r"&#x2f;|&#0?2f|%2f|\\u002f|\\/", "/"),
    (r"&#x3a;|&#0?3a|%3a|\\u003a", ":"),
    (r"%26|&amp;|&#0?38;|\\u0026", "&"),
    (r"%3d|&equals;|&#0?61;|\\u003d", "="),
    (r"&quot;|&#34;|&#034;|&#x22;|%22|\\u0022", '"'),
    (r"&nbsp;", " "),
)

#: How such forms begin, for each of these characters: where a text has none of them, there is nothing to decode.
ENCODED_STARTS = (
    ("&#", "%2f", "%2F", "\\u", "\\U", "\\/"),
    ("&#", "%3a", "%3A", "\\u", "\\U"),
    ("&#", "%26", "&a", "&A", "\\u", "\\U"),
    ("&#", "%3d", "%3D", "&e", "&E", "\\u", "\\U"),
    ("&#", "%22", "&q", "&Q", "\\u", "\\U"),
    ("&n", "&N"),
)
#: One of these is in every such beginning: a text without any has nothing to decode at all.
ENCODED_SIGNS = ("%", "\\", "&#", "&a", "&A", "&e", "&E", "&q", "&Q", "&n", "&N")

TLDS = (
    "com de net org uk cn ga nl cf ml tk ru br gq xyz fr eu info co au ca it in ch pl es online us top jp biz se at dk cz za me ir "
    "icu shop kr site mx hu io cc club no cyou store local internal lan corp home test localhost localdomain intranet"
).split()

EXCLUDED_SUFFIXES = "call skin menu style rest next top".split()

EXCLUDED_DOMAINS = (
    "this self target value values prop properties proparray useragent rect paddiing style rule bound child global element div "
    "prototype event feature path"
).split()

JUNK_TOKENS = (
    "w3.org schema.org schemas.microsoft.com schemas.openxmlformats.org doubleclick.net facebook twitter instagram linkedin "
    "youtube.com youtu.be google mozilla.org wordpress.org wix.com parastorage.com whatwg.org polyfill typekit.net "
    "openweathermap.org reactjs.org angularjs.org jsdelivr.net newrelic.com optimizely.com cloudflare googleapis gstatic "
    "bootstrap jquery node_modules cdnjs.cloudflare /wp-json /wp-content /wp-includes"
).split()

CONTENT_TYPES = ("html", "javascript", "json", "xml", "css")
JUNK_EXTENSIONS = "png jpe?g gif svg webp ico woff2? ttf eot".split()
DROPPED_SCHEMES = ("javascript:", "data:", "mailto:", "tel:")
DROPPED_STARTS = ("$", "\\", "/=", "-", "...")
MIME_TYPES = ("application", "image", "model", "video", "audio", "text")
SCHEMES = ("http", "https", "ftp", "file")

CHUNK_ABOVE, CHUNK, CHUNK_STEP = 50_000, 40_000, 35_000
LONGEST_LINK, LONGEST_HOST, LONGEST_LABEL = 2000, 253, 63

NOTE = "Discovered via passive link extraction - NOT requested"
NEW_SUBDOMAIN = "[NEW SUBDOMAIN] "
ENTRY_TYPE = "USER"
