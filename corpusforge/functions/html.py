"""HTML fields (C2-C6, D3) from one pass over the page column.

No HTML parser runs per row: the extraction is a fixed chain of native
regular-expression rewrites, so it stays inside whole-stage codegen and
scales with the scan. Every pattern avoids look-around and back-references,
so Java regex and RE2 agree on it and the DuckDB oracle replays the same
chain (``STEPS`` and tables below are data, shared by both sides).

A tag is read as a parser reads it: names and attributes up to the ``>`` that
no quoted value holds, so a ``>`` or an attribute's name inside a value does
not count. Patterns are possessive or atomic where nothing may be given back,
which keeps them linear in Java; RE2, which is linear anyway, takes them
without these marks.

The text is a documented near equivalent of a DOM text extractor:
comments, ``script/style/noscript/template`` and the head are dropped,
``<img alt>`` texts are kept, inline tags vanish, other tags become a space,
all character references are decoded in one pass and white space is
collapsed. The element of class ``title`` ends at its own end tag: the tags of
its name that follow are counted.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import REPLACEMENT_CHAR, WS_SQUASH, WS_UNICODE_CHARS, collapse_whitespace

#: What a tag holds after its name, up to its ``>``: quoted values count as a whole.
ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>])|=\s*+)*+"""
#: The same, attribute by attribute, up to the white space before a wanted one.
BEFORE_ATTR = r"""(?>[^\s>=]++|\s|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>])|=)*?"""
#: An attribute's value in double, single or no quotes: one of three groups.
ATTR_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""


def open_tag(name: str) -> str:
    return rf"<{name}(?:[\s/]{ATTRS})?>"


# Patterns of the extraction chain. ``\z`` closes what a page leaves open.
COMMENT_RE = r"(?s)<!--.*?(?:-->|\z)"
RAW_TEXT_RE = "(?is)" + "|".join(rf"{open_tag(n)}.*?(?:</{n}(?:[\s/]{ATTRS})?>|\z)" for n in ("script", "style", "noscript", "template"))
BODY_TAG_RE = "(?is)" + open_tag("body")
FRAMESET_RE = "(?is)" + open_tag("frameset")
BEFORE_BODY_RE = "(?is)^.*?" + open_tag("body")
HEAD_ELEMENT_RE = rf"(?is){open_tag('head')}.*?</head\s*>"
FROM_BODY_RE = r"(?is)<body\b.*$"
SVG_RE = rf"(?is){open_tag('svg')}.*?(?:</svg\s*>|\z)"
IMG_ALT_RE = rf"(?is)<img\b{BEFORE_ATTR}\salt{ATTR_VALUE}{ATTRS}>"
INLINE_TAG_RE = (r"(?i)</?(?:a|abbr|b|bdi|bdo|cite|code|data|dfn|em|font|i|kbd|mark|q|s|"
                 rf"samp|small|span|strong|sub|sup|time|u|var|wbr)(?:[\s/]{ATTRS})?>")
ANY_TAG_RE = rf"(?s)</?[A-Za-z]{ATTRS}(?:>|\z)|<[!?][^>]*>|</[^A-Za-z>][^>]*>"
TITLE_RE = rf"(?is){open_tag('title')}(.*?)</title\s*>"
# A heading ends at any heading's end tag, or where the next one starts (marked ``</h0>``).
HEADING_START_RE = r"(?i)(<h[1-6][\s>])"
HEADING_END_RE = r"(?:</h[0-6]\s*>|\z)"
H1_RE = rf"(?is){open_tag('h1')}(.*?)" + HEADING_END_RE
H2_RE = rf"(?is){open_tag('h2')}(.*?)" + HEADING_END_RE
# The tag of the first element of class ``title`` and all that follows.
TITLE_CLASS_RE = (rf"(?is)<[a-z][a-z0-9]*{BEFORE_ATTR}\sclass\s*=\s*"
                  rf"""(?:"(?:[^"]*\s)?title(?:\s[^"]*)?"{ATTRS}|'(?:[^']*\s)?title(?:\s[^']*)?'{ATTRS}|"""
                  rf"title(?:[\s/]{ATTRS})?)>.*$")
FIRST_NAME_RE = r"^<([A-Za-z0-9]+)"
FIRST_TAG_RE = rf"(?s)^<[A-Za-z]{ATTRS}>"
CONTENT_ATTR_RE = rf"(?is)^<meta{BEFORE_ATTR}\scontent{ATTR_VALUE}"
HTML_LANG_RE = r"""(?is)<html\b[^>]*\slang\s*=\s*["']?([A-Za-z_\-]+)"""
ARTICLE_RE = rf"(?is){open_tag('article')}(.*)</article\s*>"
#: Around a name: its start and end tags; the group is the end tag's slash.
OWN_TAGS_RE = ("(?is)<(/?)", rf"(?:[\s/]{ATTRS})?>")


def meta_tag_re(name: str) -> str:
    """The first ``<meta>`` tag of a name, in any quoting."""
    return (rf"(?is)<meta{BEFORE_ATTR}\sname\s*=\s*(?:\"{name}\"{ATTRS}|'{name}'{ATTRS}|"
            rf"{name}(?:[\s/]{ATTRS})?)>")


def heading_re(max_level: int) -> str:
    return rf"(?is){open_tag(f'h[1-{max_level}]')}(.*?)" + HEADING_END_RE


META_DESC_TAG_RE = meta_tag_re("description")
META_KEYWORDS_TAG_RE = meta_tag_re("keywords")

# Character references, from the standard library's table: names closed by a
# semicolon, and the old ones that are also read without it (longest first).
NAMED_REFERENCES = {n[:-1]: c for n, c in html5.items() if n.endswith(";")}
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
# The characters that bytes 128 to 159 stand for; the five without one stay control characters.
WESTERN_80_9F = "".join(bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0))
NUMERIC_REF_RE = r"^#(?:0*([0-9]+)|[xX]0*([0-9a-fA-F]+));?"
NAMED_REF_RE = r"^([A-Za-z][A-Za-z0-9]*);"
BARE_REF_RE = "^(" + "|".join(BARE_NAMES) + ")"

MAX_KEYWORD_LENGTH = 80
MAX_KEYWORDS = 30
MAX_HEADING_LEVEL = 3

# Rewrites applied to the page before tags are stripped: (pattern, replacement).
PRE_STEPS = [(COMMENT_RE, " "), (RAW_TEXT_RE, " ")]
# Rewrites that turn an HTML fragment into text.
TEXT_STEPS = [(IMG_ALT_RE, " $1$2$3 "), (INLINE_TAG_RE, ""), (ANY_TAG_RE, " ")]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code_point(n: Column) -> Column:
    """The character of a numeric reference, as HTML reads it: bytes 128 to 159
    as Windows-1252, no character (zero, surrogates, too large) as U+FFFD."""
    utf32 = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when((n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit(REPLACEMENT_CHAR))
             .when(n.between(0x80, 0x9F), F.substring(F.lit(WESTERN_80_9F), n - 0x7F, F.lit(1)))
             .otherwise(utf32))


def unescape(c) -> Column:
    """Decode character references in one pass (a decoded '&' is never re-read).

    The text is split at '&'; every piece after the first may start with a
    number, a name with a semicolon, or one of the old names without it.
    Values without '&' are returned as they are.
    """
    # Both lists as one string each: Catalyst folds them to a map literal.
    table = F.map_from_arrays(*[F.split(F.lit("\x01".join(x)), "\x01") for x in (NAMED_REFERENCES, NAMED_REFERENCES.values())])

    def rest(s: Column, used: Column) -> Column:
        return s.substr(used + 1, F.length(s))

    def digits(found: Column, keep: int) -> Column:
        """At most as many digits as tell a character from what is too large to be one."""
        return F.when(F.length(found) > keep, F.lit("9" * keep)).otherwise(found)

    def piece(s: Column, i: Column) -> Column:
        dec, hexa = F.regexp_extract(s, NUMERIC_REF_RE, 1), F.regexp_extract(s, NUMERIC_REF_RE, 2)
        number = F.when(dec != "", digits(dec, 8).cast("bigint")).otherwise(F.conv(digits(hexa, 7), 16, 10).cast("bigint"))
        numeric = F.when((dec != "") | (hexa != ""),
                         F.concat(_code_point(number), rest(s, F.length(F.regexp_extract(s, NUMERIC_REF_RE, 0)))))
        # A null means that the step did not apply, so each name is looked up once.
        named = F.concat(F.try_element_at(table, F.regexp_extract(s, NAMED_REF_RE, 1)), rest(s, F.length(F.substring_index(s, ";", 1)) + 1))
        bare = F.regexp_extract(s, BARE_REF_RE, 1)
        old = F.when(bare != "", F.concat(F.try_element_at(table, bare), rest(s, F.length(bare))))
        as_is = F.concat(F.lit("&"), s)
        return (F.when(i == 0, s).when(F.startswith(s, F.lit("#")), F.coalesce(numeric, as_is))
                 .otherwise(F.coalesce(named, old, as_is)))

    def decoded(text: Column) -> Column:
        parts = F.transform(F.split(text, "&", -1), piece)
        return F.when(F.contains(text, F.lit("&")), F.array_join(parts, "")).otherwise(text)

    # A lambda's variable names the value, so that its expression stands in the plan once.
    return F.element_at(F.transform(F.array(_col(c)), decoded), 1)


def squash(c) -> Column:
    """All white space to single spaces, trimmed (text without formatting).

    Only runs of two or more and lone non-space characters are rewritten,
    so the common single space between words costs no replacement.
    """
    ascii_ws = F.translate(_col(c), WS_UNICODE_CHARS, "\t" * len(WS_UNICODE_CHARS))
    return F.trim(F.regexp_replace(ascii_ws, WS_SQUASH, " "))


def _strip_tags(c: Column) -> Column:
    for pattern, repl in TEXT_STEPS:
        c = F.regexp_replace(c, pattern, repl)
    return c


def fragment_text(fragment) -> Column:
    """Plain text of an HTML fragment (tags out, entities decoded, squashed)."""
    return squash(unescape(_strip_tags(_col(fragment))))


def element_text(fragment) -> Column:
    """Text nodes of one element's inner HTML, collapsed."""
    return collapse_whitespace(unescape(F.regexp_replace(_col(fragment), ANY_TAG_RE, "")))


def inner_html(rest: Column, name: Column) -> Column:
    """What an element holds, without tags of its own name: ``rest`` follows its start tag.

    A start tag of the name goes a level down and an end tag a level up; the
    element ends where the level comes to zero, or with the page. A paragraph
    ends where the next one starts.
    """
    pattern = F.concat(F.lit(OWN_TAGS_RE[0]), name, F.lit(OWN_TAGS_RE[1]))
    step = lambda slash: F.when((slash == "/") | (name == "p"), F.lit(-1)).otherwise(F.lit(1))
    state = F.aggregate(F.regexp_extract_all(rest, pattern, 1), F.struct(F.lit(1).alias("level"), F.lit(0).alias("n")),
                        lambda a, slash: F.when(a["level"] == 0, a).otherwise(
                            F.struct((a["level"] + step(slash)).alias("level"), (a["n"] + 1).alias("n"))))
    pieces = F.split(rest, pattern, -1)
    ended = F.array_join(F.slice(pieces, F.lit(1), state["n"]), "")
    return F.when(name == "", F.lit("")).when(state["level"] == 0, ended).otherwise(F.array_join(pieces, ""))


def _attr(tag: Column, pattern: str) -> Column:
    """The value of an attribute in any quoting, undecoded."""
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def _nonempty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def meta_keywords(content: Column, max_keyword_length: int = MAX_KEYWORD_LENGTH,
                  max_keywords: int = MAX_KEYWORDS) -> Column:
    """Keyword list from a ``content`` attribute (C4); null attribute -> []."""
    words = F.transform(F.split(content, ",", -1),
                        lambda k: F.lower(F.substring(collapse_whitespace(k), 1, max_keyword_length)))
    return F.when(content.isNull(), F.array().cast("array<string>")).otherwise(
        F.slice(F.array_distinct(words), 1, max_keywords))


def extract_html_fields(df: DataFrame, html: str = "html", prefix: str = "",
                        max_keyword_length: int = MAX_KEYWORD_LENGTH, max_keywords: int = MAX_KEYWORDS,
                        max_heading_level: int = MAX_HEADING_LEVEL) -> DataFrame:
    """Add the page fields derived from column ``html``.

    Adds ``has_body, title, meta_desc, meta_keywords, headings, full_text,
    main_text, html_lang`` (each name with ``prefix``). The work is staged
    in projections (cleaned page -> head/body -> raw fragments -> fields) so
    each intermediate is evaluated once per row. Every page has a body, with
    or without its tag, unless it is a frameset.
    """
    p = prefix
    t = f"__h{p}"
    cleaned = F.col(html)
    for pattern, repl in PRE_STEPS:
        cleaned = F.regexp_replace(cleaned, pattern, repl)
    out = df.withColumn(t + "clean", cleaned)
    c = F.col(t + "clean")
    out = out.withColumns({t + "hasbody": c.rlike(BODY_TAG_RE), t + "frames": c.rlike(FRAMESET_RE)})
    out = out.withColumns({
        t + "head": F.regexp_replace(c, FROM_BODY_RE, ""),
        t + "body": F.when(F.col(t + "hasbody"), F.regexp_replace(c, BEFORE_BODY_RE, ""))
                     .otherwise(F.regexp_replace(F.regexp_replace(c, HEAD_ELEMENT_RE, " "), TITLE_RE, " ")),
    })
    head, body = F.col(t + "head"), F.col(t + "body")
    out = out.withColumn(t + "marked", F.regexp_replace(body, HEADING_START_RE, "</h0>$1"))
    marked = F.col(t + "marked")
    out = out.withColumns({
        t + "title": F.regexp_extract(F.regexp_replace(c, SVG_RE, " "), TITLE_RE, 1),
        t + "h1": F.regexp_extract(marked, H1_RE, 1),
        t + "h2": F.regexp_extract(marked, H2_RE, 1),
        t + "tc": F.regexp_extract(body, TITLE_CLASS_RE, 0),
        t + "desc": F.regexp_extract(head, META_DESC_TAG_RE, 0),
        t + "kw": F.regexp_extract(head, META_KEYWORDS_TAG_RE, 0),
        t + "article": F.regexp_extract(body, ARTICLE_RE, 1),
        t + "headings": F.regexp_extract_all(marked, F.lit(heading_re(max_heading_level)), 1),
    })
    out = out.withColumns({t + "tn": F.lower(F.regexp_extract(F.col(t + "tc"), FIRST_NAME_RE, 1)),
                           t + "tr": F.regexp_replace(F.col(t + "tc"), FIRST_TAG_RE, "")})
    title_class = inner_html(F.col(t + "tr"), F.col(t + "tn"))
    # Texts of their own stage: each is used more than once below.
    out = out.withColumns({
        t + "x0": collapse_whitespace(unescape(F.col(t + "title"))),
        t + "x1": element_text(F.col(t + "h1")),
        t + "x2": element_text(F.col(t + "h2")),
        t + "x3": element_text(title_class),
        t + "xd": collapse_whitespace(unescape(_attr(F.col(t + "desc"), CONTENT_ATTR_RE))),
        t + "xk": F.when(F.col(t + "kw") != "", unescape(_attr(F.col(t + "kw"), CONTENT_ATTR_RE))),
        t + "full": fragment_text(body),
    })
    title = F.coalesce(*[_nonempty(F.col(t + x)) for x in ("x0", "x1", "x2", "x3")], F.lit(""))
    headings = F.filter(F.transform(F.col(t + "headings"), lambda h: element_text(h)),
                        lambda h: h != "")
    out = out.withColumns({
        f"{p}has_body": F.col(html).isNotNull() & (F.col(t + "hasbody") | ~F.col(t + "frames")),
        f"{p}title": title,
        f"{p}meta_desc": F.col(t + "xd"),
        f"{p}meta_keywords": meta_keywords(F.col(t + "xk"), max_keyword_length, max_keywords),
        f"{p}headings": headings,
        f"{p}full_text": F.col(t + "full"),
        f"{p}html_lang": F.nullif(F.regexp_extract(F.col(html), HTML_LANG_RE, 1), F.lit("")),
    })
    article = F.col(t + "article")
    out = out.withColumn(f"{p}main_text", F.when(article != "", fragment_text(article))
                         .otherwise(F.col(f"{p}full_text")))
    return out.drop(*[t + x for x in ("clean", "hasbody", "frames", "head", "body", "marked", "title", "h1", "h2", "tc", "tn", "tr",
                                      "desc", "kw", "article", "headings", "x0", "x1", "x2", "x3", "xd", "xk", "full")])
