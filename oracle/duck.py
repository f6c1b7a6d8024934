"""DuckDB SQL fragments mirroring the library's column functions.

Each builder takes SQL expression text and returns SQL expression text. The
regular expressions and tables are imported from the library itself, so the
oracle checks the Spark plans against an independent engine evaluating the
same rules.
"""

from __future__ import annotations

from corpusforge.functions import analyze as A
from corpusforge.functions import html as H
from corpusforge.functions import ids as I
from corpusforge.functions import text as T
from corpusforge.functions import urls as U
from corpusforge.operators.offsets import JSON_ESCAPES
from corpusforge.plans import standins as S


def q(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def re2(pattern: str) -> str:
    """A pattern without possessive and atomic marks, which RE2 neither has nor needs."""
    return pattern.replace("|=)*?", ")*?").replace("(?>", "(?:").replace("++", "+").replace("*+", "*").replace("?+", "?")


def rx(x: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({x}, {q(re2(pattern))}, {q(repl.replace('$', chr(92)))}, 'g')"


def rx_extract(x: str, pattern: str, group: int) -> str:
    return f"regexp_extract({x}, {q(re2(pattern))}, {group})"


def rx_match(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {q(re2(pattern))})"


def replace_all(x: str, pairs) -> str:
    for a, b in pairs:
        x = f"replace({x}, {q(a)}, {q(b)})"
    return x


def join_list(x: str) -> str:
    return f"array_to_string({x}, ' | ')"


def as_bigint(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def iso_seconds(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S+00:00')"


# ---------------------------------------------------------------- text (C)

def collapse(x: str) -> str:
    return rx(rx(x, T.WS_RUN, " "), T.WS_EDGES, "")


def replacement_count(x: str) -> str:
    return f"(length({x}) - length(replace({x}, {q(T.REPLACEMENT_CHAR)}, '')))"


def replacement_clean(x: str) -> str:
    return (f"CASE WHEN contains({x}, {q(T.REPLACEMENT_CHAR)}) "
            f"THEN {collapse(f'replace({x}, {q(T.REPLACEMENT_CHAR)}, {q(chr(32))})')} ELSE {x} END")


# ----------------------------------------------------------------- ids (B)

def uuid5_hex(name: str) -> str:
    d = f"sha1(unhex({q(I.NAMESPACE_URL_HEX)}) || encode({name}))"
    return (f"(substring({d}, 1, 12) || '5' || substring({d}, 14, 3) || "
            f"translate(substring({d}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || "
            f"substring({d}, 18, 15))")


def b64url22(hex32: str) -> str:
    return f"substring(translate(to_base64(unhex({hex32})), '+/', '-_'), 1, 22)"


def doc_uuid(prefix: str, id_sql: str) -> str:
    return b64url22(uuid5_hex(f"({q(prefix)} || ':' || CAST({id_sql} AS VARCHAR))"))


def _hexf(x: str, width: int) -> str:
    return f"lpad(lower(hex({x})), {width}, '0')"


def index_id_fields(ms: str, pos: str) -> str:
    p32 = f"(CAST({pos} AS BIGINT) & 4294967295)"
    clock = f"({p32} & 65535)"
    return ("(" + " || ".join([
        _hexf(f"(CAST({ms} AS BIGINT) & 4294967295)", 8),
        _hexf(f"((CAST({ms} AS BIGINT) >> 32) & 65535)", 4),
        _hexf(f"((({p32} >> 16) & 16383) | 4096)", 4),
        _hexf(f"((({clock} >> 8) & 63) | 128)", 2),
        _hexf(f"({clock} & 255)", 2),
    ]) + ")")


def month_ms(year: int, month: int) -> str:
    return f"epoch_ms(make_timestamp({year}, {month}, 1, 0, 0, 0))"


# ---------------------------------------------------------------- urls

def url_columns(url: str, prefix: str = "") -> list[str]:
    """Select items ``{prefix}host, {prefix}path, {prefix}query`` (needs a subquery for readability)."""
    u = rx(rx(url, U.LEADING_JUNK, ""), U.UNSAFE_BYTES, "")
    scheme = f"lower({rx_extract(u, U.URL_RE, 1)})"
    netloc = rx_extract(u, U.URL_RE, 2)
    raw_path = rx_extract(u, U.URL_RE, 3)
    query = rx_extract(u, U.URL_RE, 4)
    hostinfo = rx_extract(netloc, r"^(?:.*@)?(.*)$", 1)
    host = (f"CASE WHEN contains({hostinfo}, '[') THEN {rx_extract(hostinfo, chr(92) + '[([^' + chr(92) + ']]*)', 1)} "
            f"ELSE split_part({hostinfo}, ':', 1) END")
    host = f"(lower(split_part({host}, '%', 1)) || {rx_extract(host, '(%.*)$', 1)})"
    schemes = ", ".join(q(s) for s in U.PARAM_SCHEMES)
    path = (f"CASE WHEN {scheme} IN ({schemes}) AND contains({raw_path}, ';') "
            f"THEN {rx(raw_path, U.PARAMS_RE, '$1')} ELSE {raw_path} END")
    null = f"{url} IS NULL"
    return [f"CASE WHEN {null} THEN NULL ELSE nullif({host}, '') END AS {prefix}host",
            f"CASE WHEN {null} THEN NULL ELSE {path} END AS {prefix}path",
            f"CASE WHEN {null} THEN NULL ELSE {query} END AS {prefix}query"]


# ---------------------------------------------------------------- html

def unescape(x: str) -> str:
    from html.entities import html5
    names = [n[:-1] for n in html5 if n.endswith(";")]
    table = f"map([{', '.join(map(q, names))}], [{', '.join(q(html5[n + ';']) for n in names)}])"
    bare = "^(" + "|".join(sorted((n for n in html5 if n[-1] != ";"), key=lambda n: (-len(n), n))) + ")"
    num = r"^#(?:0*([0-9]+)|[xX]0*([0-9a-fA-F]+));?"
    code = (f"coalesce(TRY_CAST(regexp_extract(s, {q(num)}, 1) AS BIGINT), "
            f"TRY_CAST('0x' || regexp_extract(s, {q(num)}, 2) AS BIGINT), 1114112)")  # too many digits: too large
    western = " ".join(f"WHEN {n} THEN {q(bytes([n]).decode('cp1252', 'ignore') or chr(n))}" for n in range(0x80, 0xA0))
    char = (f"CASE {code} WHEN 0 THEN chr(65533) {western} ELSE CASE WHEN {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 "
            f"THEN chr(65533) ELSE chr(CAST({code} AS INT)) END END")
    named = "regexp_extract(s, '^([A-Za-z][A-Za-z0-9]*);', 1)"
    old = f"regexp_extract(s, {q(bare)}, 1)"
    piece = (f"CASE WHEN i = 1 THEN s WHEN regexp_matches(s, {q(num)}) "
             f"THEN {char} || substring(s, length(regexp_extract(s, {q(num)}, 0)) + 1) "
             f"WHEN {table}[{named}] IS NOT NULL THEN {table}[{named}] || substring(s, length({named}) + 2) "
             f"WHEN {old} <> '' THEN {table}[{old}] || substring(s, length({old}) + 1) ELSE '&' || s END")
    return (f"CASE WHEN contains({x}, '&') THEN array_to_string(list_transform(string_split({x}, '&'), "
            f"lambda s, i: {piece}), '') ELSE {x} END")


def squash(x: str) -> str:
    t = f"translate({x}, {q(T.WS_UNICODE_CHARS)}, {q(chr(9) * len(T.WS_UNICODE_CHARS))})"
    return f"trim({rx(t, T.WS_SQUASH, ' ')})"


def _text_steps(x: str) -> str:
    for pattern, repl in H.TEXT_STEPS:
        x = rx(x, pattern, repl)
    return x


def fragment_text(x: str) -> str:
    return squash(unescape(_text_steps(x)))


def element_text(x: str) -> str:
    return collapse(unescape(rx(x, H.ANY_TAG_RE, "")))


def attr(tag: str) -> str:
    return "(" + " || ".join(rx_extract(tag, H.CONTENT_ATTR_RE, g) for g in (1, 2, 3)) + ")"


def nonempty(x: str) -> str:
    return f"nullif({x}, '')"


def html_stage1(html: str) -> str:
    """Cleaned page (comments and raw-text elements removed) -> ``clean``."""
    c = html
    for pattern, repl in H.PRE_STEPS:
        c = rx(c, pattern, repl)
    return c


def html_stage2_items() -> list[str]:
    """From ``clean``: ``has_body_tag, head_part, body_part``."""
    has = rx_match("clean", H.BODY_TAG_RE)
    return [f"{has} AS has_body_tag",
            f"{rx('clean', H.FROM_BODY_RE, '')} AS head_part",
            f"CASE WHEN {has} THEN {rx('clean', H.BEFORE_BODY_RE, '')} "
            f"ELSE {rx(rx('clean', H.HEAD_ELEMENT_RE, ' '), H.TITLE_RE, ' ')} END AS body_part",
            f"{rx_match('clean', H.FRAMESET_RE)} AS has_frames"]


def marked_body() -> str:
    return rx("body_part", H.HEADING_START_RE, "</h0>$1")


def html_title() -> str:
    title_tag = collapse(unescape(rx_extract(rx("clean", H.SVG_RE, " "), H.TITLE_RE, 1)))
    h1 = element_text(rx_extract(marked_body(), H.H1_RE, 1))
    h2 = element_text(rx_extract(marked_body(), H.H2_RE, 1))
    found = rx_extract("body_part", H.TITLE_CLASS_RE, 0)
    tc = (f"(SELECT {element_text('held_html')} FROM (SELECT array_to_string(regexp_split_to_array(rest, pat)[1:coalesce(list_position(levels, 0), len(levels) + 1)], '') AS held_html FROM "
          f"(SELECT rest, pat, list_transform(range(1, len(steps) + 1), lambda i: 1 + list_sum(steps[1:i])) AS levels FROM "
          f"(SELECT rest, pat, list_transform(regexp_extract_all(rest, pat, 1), lambda z: CASE WHEN z = '/' OR tag = 'p' THEN -1 ELSE 1 END) AS steps FROM "
          f"(SELECT tag, {rx('found', H.FIRST_TAG_RE, '')} AS rest, {q(re2(H.OWN_TAGS_RE[0]))} || tag || {q(re2(H.OWN_TAGS_RE[1]))} AS pat FROM "
          f"(SELECT found, lower(regexp_extract(found, {q(H.FIRST_NAME_RE)}, 1)) AS tag FROM (SELECT {found} AS found))))) WHERE rest <> ''))")
    return f"coalesce({nonempty(title_tag)}, {nonempty(h1)}, {nonempty(h2)}, {nonempty(tc)}, '')"


def html_meta_desc() -> str:
    tag = rx_extract("head_part", H.META_DESC_TAG_RE, 0)
    return f"CASE WHEN {tag} = '' THEN '' ELSE {collapse(unescape(attr(tag)))} END"


def html_keyword_content() -> str:
    tag = rx_extract("head_part", H.META_KEYWORDS_TAG_RE, 0)
    return f"CASE WHEN {tag} = '' THEN NULL ELSE {unescape(attr(tag))} END"


def keyword_words(content: str) -> str:
    """All keywords (before de-duplication), or NULL for no element."""
    item = f"lower(substring({collapse('k')}, 1, {H.MAX_KEYWORD_LENGTH}))"
    return f"list_transform(string_split({content}, ','), lambda k: {item})"


def distinct_in_order(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def html_headings() -> str:
    return (f"list_filter(list_transform(regexp_extract_all({marked_body()}, {q(re2(H.heading_re(3)))}, 1), "
            f"lambda h: {element_text('h')}), lambda h: h <> '')")


def html_full_text() -> str:
    return fragment_text("body_part")


def html_main_text() -> str:
    article = rx_extract("body_part", H.ARTICLE_RE, 1)
    return f"CASE WHEN {article} <> '' THEN {fragment_text(article)} ELSE {html_full_text()} END"


def html_lang(html: str) -> str:
    return f"nullif({rx_extract(html, H.HTML_LANG_RE, 1)}, '')"


def injected_pages_sql(source: str = "pages") -> str:
    """Mirror of ``standins.inject_page_features`` as a subquery over ``pages``."""
    pid = "CAST(page_id AS VARCHAR)"
    head_extra = (f"'<meta name=\"description\" content=\"  Page ' || {pid} || ' &amp;  more ' || chr(10) || ' text \">'"
                  f" || '<meta name=\"keywords\" content=\"A, b,a, Key ' || {pid} || ',  x  y ,\">'")
    h = f"CASE WHEN page_id % 4 <> 3 THEN replace(html, '</head>', {head_extra} || '</head>') ELSE html END"
    body_extra = (f"'<article><h2 class=\"sub\"> Part &amp; ' || {pid} || ' </h2><img src=\"a.png\" alt=\"Figure ' "
                  f"|| {pid} || '\"><div class=\"page title\">Shown ' || {pid} || '</div>'")
    hard = (f"'<article><div data-x=\"a>b\" class=\"title\">Outer <div>in ' || {pid} || '</div> tail</div><p title=\"1 > 0\">Hi wor<wbr>d</p>"
            f"<img data-x=\"x alt=no\" alt=\"c > d\">'")
    h = f"replace({h}, '<article>', CASE WHEN page_id % 5 = 2 THEN {hard} ELSE {body_extra} END)"
    h = f"CASE WHEN page_id % 5 = 2 THEN replace({h}, 'name=\"description\"', 'name=\"description\" data-x=\"a>b\"') ELSE {h} END"
    h = f"CASE WHEN page_id % 3 = 0 THEN {rx(h, r'(?s)<title>.*?</title>', '<title> </title>')} ELSE {h} END"
    h = f"CASE WHEN page_id % 6 = 0 THEN {rx(h, r'(?s)<h1>.*?</h1>', '<h1></h1>')} ELSE {h} END"
    return f"(SELECT page_id, url, {h} AS html FROM {source})"


def html_fields_sql(source: str, keep: str = "*") -> str:
    """Subquery with ``clean, has_body_tag, head_part, body_part`` over ``source``."""
    return (f"(SELECT {keep}, {', '.join(html_stage2_items())} FROM "
            f"(SELECT *, {html_stage1('html')} AS clean FROM {source}))")


# ---------------------------------------------------------------- offsets

def json_string(x: str) -> str:
    return f"('\"' || {replace_all(x, JSON_ESCAPES)} || '\"')"


def jsonl_line(id_sql: str, text_sql: str) -> str:
    return (f"('{{' || {json_string(q('docno'))} || ': ' || {json_string(f'CAST({id_sql} AS VARCHAR)')}"
            f" || ', ' || {json_string(q('text'))} || ': ' || {json_string(text_sql)} || '}}')")


def running(value: str, order: str, partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"CAST(sum({value}) OVER ({part}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)"


def plain_offsets_sql() -> str:
    """``(doc_id varchar, start, end)`` of documents in a JSONL file ordered by doc_id."""
    line = jsonl_line("doc_id", "text")
    return (f"(SELECT json_extract_string(line, '$.docno') AS doc_id, \"end\" - b AS start, \"end\" FROM "
            f"(SELECT line, strlen(line) + 1 AS b, {running('strlen(line) + 1', 'doc_id')} AS \"end\" FROM "
            f"(SELECT doc_id, {line} AS line FROM documents)))")


def passage_offsets_sql() -> str:
    pid = "(CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR))"
    line = jsonl_line(pid, "text")
    return (f"(SELECT json_extract_string(line, '$.docno') AS doc_id, \"end\" - b AS start, \"end\" FROM "
            f"(SELECT line, strlen(line) + 1 AS b, {running('strlen(line) + 1', 'conv_id, turn')} AS \"end\" FROM "
            f"(SELECT conv_id, turn, {line} AS line FROM conversations)))")


def plain_docs_sql() -> str:
    url = ("'https://www.' || source || '.example.org/' || lang || '/doc/' || CAST(doc_id AS VARCHAR) || "
           "';v=1?len=' || CAST(n_chars AS VARCHAR) || '#top'")
    return (f"(SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_id AS n, text, "
            f"split_part(text, chr(10), 1) AS title, {url} AS url, lang, source FROM documents)")


def parent_documents_sql() -> str:
    return ("(SELECT CAST(conv_id AS VARCHAR) AS doc_id, split_part(first, chr(10), 1) AS title, "
            "'https://chat.example.org/c/' || CAST(conv_id AS VARCHAR) || '?turns=' || CAST(turns AS VARCHAR) AS url "
            "FROM (SELECT conv_id, arg_min(text, turn) AS first, count(*) AS turns FROM conversations GROUP BY conv_id))")


def web_docs_sql(pages: str = "pages") -> str:
    lang = f"coalesce(nullif({rx_extract('html', H.HTML_LANG_RE, 1)}, ''), 'xx')"
    subdir = f"({lang} || lpad(CAST(page_id // 10000 AS VARCHAR), 4, '0'))"
    file_no = "lpad(CAST((page_id // 100) % 100 AS VARCHAR), 2, '0')"
    doc_no = "lpad(CAST(page_id % 100 AS VARCHAR), 5, '0')"
    return (f"(SELECT 'clueweb22-' || {subdir} || '-' || {file_no} || '-' || {doc_no} AS doc_id, page_id, url, html, "
            f"epoch_ms({S.WEB_EPOCH_MS} + page_id * {S.HOUR_MS}) AS date, "
            f"{lang} || '_' || upper({lang}) AS language, md5(url) AS url_hash, page_id AS record_id, "
            f"'sha1:' || sha1(html) AS payload_digest FROM {pages})")


def web_location_items(doc_id: str = "doc_id") -> list[str]:
    sub = f"split_part({doc_id}, '-', 2)"
    stem = f"(substring({sub}, 1, 4) || '/' || {sub} || '/' || {sub} || '-' || split_part({doc_id}, '-', 3))"
    return [f"{stem} AS stem", f"CAST(split_part({doc_id}, '-', 4) AS BIGINT) AS doc_no"]


def web_line_offsets_sql(web_docs: str) -> str:
    w = "OVER (PARTITION BY stem ORDER BY doc_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (f"(SELECT stem, doc_no, CAST(coalesce(sum(html_bytes) {w}, 0) AS BIGINT) AS html_offset, "
            f"CAST(coalesce(sum(txt_bytes) {w}, 0) AS BIGINT) AS txt_offset FROM "
            f"(SELECT {', '.join(web_location_items())}, strlen(html) + 1 AS html_bytes, "
            f"strlen(url) + strlen(doc_id) + 32 AS txt_bytes FROM {web_docs}))")


# ---------------------------------------------------------------- analyzers (K)

def fold(x: str) -> str:
    return replace_all(f"translate(lower({x}), {q(A.FOLD_FROM)}, {q(A.FOLD_TO)})", A.FOLD_EXTRA)


def words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), {q(A.WORD_RE)}, 0)"


def _drop(t: str, n: int) -> str:
    return f"substring({t}, 1, length({t}) - {n})"


def stem_en(t: str) -> str:
    return (f"CASE WHEN length({t}) < 3 OR NOT ends_with({t}, 's') THEN {t} "
            f"WHEN {rx_match(t, '[us]s$')} THEN {t} "
            f"WHEN {rx_match(t, '[^ae]ies$')} THEN {_drop(t, 3)} || 'y' "
            f"WHEN {rx_match(t, '[iaoe]es$')} THEN {t} ELSE {_drop(t, 1)} END")


def stem_fr(t: str) -> str:
    x = rx(t, A.FR_ENDINGS_RE, "")
    last, prev = f"right({x}, 1)", f"substring(right({x}, 2), 1, 1)"
    x = (f"CASE WHEN length({x}) >= 2 AND {last} = {prev} AND {rx_match(last, r'^\p{L}$')} "
         f"THEN {_drop(x, 1)} ELSE {x} END")
    return (f"CASE WHEN length({t}) < 6 THEN {t} WHEN ends_with({t}, 'aux') THEN {_drop(t, 3)} || 'al' "
            f"WHEN ends_with({t}, 'x') THEN {_drop(t, 1)} ELSE {x} END")


def stem_de(t: str) -> str:
    u = f"translate({t}, 'äöü', 'aou')"
    return (f"CASE WHEN length({t}) < 5 THEN {t} "
            f"WHEN length({u}) > 6 AND ends_with({u}, 'nen') THEN {_drop(u, 3)} "
            f"WHEN length({u}) > 5 AND {rx_match(u, '(en|se|es|er)$')} THEN {_drop(u, 2)} "
            f"WHEN {rx_match(u, '[nsre]$')} THEN {_drop(u, 1)} ELSE {u} END")


def stem_es(t: str) -> str:
    u = f"translate({t}, 'àáâäòóôöèéêëùúûüìíîï', 'aaaaooooeeeeuuuuiiii')"
    return (f"CASE WHEN length({t}) < 5 THEN {t} WHEN {rx_match(u, '[oae]$')} THEN {_drop(u, 1)} "
            f"WHEN ends_with({u}, 'eses') THEN {_drop(u, 2)} "
            f"WHEN ends_with({u}, 'ces') THEN {_drop(u, 3)} || 'z' "
            f"WHEN {rx_match(u, '[oae]s$')} THEN {_drop(u, 2)} ELSE {u} END")


STEMS = {"en": stem_en, "fr": stem_fr, "de": stem_de, "es": stem_es}


def _stage(t: str, stage) -> str:
    if isinstance(stage, tuple):
        return f"translate({t}, {q(stage[0])}, {q(stage[1])})"
    out = "CASE"
    for longer, ending, cut, put in stage:
        if cut is None:
            out += f" WHEN length({t}) > {longer} THEN {rx(rx(rx(t, 'k+', 'k'), 'p+', 'p'), 't+', 't')}"
        else:
            value = t if put == "!" else f"{_drop(t, cut)} || {q(put)}"
            out += f" WHEN length({t}) > {longer} AND {rx_match(t, f'(?:{ending})$')} THEN {value}"
    return f"{out} ELSE {t} END"


def staged_stem(t: str, lang: str) -> str:
    least, stages = A.STAGED_STEMS[lang]
    x = f"[{t}]"
    for stage in stages:
        x = f"list_transform({x}, lambda w: {_stage('w', stage)})"
    return f"CASE WHEN length({t}) < {least} THEN {t} ELSE {x}[1] END"


def language_tokens(x: str, lang: str) -> str:
    toks = words(x)
    if lang == "fr":
        toks = f"list_filter(list_transform({toks}, lambda t: {rx('t', A.ELISION_RE, '')}), lambda t: t <> '')"
    if lang in STEMS:
        toks = f"list_transform({toks}, lambda t: {STEMS[lang]('t')})"
    return f"list_transform({toks}, lambda t: {fold('t')})"


# Words the host analyzer drops.
HOST_STOP_WORDS = (
    "com", "net", "org", "ac", "ad", "ae", "af", "ag", "ai", "al", "am", "an", "ao", "aq", "ar", "as", "at", "au", "aw", "ax", "az",
    "ba", "bb", "bd", "be", "bf", "bg", "bh", "bi", "bj", "bm", "bn", "bo", "br", "bs", "bt", "bv", "bw", "by", "bz", "ca", "cc", "cd",
    "cf", "cg", "ch", "ci", "ck", "cl", "cm", "cn", "co", "cr", "cs", "cu", "cv", "cx", "cy", "cz", "dd", "de", "dj", "dk", "dm", "do",
    "dz", "ec", "ee", "eg", "eh", "er", "es", "et", "eu", "fi", "fj", "fk", "fm", "fo", "fr", "ga", "gb", "gd", "ge", "gf", "gg", "gh",
    "gi", "gl", "gm", "gn", "gp", "gq", "gr", "gs", "gt", "gu", "gw", "gy", "hk", "hm", "hn", "hr", "ht", "hu", "id", "ie", "il", "im",
    "in", "io", "iq", "ir", "is", "it", "je", "jm", "jo", "jp", "ke", "kg", "kh", "ki", "km", "kn", "kp", "kr", "kw", "ky", "kz", "la",
    "lb", "lc", "li", "lk", "lr", "ls", "lt", "lu", "lv", "ly", "ma", "mc", "md", "me", "mg", "mh", "mk", "ml", "mm", "mn", "mo", "mp",
    "mq", "mr", "ms", "mt", "mu", "mv", "mw", "mx", "my", "mz", "na", "nc", "ne", "nf", "ng", "ni", "nl", "no", "np", "nr", "nu", "nz",
    "om", "pa", "pe", "pf", "pg", "ph", "pk", "pl", "pm", "pn", "pr", "ps", "pt", "pw", "py", "qa", "re", "ro", "rs", "ru", "rw", "sa",
    "sb", "sc", "sd", "se", "sg", "sh", "si", "sj", "sk", "sl", "sm", "sn", "so", "sr", "st", "su", "sv", "sy", "sz", "tc", "td", "tf",
    "tg", "th", "tj", "tk", "tl", "tm", "tn", "to", "tp", "tr", "tt", "tv", "tw", "tz", "ua", "ug", "uk", "um", "us", "uy", "uz", "va",
    "vc", "ve", "vg", "vi", "vn", "vu", "wf", "ws", "ye", "yt", "yu", "za", "zm", "zr", "zw",
)


def word_delimiter(t: str) -> str:
    """Original, parts, and for every run of neighbouring parts of one kind its catenation."""
    parts = f"list_filter(regexp_split_to_array({rx(t, chr(91) + chr(39) + '’][sS]([^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]|$)', '$1')}, '[^\\p{{L}}\\p{{N}}]+'), lambda p: p <> '')"
    # a break stands between parts of different kinds, a comma between parts of one kind
    kind = "regexp_matches({}, '^\\p{{L}}')"
    last_kind = kind.format("regexp_extract(x, '[^,|]*$')")
    glued = (f"list_reduce({parts}, lambda x, y: x || CASE WHEN {kind.format('y')} = "
             f"{last_kind} THEN ',' ELSE '|' END || y)")
    runs = (f"list_transform(list_filter(string_split({glued}, '|'), lambda r: contains(r, ',')), "
            f"lambda r: replace(r, ',', ''))")
    return f"CASE WHEN len({parts}) = 0 THEN [{t}] ELSE list_concat([{t}], {parts}, {runs}) END"


def host_tokens(host: str) -> str:
    toks = f"list_filter(regexp_split_to_array({host}, {q(A.WHITESPACE_RE)}), lambda t: t <> '')"
    www = r"^(?:www\d?\.)(.+\..+)$"
    toks = f"list_transform({toks}, lambda t: {rx('t', www, '$1')})"
    toks = f"flatten(list_transform({toks}, lambda t: {word_delimiter('t')}))"
    stops = "[" + ", ".join(q(s) for s in HOST_STOP_WORDS) + "]"
    toks = f"list_filter({toks}, lambda t: NOT list_contains({stops}, t))"
    return f"list_transform({toks}, lambda t: {stem_en('t')})"


def path_tokens(path: str) -> str:
    parts = f"string_split({path}, '/')"
    pre = f"list_transform(range(1, len({parts}) + 1), lambda i: array_to_string({parts}[1:i], '/'))"
    return f"CASE WHEN {path} IS NULL OR {path} = '' THEN []::VARCHAR[] ELSE list_filter({pre}, lambda x: x <> '') END"


def query_tokens(query: str) -> str:
    return f"list_filter(regexp_split_to_array({query}, {q(A.QUERY_SPLIT_RE)}), lambda x: x <> '')"
