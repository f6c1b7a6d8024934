"""Analyzers (K2-K6): token arrays from field values, as native expressions.

Every analyzer is a ``Column -> array<string>`` function made of ``split``,
``regexp_extract_all``, ``transform``, ``filter`` and ``translate``; stems
are regex CASE expressions, so analysis runs inside whole-stage codegen and
needs no vocabulary shuffle. The patterns avoid back-references so the
DuckDB oracle (RE2) evaluates the very same rules.
"""

from __future__ import annotations

import unicodedata
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ------------------------------------------------------------------ folding


def _fold_pairs() -> tuple[str, str]:
    """1:1 accent folding for Latin-1 Supplement and Latin Extended-A, by rule:
    a letter whose canonical decomposition starts with an ASCII letter folds
    to that letter."""
    src, dst = [], []
    for cp in range(0x00C0, 0x0180):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


# Letters without a decomposition that folding still maps,
# one character to one (joined to the rule-built table) or to two.
FOLD_SINGLE = [("ø", "o"), ("đ", "d"), ("ð", "d"), ("ħ", "h"), ("ı", "i"), ("ł", "l"), ("ŧ", "t"), ("ŀ", "l")]
FOLD_EXTRA = [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th")]
_RULE_FROM, _RULE_TO = _fold_pairs()
FOLD_FROM = _RULE_FROM + "".join(a for a, _ in FOLD_SINGLE)
FOLD_TO = _RULE_TO + "".join(b for _, b in FOLD_SINGLE)


def _ascii(c: Column) -> Column:
    """As many bytes as characters: nothing to fold."""
    return F.octet_length(c) == F.length(c)


def fold(c: Column) -> Column:
    """Lower-case and strip accents (normaliser + folding)."""
    c = F.translate(F.lower(c), FOLD_FROM, FOLD_TO)
    for a, b in FOLD_EXTRA:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


# ---------------------------------------------------------------- tokenizers

WORD_RE = r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"
WHITESPACE_RE = r"[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{3000}]+"
DELIMITER_RE = r"[^\p{L}\p{N}]+"
# What the host analyzer captures, and the English possessive it drops.
HOST_PREFIX_RE = r"^(?:www\d?\.)(.+\..+)$"
POSSESSIVE_RE = r"['’][sS]([^\p{L}\p{N}]|$)"
QUERY_SPLIT_RE = r"[&=]"
# French elided articles.
ELISION_RE = r"^(?:l|m|t|qu|n|s|j|d|c|jusqu|quoiqu|lorsqu|puisqu)['’]"
# Words the host analyzer drops, generic names and country codes.
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


def words(c: Column) -> Column:
    """Word tokens of lower-cased text (letters/digits, inner apostrophes kept)."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD_RE), 0)


# ------------------------------------------------------------------ stemmers


def _len(t: Column) -> Column:
    return F.length(t)


def _drop(t: Column, n: int) -> Column:
    return F.substring(t, 1, _len(t) - n) if n else t


def _last(t: Column, n: int = 1) -> Column:
    """The n-th character from the end."""
    return F.substring(t, -n, 1)


def stem_en(t: Column) -> Column:
    """Minimal English plural stemmer (suffix tests without regex)."""
    return (F.when((_len(t) < 3) | ~t.endswith("s"), t)
             .when(t.endswith("us") | t.endswith("ss"), t)
             .when(t.endswith("ies") & (_len(t) > 3) & ~_last(t, 4).isin("a", "e"),
                   F.concat(_drop(t, 3), F.lit("y")))
             .when(t.endswith("es") & _last(t, 3).isin("i", "a", "o", "e"), t)
             .otherwise(_drop(t, 1)))


# Sequential optional strips of final s, r, e, é equal removing the longest
# suffix of this form; its ways by length, longest first.
FR_ENDINGS_RE = "é?e?r?s?$"
FR_ENDINGS = {4: ("éers",), 3: ("ers", "érs", "ées", "éer"), 2: ("rs", "es", "er", "és", "ér", "ée"), 1: ("s", "r", "e", "é")}


def stem_fr(t: Column) -> Column:
    """Minimal French stemmer: plural and a few inflection endings."""
    cut = None
    for n, endings in FR_ENDINGS.items():
        fits = F.substring(t, -n, n).isin(*endings)
        cut = F.when(fits, n) if cut is None else cut.when(fits, n)
    k = _len(t) - cut.otherwise(0)  # of six characters or more, so at least two are left
    last = F.substring(t, k, F.lit(1))
    double = (last == F.substring(t, k - 1, F.lit(1))) & last.rlike(r"^\p{L}$")
    return (F.when(_len(t) < 6, t)
             .when(t.endswith("aux"), F.concat(_drop(t, 3), F.lit("al")))
             .when(t.endswith("x"), _drop(t, 1))
             .otherwise(F.substring(t, F.lit(1), k - F.when(double, 1).otherwise(0))))


def stem_de(t: Column) -> Column:
    """Minimal German stemmer: umlauts, then plural/case endings (which no umlaut touches)."""
    x = (F.when((_len(t) > 6) & t.endswith("nen"), _drop(t, 3))
          .when((_len(t) > 5) & F.substring(t, -2, 2).isin("en", "se", "es", "er"), _drop(t, 2))
          .when(_last(t).isin("n", "s", "r", "e"), _drop(t, 1))
          .otherwise(t))
    return F.when(_len(t) < 5, t).when(_ascii(t), x).otherwise(F.translate(x, "äöü", "aou"))


ES_ACCENTS = ("àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii")


def stem_es(t: Column) -> Column:
    """Light Spanish stemmer: accents, then gender/plural endings."""
    end = F.translate(F.substring(t, -4, 4), *ES_ACCENTS)
    x = (F.when(_last(t).isin(*"oaeòóôöàáâäèéêë"), _drop(t, 1))
          .when(~t.endswith("s"), t)
          .when(end == "eses", _drop(t, 2))
          .when(end.endswith("ces"), F.concat(_drop(t, 3), F.lit("z")))
          .when(_last(end, 2).isin("o", "a", "e"), _drop(t, 2))
          .otherwise(t))
    return F.when(_len(t) < 5, t).when(_ascii(t), x).otherwise(F.translate(x, *ES_ACCENTS))


# Published light stemmers as stages, each a character map (from, to) or
# a list of rules (longer than, ending, characters cut, characters put in their place),
# of which the first that fits applies. The number before the stages is the length below
# which a word stays as it is.
_HU_VOWEL, _HU_OTHER = "[aeiouy]", "[^aeiouy]"
STAGED_STEMS = {
    "it": (6, [
        ("àáâäòóôöèéêëùúûüìíîï", "aaaaooooeeeeuuuuiiii"),
        [(5, "[hi][ei]|i[ao]", 2, ""), (5, "[aeio]", 1, "")],
    ]),
    "pt": (3, [
        [(2, "^(?:cais|mais|lápis|crúcis|biquínis|pois|depois|dois|leis|árvores)", 0, "!"),
         (2, "ns", 2, "m"), (5, "ões", 3, "ão"), (3, "ães", 3, "ão"), (3, "ais", 3, "al"), (4, "éis|eis", 3, "el"), (4, "óis", 3, "ol"),
         (3, "is", 2, "il"), (5, "les", 3, "l"), (5, "res", 3, "r"),
         (2, "^(?:aliás|pires|mas|menos|férias|fezes|pêsames|gás|atrás|moisés|através|convés|ês|país|após|ambas|ambos|messias)", 0, "!"),
         (2, "s", 1, "")],
    ]),
    "sv": (0, [
        [(4, "s", 1, "")],
        [(7, "elser|heten", 5, ""), (6, "arne|erna|ande|else|aste|orna|aren", 4, ""), (5, "are|ast|het", 3, ""),
         (4, "ar|er|or|en|at|te|et", 2, ""), (3, "[taen]", 1, "")],
    ]),
    "ru": (0, [
        [(6, "иями|оями", 4, ""), (5, "иям|иях|оях|ями|оям|оьв|ами|его|ему|ери|ими|ого|ому|ыми|оев", 3, ""),
         (4, "ая|яя|ях|юю|ах|ею|их|ия|ию|ьв|ою|ую|ям|ых|ея|ам|ем|ей|ём|ев|ий|им|ое|ой|ом|ов|ые|ый|ым|ми", 2, ""),
         (3, "[аеиоуйыья]", 1, "")],
        [(3, "[ьи]", 1, ""), (3, "нн", 1, "")],
    ]),
    "hu": (0, [
        ("áëéíóőõöúűũûü", "aeeioooouuuuu"),
        [(6, "kent", 4, ""), (5, "nak|nek|val|vel|ert|rol|ban|ben|bol|nal|nel|hoz|hez|tol", 3, ""),
         (5, "(?:" + "|".join(2 * c for c in "bcdfghjklmnpqrstvwxz") + ")[ae]l", 3, ""),
         (4, "at|et|ot|va|ve|ra|re|ba|be|ul|ig", 2, ""), (4, _HU_OTHER + "(?:on|en)", 2, ""), (4, "[tn]", 1, ""),
         (4, "(?:" + "|".join(2 * c for c in "bcdfghjklmnpqrstvwxz") + ")[ae]", 2, "")],
        [(6, _HU_OTHER + "(?:atok|otok|etek)|itek|itok", 4, ""), (5, _HU_OTHER + "(?:unk|tok|tek)|" + _HU_VOWEL + "juk|ink", 3, ""),
         (4, _HU_OTHER + "(?:am|em|om|ad|ed|od|uk)|" + _HU_VOWEL + "(?:nk|ja|je)|im|id|ik", 2, ""),
         (3, _HU_OTHER + "[ae]|" + _HU_VOWEL + "[md]|i", 1, "")],
        [(4, "[aoe]k", 2, ""), (3, "k", 1, "")],
        [(3, "[aeio]", 1, "")],
    ]),
    "fi": (4, [
        ("äåö", "aao"),
        [(8, "kin", 3, ""), (8, "ko", 2, ""), (11, "dellinen", 8, ""), (11, "dellisuus", 9, "")],
        [(8, "kin", 3, ""), (8, "ko", 2, ""), (11, "dellinen", 8, ""), (11, "dellisuus", 9, "")],
        [(5, "lla|tse|sti", 3, ""), (5, "ni", 2, ""), (5, "aa", 1, "")],
        [(8, "nnen", 4, "s"), (8, "ntena", 5, "s"), (8, "tten", 4, ""), (8, "eiden", 5, ""),
         (6, "neen|niin|seen|teen|inen", 4, ""), (6, "h[aeiouy]n", 3, ""), (6, "den", 3, "s"), (6, "ksen", 4, "s"),
         (6, "ssa|sta|lla|lta|tta|ksi|lle", 3, ""), (5, "na|ne", 2, ""), (5, "nei", 3, ""),
         (4, "ja|ta", 2, ""), (4, "a", 1, ""), (4, "[aeiouy]n", 2, ""), (4, "n", 1, "")],
        [(5, "hde", 3, "ksi")],
        [(4, "ei|at", 2, ""), (3, "[tsjaei]", 1, "")],
        [(8, "[eou]", 1, "")],
        [(4, "i", 1, "")],
        [(4, "kk+|pp+|tt+", None, "")],  # doubled consonants anywhere
    ]),
}


def _stage(t: Column, stage) -> Column:
    if isinstance(stage, tuple):
        return F.translate(t, *stage)
    out = None
    for longer, ending, cut, put in stage:
        if cut is None:
            single = t
            for c in "kpt":
                single = F.regexp_replace(single, c + "+", c)
            value, fits = single, _len(t) > longer
        else:
            value = t if put == "!" else F.concat(_drop(t, cut), F.lit(put))  # a word that stays
            fits = (_len(t) > longer) & t.rlike(f"(?:{ending})$")
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out.otherwise(t)


def staged_stem(t: Column, lang: str) -> Column:
    """A word through the stages of a language; for distinct words (``vocabulary``), as lambdas keep a stage's value."""
    least, stages = STAGED_STEMS[lang]

    def applied(stage):
        return lambda w: _stage(w, stage)
    x = F.array(t)
    for stage in stages:
        x = F.transform(x, applied(stage))
    return F.when(_len(t) < least, t).otherwise(F.element_at(x, 1))


STEMMERS = {"en": stem_en, "fr": stem_fr, "de": stem_de, "es": stem_es,
            **{lang: partial(staged_stem, lang=lang) for lang in STAGED_STEMS}}


# ----------------------------------------------------------------- analyzers


def _elided(word: Column) -> Column:
    """A French word without its elided article; words without apostrophe skip the pattern."""
    return F.when(word.contains("'") | word.contains("’"), F.regexp_replace(word, ELISION_RE, "")).otherwise(word)


def language_term(word: Column, lang: str) -> Column:
    """One word through a language's filters: [elision] -> [stem] -> fold.

    A plain column expression: applied after ``explode`` it runs in
    generated code, one word per row.
    """
    t = word
    if lang == "fr":
        t = _elided(t)
    stem = STEMMERS.get(lang)
    if stem is not None:
        t = stem(t)
    return fold(t)


def _language_stem(word: Column, lang: str) -> Column:
    """A language's filters before folding: [elision] -> [stem]."""
    t = _elided(word) if lang == "fr" else word
    stem = STEMMERS.get(lang)
    return stem(t) if stem is not None else t


def term_for_language(word: Column, lang_col: Column, languages=("en", "fr", "de", "es")) -> Column:
    """Each word through its own row's language filters (default: fold only).

    Folding ends every chain, so it is applied once around the per-language
    choice; the expression (and its generated code) stays small.
    """
    expr = None
    for lang in languages:
        branch = _language_stem(word, lang)
        expr = F.when(lang_col == lang, branch) if expr is None else expr.when(lang_col == lang, branch)
    return fold(word if expr is None else expr.otherwise(word))


def with_terms(words: DataFrame, languages=("en", "fr", "de", "es"), word: str = "word", lang_col: str = "lang") -> DataFrame:
    """``words`` with ``term``: ``term_for_language`` a step at a time, for large tables.

    Each step is a projection, so its generated code is a method of its own,
    small enough to be compiled, and a stem is made once however often the
    next step names it. ASCII stems are only lowered.
    """
    out = words.withColumn("term", F.col(word))
    if "fr" in languages:
        out = out.withColumn("term", F.when(F.col(lang_col) == "fr", _elided(F.col("term"))).otherwise(F.col("term")))
    for lang in (x for x in languages if x in STEMMERS):
        out = out.withColumn("term", F.when(F.col(lang_col) == lang, STEMMERS[lang](F.col("term"))).otherwise(F.col("term")))
    folded = F.when(_ascii(F.col("term")), F.lower("term")).otherwise(fold(F.col("term")))
    # Through an array of one: a filter on the term (as a join adds) would else be pushed down through all steps, written out at each.
    return out.select(*words.columns, F.explode_outer(F.array(folded)).alias("term"))


CJK_WORD_RE = r"^[\p{IsHangul}\p{IsHan}\p{IsHiragana}\p{IsKatakana}]{2,}$"
# Languages analysed by overlapping character bigrams of CJK runs.
BIGRAM_LANGUAGES = ("ko",)


def cjk_bigrams(c: Column) -> Column:
    """CJK analyzer (ko): words of two or more CJK characters become their
    overlapping bigrams, other words stay whole; then folding."""
    def per_word(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, 2))
        return F.when(w.rlike(CJK_WORD_RE), grams).otherwise(F.array(w))
    return F.transform(F.flatten(F.transform(words(c), per_word)), fold)


def language_tokens(c: Column, lang: str) -> Column:
    """Token array of a ``*_lang_<lang>`` field (K5)."""
    if lang in BIGRAM_LANGUAGES:
        return cjk_bigrams(c)
    toks = F.transform(words(c), lambda w: language_term(w, lang))
    return F.filter(toks, lambda t: t != "") if lang == "fr" else toks


def tokens_for_language(c: Column, lang_col: Column, languages=("en", "fr", "de", "es")) -> Column:
    """Analyse each row with its own language's analyzer (default: fold only)."""
    expr = None
    for lang in languages:
        branch = language_tokens(c, lang)
        expr = F.when(lang_col == lang, branch) if expr is None else expr.when(lang_col == lang, branch)
    default = language_tokens(c, "default")
    return default if expr is None else expr.otherwise(default)


def keyword_lower(c: Column) -> Column:
    """The whole value, lower-cased and folded (K6)."""
    return fold(c)


def _word_delimiter(t: Column) -> Column:
    """Original token, its alphanumeric parts, and each run of two or more
    neighbouring word parts (or number parts, by first character) catenated."""
    bare = F.regexp_replace(t, POSSESSIVE_RE, "$1")
    parts = F.filter(F.split(bare, DELIMITER_RE, -1), lambda p: p != "")
    tagged = F.array_join(F.transform(parts, lambda p: F.concat(
        F.when(p.rlike(r"^\p{L}"), F.lit(" w")).otherwise(F.lit(" n")), p)), "")

    def runs(tag: str) -> Column:
        return F.transform(F.regexp_extract_all(tagged, F.lit(f"(?:{tag}[^ ]+){{2,}}"), 0),
                           lambda r: F.replace(r, F.lit(tag), F.lit("")))

    return F.concat(F.array(t), parts, runs(" w"), runs(" n"))


def host_tokens(host: Column, stop_words=HOST_STOP_WORDS) -> Column:
    """Host analyzer (K2): whitespace split, ``www.`` capture, word delimiter,
    stop words, minimal English stem, unique."""
    toks = F.filter(F.split(host, WHITESPACE_RE, -1), lambda t: t != "")
    toks = F.transform(toks, lambda t: F.regexp_replace(t, HOST_PREFIX_RE, "$1"))
    toks = F.flatten(F.transform(toks, _word_delimiter))
    toks = F.filter(toks, lambda t: ~t.isin(*stop_words))
    return F.array_distinct(F.transform(toks, stem_en))


def path_tokens(path: Column) -> Column:
    """Path hierarchy (K3): ``/a/b`` -> ``/a``, ``/a/b``."""
    parts = F.split(path, "/", -1)
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)),
                           lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.when(path.isNull() | (path == ""), F.array().cast("array<string>")).otherwise(
        F.filter(prefixes, lambda x: x != ""))


def query_tokens(query: Column) -> Column:
    """Query-string tokens (K4): split on ``&`` and ``=``, empties dropped."""
    return F.filter(F.split(query, QUERY_SPLIT_RE, -1), lambda x: x != "")
