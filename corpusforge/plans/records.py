"""Meta and data record schemas and their written form.

A mapping produces one frame with the index key ``_id`` plus every meta
field (prefixed ``m_``) and data field (prefixed ``d_``); ``meta_table`` and
``data_table`` project it into the two tables with their fixed schemas
(fields a corpus leaves out are typed nulls).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType,
                               TimestampType)

S, L, T, A = StringType(), LongType(), TimestampType(), ArrayType(StringType())

# Record fields and their types.
META_FIELDS = [
    ("uuid", S), ("source_file", S), ("source_offset", L), ("warc_type", S),
    ("warc_target_uri", S), ("warc_target_uri_hash", S), ("warc_warcinfo_id", S),
    ("warc_date", T), ("warc_record_id", S), ("warc_trec_id", S),
    ("warc_identified_payload_type", S), ("warc_payload_digest", S), ("warc_block_digest", S),
    ("warc_ip_address", S), ("content_type", S), ("content_length", L), ("http_date", T),
    ("http_content_length", L), ("http_content_type", S), ("content_encoding", S),
    ("plaintext_source_file", S), ("plaintext_source_offset", L), ("plaintext_content_type", S),
]
DATA_FIELDS = [
    ("uuid", S), ("lang", S), ("warc_date", T), ("warc_record_id", S), ("warc_trec_id", S),
    ("warc_target_uri", S), ("warc_target_hostname", S), ("warc_target_path", S),
    ("warc_target_query_string", S), ("warc_target_uri_hash", S), ("http_date", T),
    ("http_content_type", S), ("title", S), ("meta_keywords", A), ("meta_desc", S), ("body", S),
    ("body_length", L), ("full_body", S), ("headings", A),
]
META_SCHEMA = StructType([StructField(n, t, True) for n, t in META_FIELDS])
DATA_SCHEMA = StructType([StructField(n, t, True) for n, t in DATA_FIELDS])

# Fields stored under a language suffix ``{field}_lang_{lang}``.
LANGUAGE_FIELDS = ("title", "meta_keywords", "meta_desc", "body", "full_body", "headings")
# Fields indexed but not returned by the stored view.
STORED_EXCLUDES = ("warc_target_query_string",)
STORED_EXCLUDE_PREFIXES = ("full_body_", "headings_")

# Index field typing (K1): explicit fields first, then name patterns.
DATA_FIELD_KINDS = {
    "uuid": "keyword", "lang": "keyword", "body_length": "long", "warc_date": "date",
    "warc_target_hostname": "text:host", "warc_target_path": "text:path",
    "warc_target_query_string": "text:query", "http_date": "date", "page_rank": "float",
    "spam_rank": "byte",
}
META_FIELD_KINDS = {
    "uuid": "keyword", "source_file": "keyword", "source_offset": "long",
    "content_length": "long", "content_type": "keyword", "warc_date": "date",
    "warc_ip_address": "ip", "http_date": "date", "http_content_length": "long",
    "content_encoding": "keyword",
}


def field_kind(name: str, table: str = "data") -> str:
    """Index type of a field by name (explicit, then ``warc_*``/``http_*``/``*_lang_xx``)."""
    kinds = DATA_FIELD_KINDS if table == "data" else META_FIELD_KINDS
    if name in kinds:
        return kinds[name]
    if name.startswith("warc_") or name.startswith("http_"):
        return "keyword"
    if table == "data" and "_lang_" in name:
        return "text:" + name.rsplit("_lang_", 1)[1]
    return "keyword"


# Column types of the kinds that are no strings.
KIND_TYPES = {"long": "bigint", "byte": "tinyint", "float": "float", "date": "timestamp"}


# An address of kind ``ip``: four numbers up to 255, or groups of hexadecimal digits that
# may be shortened once and may end in four numbers.
_OCTETS = r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_GROUP = "[0-9A-Fa-f]{1,4}"


def _is_ip(c: Column) -> Column:
    """Whether a string is an IPv4 or IPv6 address."""
    # Four numbers at the end stand for two groups; then only groups and one shortening are left.
    groups = F.regexp_replace(c, f"(?<=:){_OCTETS}$", "0:0")
    n = F.size(F.filter(F.split(groups, ":", -1), lambda g: g != ""))
    full = groups.rlike(f"^{_GROUP}(?::{_GROUP}){{7}}$")
    short = groups.rlike(f"^(?:{_GROUP}(?::{_GROUP})*)?::(?:{_GROUP}(?::{_GROUP})*)?$") & (n <= 7)
    return c.rlike(f"^{_OCTETS}$") | full | short


def typed_fields(df: DataFrame, table: str = "data") -> DataFrame:
    """Columns cast to their field's type (K1), and ``bad_fields``: the names of
    those that hold a value their type cannot read (the value becomes null).

    No row is lost: ``bad_fields`` is empty for rows to write, and the others
    can be set aside (``sink.write_typed``).
    """
    kinds = {c: field_kind(c, table) for c in df.columns}

    def value(c: str) -> Column:
        if kinds[c] == "ip":
            return F.when(_is_ip(F.col(c)), F.col(c))
        return F.col(c).try_cast(KIND_TYPES[kinds[c]]) if kinds[c] in KIND_TYPES else F.col(c)
    checked = [c for c, k in kinds.items() if k == "ip" or k in KIND_TYPES]
    bad = [F.when(F.col(c).isNotNull() & value(c).isNull(), F.lit(c)) for c in checked]
    bad_fields = F.filter(F.array(*bad), lambda c: c.isNotNull()) if bad else F.array().cast("array<string>")
    return df.select(*[value(c).alias(c) for c in df.columns], bad_fields.alias("bad_fields"))


def _typed(value, dtype) -> Column:
    if value is None:
        return F.lit(None).cast(dtype)
    if not isinstance(value, Column):
        value = F.lit(value)
    return value.cast(dtype)


def record_columns(meta: dict, data: dict) -> list[Column]:
    """Columns ``m_<field>`` and ``d_<field>`` in schema order."""
    cols = [_typed(meta.get(n), t).alias("m_" + n) for n, t in META_FIELDS]
    cols += [_typed(data.get(n), t).alias("d_" + n) for n, t in DATA_FIELDS]
    return cols


def meta_table(records: DataFrame) -> DataFrame:
    return records.select("_id", *[F.col("m_" + n).alias(n) for n, _ in META_FIELDS])


def data_table(records: DataFrame) -> DataFrame:
    return records.select("_id", *[F.col("d_" + n).alias(n) for n, _ in DATA_FIELDS])


def paired(records: DataFrame) -> DataFrame:
    """``(_id, meta struct, data struct)``: both rows of a document together (A10)."""
    return records.select(
        "_id",
        F.struct(*[F.col("m_" + n).alias(n) for n, _ in META_FIELDS]).alias("meta"),
        F.struct(*[F.col("d_" + n).alias(n) for n, _ in DATA_FIELDS]).alias("data"))


def index_actions(table: DataFrame, index_name: str) -> DataFrame:
    """The action envelope ``_op_type, _index, _id, fields...``."""
    fields = [c for c in table.columns if c != "_id"]
    return table.select(F.lit("index").alias("_op_type"), F.lit(index_name).alias("_index"),
                        "_id", *fields)


def iso_seconds(ts) -> Column:
    """Timestamp as ISO 8601 in UTC with seconds, ``...+00:00``.

    Independent of the session time zone: the instant is shifted to UTC wall
    time before formatting.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def written_value(name: str, dtype) -> Column:
    """A field as the index receives it: strings, string arrays, ISO dates."""
    c = F.col(name)
    if isinstance(dtype, TimestampType):
        return iso_seconds(c)
    if isinstance(dtype, ArrayType):
        return F.transform(c, lambda x: x.cast("string"))
    return c.cast("string")


def _inner_json(fields, prefix: str, lang: Column) -> Column:
    """The members of a record's JSON object, without its braces."""
    plain = [(n, t) for n, t in fields if n not in LANGUAGE_FIELDS]
    lang_str = [(n, t) for n, t in fields if n in LANGUAGE_FIELDS and not isinstance(t, ArrayType)]
    lang_arr = [(n, t) for n, t in fields if n in LANGUAGE_FIELDS and isinstance(t, ArrayType)]
    base = F.to_json(F.struct(*[written_value(prefix + n, t).alias(n) for n, t in plain]))

    def suffixed(group) -> Column:
        # Without a language the fields keep their plain names.
        keys = F.array(*[F.coalesce(F.concat(F.lit(n + "_lang_"), lang), F.lit(n)) for n, _ in group])
        vals = F.array(*[written_value(prefix + n, t) for n, t in group])
        m = F.map_filter(F.map_from_arrays(keys, vals), lambda k, v: v.isNotNull())
        return F.to_json(m)

    def inner(js: Column) -> Column:
        return F.regexp_replace(js, r"^\{|\}$", "")

    parts = F.array(inner(base), *[inner(suffixed(g)) for g in (lang_str, lang_arr) if g])
    return F.array_join(F.filter(parts, lambda p: p != ""), ",")


def wide_json(table: DataFrame, fields=DATA_FIELDS) -> Column:
    """One JSON object per row: language fields renamed ``{field}_lang_{lang}``,
    nulls left out, values written as strings (J1-J3)."""
    lang = F.col("lang") if "lang" in table.columns else F.lit(None).cast("string")
    return F.concat(F.lit("{"), _inner_json(fields, "", lang), F.lit("}"))


def written_actions(records: DataFrame, meta_index: str, data_index: str) -> DataFrame:
    """``value``: the written form of a record frame, two JSON lines a document.

    Each line is an action's envelope and the record's fields in one object;
    a document's meta line comes right before its data line.
    """
    def action(index: str, members: Column) -> Column:
        envelope = F.to_json(F.struct(F.lit("index").alias("_op_type"), F.lit(index).alias("_index"), F.col("_id").alias("_id")))
        return F.concat(F.regexp_replace(envelope, r"\}$", ""), F.when(members != "", F.lit(",")).otherwise(F.lit("")), members, F.lit("}"))
    both = F.array(action(meta_index, _inner_json(META_FIELDS, "m_", F.lit(None).cast("string"))),
                   action(data_index, _inner_json(DATA_FIELDS, "d_", F.col("d_lang"))))
    return records.select(F.explode(both).alias("value"))


def stored_view(wide: DataFrame) -> DataFrame:
    """Drop the fields the index keeps searchable but does not return."""
    drop = [c for c in wide.columns
            if c in STORED_EXCLUDES or any(c.startswith(p) for p in STORED_EXCLUDE_PREFIXES)]
    return wide.drop(*drop)


def language_columns(table: DataFrame, languages) -> DataFrame:
    """Wide table with per-language field columns ``{field}_lang_{l}``."""
    cols = [c for c in table.columns if c not in LANGUAGE_FIELDS]
    out = [F.col(c) for c in cols]
    for field in LANGUAGE_FIELDS:
        if field in table.columns:
            for lang in languages:
                out.append(F.when(F.col("lang") == lang, F.col(field)).alias(f"{field}_lang_{lang}"))
    return table.select(*out)
