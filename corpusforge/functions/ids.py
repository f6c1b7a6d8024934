"""Deterministic document keys.

* ``doc_uuid``: UUIDv5 over ``prefix:id`` in the URL namespace, URL-safe
  base64 without padding (22 characters). Fully native: SHA-1, bit fix-up by
  string surgery on the hex digest, ``base64``.
* ``index_id``: a UUIDv1-shaped 128-bit key from record time (ms), storage
  offset, storage file name and document UUID. Bit fields are native; the
  3-byte BLAKE2b node hashes are the only Python (an Arrow-batched UDF that
  hashes each distinct value of a batch once).
"""

from __future__ import annotations

import hashlib
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the RFC 4122 URL namespace UUID (6ba7b811-9dad-11d1-80b4-00c04fd430c8).
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _b64url22(hex32: Column) -> Column:
    """16 bytes given as 32 hex digits -> URL-safe base64 with '==' cut."""
    return F.substring(F.translate(F.base64(F.unhex(hex32)), "+/", "-_"), 1, 22)


def uuid5_hex(name: Column) -> Column:
    """Lower-case hex of UUIDv5(NAMESPACE_URL, name)."""
    digest = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_URL_HEX)), F.encode(name, "UTF-8")))
    return F.concat(
        F.substring(digest, 1, 12),
        F.lit("5"),  # version nibble
        F.substring(digest, 14, 3),
        # variant bits 10xx: keep the low two bits of the nibble, set the top one
        F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab"),
        F.substring(digest, 18, 15),
    )


def doc_uuid(prefix, doc_id) -> Column:
    """Document UUID for ``prefix:doc_id`` (B1). A null id gives null."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    name = F.concat(prefix, F.lit(":"), _col(doc_id).cast("string"))
    return _b64url22(uuid5_hex(name))


def _blake2b24(value: str) -> str:
    return hashlib.blake2b(value.encode("utf-8"), digest_size=3).hexdigest()


@F.pandas_udf(StringType())
def blake2b24_hex(values: pd.Series) -> pd.Series:
    """3-byte BLAKE2b of each string as 6 hex digits (no Spark built-in).

    File names repeat heavily (one per corpus or bundle), so each batch
    hashes its distinct values once and maps back.
    """
    uniques = values.dropna().unique()
    table = {v: _blake2b24(v) for v in uniques}
    return values.map(table)


# Python workers may not have this package on their path: ship this module's
# functions (the UDF bodies) by value with each task instead of by import name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _hex_field(value: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(value)), width, "0")


def index_id_hex(unix_ms, position, file_name, uuid) -> Column:
    """32 hex digits of the time-ordered index key (B2)."""
    ms = _col(unix_ms).cast("bigint")
    pos32 = _col(position).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    time_low = ms.bitwiseAND(F.lit(0xFFFFFFFF))
    time_mid = F.shiftright(ms, 32).bitwiseAND(F.lit(0xFFFF))
    time_hi = F.shiftright(pos32, 16).bitwiseAND(F.lit(0x3FFF)).bitwiseOR(F.lit(0x1000))
    clock = pos32.bitwiseAND(F.lit(0xFFFF))
    clock_hi = F.shiftright(clock, 8).bitwiseAND(F.lit(0x3F)).bitwiseOR(F.lit(0x80))
    clock_lo = clock.bitwiseAND(F.lit(0xFF))
    return F.concat(
        _hex_field(time_low, 8), _hex_field(time_mid, 4), _hex_field(time_hi, 4),
        _hex_field(clock_hi, 2), _hex_field(clock_lo, 2),
        blake2b24_hex(_col(file_name)), blake2b24_hex(_col(uuid)),
    )


def index_id_fields(unix_ms, position) -> Column:
    """The native part of the index key: time and position fields (16 hex digits)."""
    ms = _col(unix_ms).cast("bigint")
    pos32 = _col(position).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    clock = pos32.bitwiseAND(F.lit(0xFFFF))
    return F.concat(
        _hex_field(ms.bitwiseAND(F.lit(0xFFFFFFFF)), 8),
        _hex_field(F.shiftright(ms, 32).bitwiseAND(F.lit(0xFFFF)), 4),
        _hex_field(F.shiftright(pos32, 16).bitwiseAND(F.lit(0x3FFF)).bitwiseOR(F.lit(0x1000)), 4),
        _hex_field(F.shiftright(clock, 8).bitwiseAND(F.lit(0x3F)).bitwiseOR(F.lit(0x80)), 2),
        _hex_field(clock.bitwiseAND(F.lit(0xFF)), 2),
    )


def index_id(unix_ms, position, file_name, uuid) -> Column:
    """The row key ``_id`` (B2/B3) as 22 URL-safe base64 characters."""
    return _b64url22(index_id_hex(unix_ms, position, file_name, uuid))


def month_utc_ms(year: int, month: int) -> Column:
    """Record time of a corpus given as a month (B4), pinned to UTC."""
    return F.unix_millis(F.make_timestamp(F.lit(year), F.lit(month), F.lit(1),
                                          F.lit(0), F.lit(0), F.lit(0), F.lit("UTC")))


def storage_uri(bucket, relative_path) -> Column:
    """``s3://{bucket}/{relative path}`` (A16). A missing bucket prints ``None``."""
    bucket_col = F.lit("None" if bucket is None else bucket) if not isinstance(bucket, Column) else bucket
    path = F.lit(relative_path) if isinstance(relative_path, str) else relative_path
    return F.concat(F.lit("s3://"), bucket_col, F.lit("/"), path)
