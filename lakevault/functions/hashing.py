"""Stable text forms and the three hashes built on them.

A hash is only as stable as the text it is taken over, so every type gets one pinned text form:
decimals keep their scale, doubles their shortest text that reads back as the same value (zero
without a sign), zoned timestamps are counted in
microseconds (independent of the session's zone), everything else uses the plain string cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# They are part of every stored hash.
PLACEHOLDER = "^^"
DELIMITER = "||"
ROWHASH_DELIMITER = "|"


def text_form(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    col = F.col(name)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        col = col.cast("double") + F.lit(0.0)  # -0.0 becomes 0.0
    elif isinstance(dtype, T.TimestampType):
        col = F.unix_micros(col)
    return col if isinstance(dtype, T.StringType) else col.cast("string")


def key_form(df: DataFrame, name: str) -> Column:
    """Business keys ignore case and surrounding blanks; a blank key counts as missing."""
    text = text_form(df, name)
    if isinstance(df.schema[name].dataType, T.StringType):
        text = F.nullif(F.upper(F.trim(text)), F.lit(""))
    return text


def hash_key(df: DataFrame, names: Sequence[str]) -> Column:
    """MD5 over the key columns; NULL when every part is missing."""
    parts = [key_form(df, n) for n in names]
    joined = F.concat_ws(DELIMITER, *[F.coalesce(p, F.lit(PLACEHOLDER)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), F.md5(joined))


def hashdiff(df: DataFrame, names: Sequence[str]) -> Column:
    """MD5 over the payload, columns in name order; never NULL, case and blanks count."""
    parts = [F.coalesce(text_form(df, n), F.lit(PLACEHOLDER)) for n in sorted(names)]
    return F.md5(F.concat_ws(DELIMITER, *parts))


def row_hash(df: DataFrame, names: Sequence[str]) -> Column:
    """SHA-256 over the given columns in the given order, NULL as empty text."""
    parts = [F.coalesce(text_form(df, n), F.lit("")) for n in names]
    return F.sha2(F.concat_ws(ROWHASH_DELIMITER, *parts), 256)
