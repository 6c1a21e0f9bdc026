"""Deterministic record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY_LENGTH = 32  # hexadecimal digits of an MD5 digest
KEY_SEPARATOR = "|"


def record_key(df: DataFrame, columns: Sequence[str], nulls: str = "empty") -> Column:
    """MD5 over the text form of ``columns``.

    ``nulls="empty"`` keeps the position of a NULL, so (a, NULL, b) and (a, b, NULL)
    differ. ``nulls="skip"`` leaves NULLs out, which makes such rows collide; it exists
    for keys that were written that way. Adding 0.0 turns -0.0 into 0.0, so equal
    numbers give equal text.
    """
    if nulls not in ("empty", "skip"):
        raise ValueError(f"nulls must be 'empty' or 'skip', not {nulls!r}")
    parts = []
    for name in columns:
        column = F.col(name)
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            column = column + F.lit(0.0)
        text = column.cast("string")
        parts.append(F.coalesce(text, F.lit("")) if nulls == "empty" else text)
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def with_key(df: DataFrame, columns: Sequence[str], out: str, nulls: str = "empty") -> DataFrame:
    return df.withColumn(out, record_key(df, columns, nulls))
