"""Key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def primary_key(*columns: str) -> Column:
    """md5 of the trimmed, lower-case, non-blank parts joined with ``|#``; null
    when every part is blank."""
    parts = [F.nullif(F.trim(F.lower(F.col(c).cast("string"))), F.lit("")) for c in columns]
    text = F.concat_ws("|#", *parts)
    return F.when(text != "", F.md5(text))


def surrogate_key(*columns: str, sep: str = "/", wide: bool = False) -> Column:
    """Numeric key of several columns: crc32, or the 64-bit ``xxhash64``.

    crc32 has 32 bits, so on a large table distinct rows will share a key; use
    ``wide`` wherever existing crc32 keys need not be matched.
    """
    text = F.concat_ws(sep, *columns)
    return F.xxhash64(text) if wide else F.crc32(text.cast("binary"))


UNKNOWN_NUMBER = -1
UNKNOWN_TEXT = "-1"
