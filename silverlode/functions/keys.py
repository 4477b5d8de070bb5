"""Keys derived from values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what a missing part contributes to a surrogate key.
MISSING_PART = "_dbt_null_"


def surrogate_key(*parts: Column | str) -> Column:
    """Deterministic, null-safe 128-bit key of one or more values.

    The unique keys of the merges rest on it, so it must not collide: 64-bit
    hashes are expected to at some billions of rows.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(c.cast("string"), F.lit(MISSING_PART)) for c in columns]
    return F.md5(F.concat_ws("\x1f", *texts))


# What marks a text that is no digest; with it no such text is 16 bytes long.
_TEXT_MARK = "00" * 17


def packed_digest(name: str) -> Column:
    """A digest in 16 bytes instead of 32 characters, for moves between tasks; any other text as marked bytes."""
    text = F.col(name)
    digest = F.unhex(text)
    is_digest = (F.length(text) == 32) & digest.isNotNull() & (F.lower(text) == text)
    marked = F.concat(F.unhex(F.lit(_TEXT_MARK)), F.encode(text, "UTF-8"))
    return F.when(F.coalesce(is_digest, F.lit(False)), digest).otherwise(marked)


def unpacked_digest(name: str) -> Column:
    """The text of ``packed_digest``."""
    packed = F.col(name)
    text = F.decode(F.substring(packed, len(_TEXT_MARK) // 2 + 1, 2**31 - 1), "UTF-8")
    return F.when(F.length(packed) == 16, F.lower(F.hex(packed))).otherwise(text)


def row_fingerprint(names: Iterable[str]) -> Column:
    """One number for a whole row: a tie-break that costs 8 bytes in a shuffle."""
    return F.xxhash64(*[F.col(n) for n in sorted(names)])
