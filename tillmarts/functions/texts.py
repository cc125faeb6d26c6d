"""Text keys and prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmarts.functions.lookups import UNKNOWN


def left_prefix(col: Column, length: int) -> Column:
    return F.substring(col.cast("string"), 1, length)


def like_contains(col: Column, part: str) -> Column:
    return col.contains(part)


def concat_key(*parts: Column, separator: str = "_", default: str = UNKNOWN) -> Column:
    """Joined key in which a missing part shows as ``default`` rather than vanishing."""
    return F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit(default)) for p in parts])


def null_default(*cols: Column) -> Column:
    return F.coalesce(*cols)
