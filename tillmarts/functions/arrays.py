"""Per-row work on small arrays, without exploding or shuffling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmarts.functions.lookups import PURCHASE_TYPES, VIDEO_ATTACHMENT


def sum_in_set(
    items: Column,
    value_type: str,
    types: Sequence[str] = tuple(PURCHASE_TYPES),
    type_field: str = "action_type",
    value_field: str = "value",
) -> Column:
    """Sum of the values whose type is in the set; 0 for a missing or empty array."""
    wanted = F.filter(items, lambda x: x[type_field].isin(*types))
    values = F.transform(wanted, lambda x: F.coalesce(x[value_field].try_cast(value_type), F.lit(0)))
    zero = F.lit(0).cast(value_type)
    return F.coalesce(F.aggregate(values, zero, lambda acc, v: acc + v.cast(value_type)), zero)


def castable_in_set(
    items: Column,
    value_type: str,
    types: Sequence[str] = tuple(PURCHASE_TYPES),
    type_field: str = "action_type",
    value_field: str = "value",
) -> Column:
    """Whether every value ``sum_in_set`` would add is a value of the type."""
    wanted = F.filter(items, lambda x: x[type_field].isin(*types))
    fits = F.forall(
        wanted, lambda x: x[value_field].isNull() | x[value_field].try_cast(value_type).isNotNull()
    )
    return F.coalesce(fits, F.lit(True))


def any_video(attachments: Column) -> Column:
    return F.coalesce(F.exists(attachments, lambda a: a["type"] == VIDEO_ATTACHMENT), F.lit(False))


def last_video_id(attachments: Column) -> Column:
    """Target id of the last video attachment."""
    videos = F.filter(attachments, lambda a: a["type"] == VIDEO_ATTACHMENT)
    return F.try_element_at(videos, F.lit(-1))["target"]["id"]
