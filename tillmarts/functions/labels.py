"""CASE-style mappings driven by plain data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillmarts.functions import lookups as L


def case_lookup(col: Column, mapping: Mapping, default: object = None) -> Column:
    """Equality map; without a default the result is NULL for values outside the map."""
    pairs = list(mapping.items())
    out = F.when(col == F.lit(pairs[0][0]), F.lit(pairs[0][1]))
    for key, value in pairs[1:]:
        out = out.when(col == F.lit(key), F.lit(value))
    return out if default is None else out.otherwise(F.lit(default))


def office_name(office_id: Column) -> Column:
    return case_lookup(office_id, L.OFFICES, L.OFFICE_OTHER)


def month_name(month: Column) -> Column:
    return case_lookup(month, L.MONTHS)


def weekday_name(weekday: Column) -> Column:
    return case_lookup(weekday, L.WEEKDAYS)


def size_order(size: Column) -> Column:
    """Position of a size label, NULL for labels outside the chart."""
    return case_lookup(size, L.SIZE_ORDER).cast("bigint")


def size_order_text(size: Column) -> Column:
    """The same position as text; labels outside the chart stay as they are."""
    return F.coalesce(case_lookup(size, {k: str(v) for k, v in L.SIZE_ORDER.items()}), size)


def first_match(text: Column, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """Name of the first rule whose code occurs in ``text``; ``default`` when none does.

    One branch per rule: apply it to distinct codes, not to every fact row
    (``operators.joins.attach_colour``).
    """
    out = None
    for code, name in rules:
        hit = text.contains(code)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out.otherwise(F.lit(default))


def colour(code: Column) -> Column:
    return first_match(code, L.COLOUR_RULES, L.COLOUR_OTHER)


def semester(month: Column) -> Column:
    return F.when(month.between(1, 6), "S1").otherwise("S2")


def quarter(month: Column) -> Column:
    return (
        F.when(month.between(1, 3), "Q1")
        .when(month.between(4, 6), "Q2")
        .when(month.between(7, 9), "Q3")
        .otherwise("Q4")
    )
