"""Registered queries, each with the SQL that states its expected result."""

from __future__ import annotations

from tillmarts.catalog import loads, models, operators, scalars
from tillmarts.catalog.registry import Query, registered

__all__ = ["Query", "loads", "models", "operators", "registered", "scalars"]
