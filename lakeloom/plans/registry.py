"""Every query of the library by name, and the SQL that must agree with it."""

from __future__ import annotations

from .catalog import ORACLE_SQL, QUERIES, query
from . import commerce, dimensions, engagement, expressions, facts, identities, learning, primitives, qualities, stores, texts  # noqa: F401  they register their queries

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES", "query"]

FLAGSHIP = "latest_event_per_user"
