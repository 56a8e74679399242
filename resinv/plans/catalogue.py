"""All queries of the core."""

from __future__ import annotations

from resinv.plans import entity_queries, generic_queries, inventory_queries, match_queries, packed_queries, service_queries, text_queries, url_queries  # noqa: F401  (registers queries)
from resinv.plans.registry import QUERIES, SQL, Query

FLAGSHIP = "dedup_by_url_entity"


def queries() -> dict[str, Query]:
    return QUERIES


def sql() -> dict[str, str]:
    return SQL
