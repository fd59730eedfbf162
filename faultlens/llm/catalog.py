"""All queries of this subpackage; importing a module below registers its queries."""

from faultlens.llm import chat_queries, clean_queries, license_queries, near_queries, pack_queries, periodic_queries, quality_queries, search_queries, secret_queries, token_queries, toxic_queries, variant_queries  # noqa: F401
from faultlens.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
