"""All queries of the core, by name."""

from __future__ import annotations

from sylva.plans import check_queries, core_queries, dataset_queries, hierarchy_queries

FLAGSHIP = "capacity_by_language"
MODULES = (core_queries, hierarchy_queries, dataset_queries, check_queries)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE = {name: q for m in MODULES for name, q in m.ORACLE.items()}
