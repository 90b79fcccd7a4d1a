"""All queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from docgraph.plans import graph_queries, text_queries, video_queries, view_queries

_MODULES = (graph_queries, view_queries, text_queries, video_queries)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
