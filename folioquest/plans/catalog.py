"""Named queries over the driver's tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from folioquest.plans import dataset_queries, layout_queries, text_queries, tree_queries, vector_queries

MODULES = (text_queries, tree_queries, vector_queries, layout_queries, dataset_queries)

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
