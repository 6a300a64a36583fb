"""Queries and SQL of the operators in this subpackage."""

from __future__ import annotations

from folioquest.llm import bpe, cover, media, packing, quality, scoring, secrets, simhash, suffixes, toxicity

MODULES = (secrets, media, bpe, packing, scoring, quality, toxicity, suffixes, cover, simhash)

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
