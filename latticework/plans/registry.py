"""All registered queries with their oracle SQL."""

from __future__ import annotations

from latticework.plans import bitset, bloom, chunks, inclusion, preimage, readers

_FAMILIES = [inclusion, preimage, chunks, bitset, bloom, readers]

QUERIES = {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}
ORACLES = {name: sql for family in _FAMILIES for name, sql in family.ORACLES.items()}
