"""Queries of the evidence operators and the SQL that gives the same rows."""

from __future__ import annotations

from ledgerloom.queries import artifacts, gazette, layout, ledger, registry, search, sources, text

PARTS = (gazette, text, layout, ledger, artifacts, sources, search, registry)
QUERIES: dict = {k: f for part in PARTS for k, f in part.QUERIES.items()}
ORACLE: dict[str, str] = {k: s for part in PARTS for k, s in part.ORACLE.items()}
