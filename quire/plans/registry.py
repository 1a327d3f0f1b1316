"""Every query of the core by name, and the SQL that it is compared with."""

from __future__ import annotations

from quire.plans import corpus, pages, records, relational, structure

PARTS = (corpus, pages, structure, records, relational)
QUERIES: dict = {k: v for p in PARTS for k, v in p.QUERIES.items()}
SQL: dict[str, str] = {k: v for p in PARTS for k, v in p.SQL.items()}
