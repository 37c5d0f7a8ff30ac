"""Oracle SQL per registered query."""

from __future__ import annotations

from .audit import audit_sql
from .base import CTES, whole_table
from .ingestion import ingestion_sql
from .quality import quality_sql
from .reports import report_sql

PIPELINE = [
    n for n in CTES if not n.startswith("raw_") and n not in ("version_assignment", "version_rollup")
]


def all_sql() -> dict[str, str]:
    return {**{n: whole_table(n) for n in PIPELINE}, **report_sql(), **quality_sql(), **ingestion_sql(), **audit_sql()}
