"""All queries of the core, by name."""

from __future__ import annotations

from sluice.plans import ingestion, landing, problems, services

FLAGSHIP = "merge_freshness_rows"
QUERIES = ingestion.QUERIES | landing.QUERIES | services.QUERIES | problems.QUERIES
SQL = ingestion.SQL | landing.SQL | services.SQL | problems.SQL
