"""All registered queries."""

from __future__ import annotations

from workload import data, edges, metadata, runs, synthetic

PARTS = [metadata, data, synthetic, runs, edges]
QUERIES = {name: query for part in PARTS for name, query in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
