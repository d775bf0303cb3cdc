"""All queries outside the subpackage for language-model data, by name."""

from __future__ import annotations

from tremor.plans import data_quality, domain, records

_PARTS = [data_quality, domain, records]

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
