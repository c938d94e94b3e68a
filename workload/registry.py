"""Collects the queries of the sibling modules under unique names."""

from __future__ import annotations

from workload import cleaning, flows, gold, quality, storage, streaming

QUERIES = {}
ORACLES = {}
for _module in (cleaning, quality, gold, storage, flows, streaming):
    for _name, (_query, _sql) in _module.ENTRIES.items():
        if _name in QUERIES:
            raise ValueError(f"query {_name} is registered twice")
        QUERIES[_name] = _query
        if _sql is not None:
            ORACLES[_name] = _sql
