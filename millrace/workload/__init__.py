"""Queries over the given tables, one per operator, each with an SQL equivalent where there is one."""

from __future__ import annotations


def registry() -> dict:
    from millrace.workload import analytics, checks, loads, logs, streams

    found: dict = {}
    for part in (analytics, checks, loads, logs, streams):
        found.update(part.QUERIES)
    return found
