"""All registered queries by name."""

from __future__ import annotations

from wavemeter.plans import busyhours, counting, landing, operations, rollups, schedules, stored, thresholds
from wavemeter.plans.fixtures import Query

_MODULES = (rollups, busyhours, counting, thresholds, operations, landing, schedules, stored)


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for module in _MODULES:
        clash = out.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"duplicate query names {sorted(clash)}")
        out.update(module.QUERIES)
    return out
