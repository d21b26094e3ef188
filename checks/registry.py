"""All registered queries."""

from __future__ import annotations

from checks import audits, indicators, landing, merges, reading, streams, updates
from checks.present import Check


def all_checks() -> dict[str, Check]:
    out: dict[str, Check] = {}
    for module in (reading, indicators, landing, merges, audits, streams, updates):
        for check in module.CHECKS:
            if check.name in out:
                raise ValueError(f"{check.name} is registered twice")
            out[check.name] = check
    return out
