"""Named SELECT texts that refer to each other, put together as one WITH query."""

from __future__ import annotations

import re
from collections.abc import Mapping


def compose(query: str, parts: Mapping[str, str]) -> str:
    """``query`` preceded by every part it needs, each after the parts it needs itself."""
    order: list[str] = []
    seen: set[str] = set()

    def need(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_]\w*\b", text)):
            if word in parts and word not in seen:
                seen.add(word)
                need(parts[word])
                order.append(word)

    need(query)
    if not order:
        return query
    recursive = "RECURSIVE " if any("UNION ALL -- step" in parts[n] for n in order) else ""
    bodies = ",\n".join(f"{n} AS (\n{parts[n].strip()}\n)" for n in order)
    return f"WITH {recursive}{bodies}\n{query.strip()}"
