"""Put a query together from named common table expressions."""

from __future__ import annotations

import re


def assemble(ctes: dict[str, str], final: str) -> str:
    """``WITH`` clause holding just the expressions ``final`` needs, in dependency order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in ctes:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                visit(ctes[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({ctes[n]})" for n in needed) + "\n" + final
