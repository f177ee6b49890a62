"""Check queries in SQL, written independently of the Spark code.

A check is assembled from named parts: each part is one SELECT, and the parts it mentions become
common table expressions in front of it. Tables are the driver's views; the weather tables come
from the fixture adapters. ``r(x, n)`` rounds like the Spark side: twelve digits, then n.
"""

from __future__ import annotations

import re

from barograph.sources import adapters

AS_OF = "DATE '2001-11-01'"
MIN_DATE = "DATE '1995-01-01'"
PARTS: dict[str, str] = {
    name: text.format(**{t: t for t in adapters.TABLES}) for name, text in adapters.SOURCES.items()
}


def r(x: str, n: int | None = None) -> str:
    return f"«{x}»" if n is None else f"ROUND(ROUND(CAST({x} AS DOUBLE), 12), {n})"


def _render(sql: str, last: bool) -> str:
    if not last:
        return sql.replace("«", "(").replace("»", ")")
    return sql.replace("«", "ROUND(ROUND(CAST(").replace("»", " AS DOUBLE), 12), 9)")


def avg(x: str, n: int | None = None) -> str:
    return r(f"AVG({x})", n)


def s(x: str) -> str:
    return f"ROUND(CAST({x} AS DOUBLE), 12)"


def n_if(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def season(month: str, names: str = "'Summer','Autumn','Winter','Spring'") -> str:
    return f"([{names}])[(({month} % 12) // 3) + 1]"


def month_of(d: str) -> str:
    return f"CAST(DATE_TRUNC('month', {d}) AS DATE)"


def add(name: str, sql: str) -> None:
    PARTS[name] = sql.strip().rstrip(";")


def assemble(name: str) -> str:
    order: list[str] = []

    def visit(part: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_][a-z0-9_]*\b", PARTS[part])):
            if word != part and word in PARTS and word not in order:
                visit(word)
        if part not in order:
            order.append(part)

    visit(name)
    *parents, last = order
    if not parents:
        return _render(PARTS[last], last=True)
    ctes = ",\n".join(f"{p} AS (\n{_render(PARTS[p], last=False)}\n)" for p in parents)
    return f"WITH {ctes},\nresult AS (\n{_render(PARTS[last], last=True)}\n)\nSELECT * FROM result"
