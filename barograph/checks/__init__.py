"""SQL checks of the queries, for DuckDB."""

from __future__ import annotations


def all_checks() -> dict[str, str]:
    from barograph.checks import operators_sql, oracle, warehouse_sql  # noqa: F401
    from barograph.queries import all_queries

    parts = {name: operators_sql.ALIASES.get(name, name) for name in all_queries()}
    return {name: oracle.assemble(part) for name, part in parts.items() if part in oracle.PARTS}
