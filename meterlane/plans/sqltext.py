"""Snippets for the DuckDB texts, matching ``meterlane.functions.numbers``."""

from meterlane.plans.stand_ins import TRIPS_SQL, ZONES_SQL

TRIPS = f"WITH {TRIPS_SQL}"
BOTH = f"WITH {TRIPS_SQL}, {ZONES_SQL}"


def total(expr: str, digits: int = 4) -> str:
    return half_up(f"SUM({expr})", digits)


def mean(expr: str, digits: int = 4) -> str:
    return half_up(f"AVG({expr})", digits)


def half_up(expr: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def number(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"
