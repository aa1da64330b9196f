"""Codes to labels and numbers to range labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment codes, vendor codes and range labels.
PAYMENT_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Unknown"
VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "VeriFone Inc.",
    4: "Unknown/Other",
}
DISTANCE_EDGES = (1, 3, 10)
DISTANCE_LABELS = ("< 1 mile", "1–3 miles", "3–10 miles", "10+ miles")
SEGMENT_EDGES = (1, 3, 7, 10)
SEGMENT_LABELS = ("up to 1", "1 to 3", "3 to 7", "7 to 10", "over 10")


def labelled(col: Column | str, labels: Mapping, default: str | None = None) -> Column:
    """CASE built from a mapping; without a default, unknown codes become null."""
    expr = None
    for code, text in labels.items():
        hit = _c(col) == F.lit(code)
        expr = F.when(hit, F.lit(text)) if expr is None else expr.when(hit, F.lit(text))
    return expr if default is None else expr.otherwise(F.lit(default))


def bucketed(col: Column | str, edges: Sequence, labels: Sequence[str],
             upper_inclusive: bool = False) -> Column:
    """Label of the range a number falls into; ``labels`` has one entry more than ``edges``."""
    expr = None
    for edge, text in zip(edges, labels):
        hit = _c(col) <= edge if upper_inclusive else _c(col) < edge
        expr = F.when(hit, text) if expr is None else expr.when(hit, text)
    return expr.otherwise(labels[-1])


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
