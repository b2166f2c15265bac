"""String helpers with Python ``str.strip`` semantics."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

_EDGE_WS = r"(?U)^\s+|\s+$"


def py_strip(col: Column) -> Column:
    """Remove leading/trailing Unicode whitespace (Spark ``trim`` only drops spaces)."""
    return F.regexp_replace(col, _EDGE_WS, "")


def is_blank(col: Column) -> Column:
    """Nothing but Unicode whitespace: one search that ends at the first other character."""
    return ~col.rlike(r"(?U)\S")
