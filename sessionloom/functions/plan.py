"""Expressions that keep plans small."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda's variable is never
    inlined by the optimizer, so long derivations keep a linear size."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fenced(c: Column) -> Column:
    """``c`` behind a non-deterministic guard that always holds, which keeps it from being
    inlined where it is used more than once, and filters on it from being pushed below."""
    return F.when(F.rand(0) < 2, c)
