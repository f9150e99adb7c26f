"""Ordered rule lists -> classification columns and row filters.

A rule is ``(label, predicate)``; the first predicate that is true wins, as a
searched CASE does. A null predicate is not true, so it falls through.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def first_match(rules: Sequence[Rule], default: str | None = None) -> Column:
    """``case when p1 then l1 when p2 then l2 ... else default end``."""
    expr = None
    for label, pred in rules:
        expr = F.when(pred, F.lit(label)) if expr is None else expr.when(pred, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def first_match_value(rules: Sequence[tuple[Column, Column]]) -> Column:
    """Same, with a column value per rule and null otherwise."""
    expr = None
    for pred, value in rules:
        expr = F.when(pred, value) if expr is None else expr.when(pred, value)
    return expr


def any_of(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds)


def all_of(preds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds)
