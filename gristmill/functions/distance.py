"""Unrolled squared-Euclidean expressions.

Centres are k x d plain numbers, so distances become arithmetic on columns and
literals: no join against a centre table, no shuffle, whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.names import quoted


def squared_norm(cols: Sequence[str]) -> Column:
    return reduce(add, [F.col(quoted(c)) * F.col(quoted(c)) for c in cols])


def squared_distance(cols: Sequence[str], center: Sequence[float]) -> Column:
    if len(cols) != len(center):
        raise ValueError(f"{len(cols)} columns but a centre with {len(center)} coordinates")
    gaps = [F.col(quoted(c)) - F.lit(float(v)) for c, v in zip(cols, center, strict=True)]
    return reduce(add, [g * g for g in gaps])


def nearest(distances: str) -> Column:
    """Position of the smallest entry of an array column; ties go to the lower position.

    An array of nulls or NaN (a missing feature) gives a null position. Bind the array to a
    column first: it is referred to more than once.
    """
    least = F.array_min(distances)
    return F.when(~F.isnan(least), F.array_position(distances, least) - 1).cast("int")
