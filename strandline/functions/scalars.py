"""Scalar expressions that the queries share; all are built from built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def suffix_number(name: Column, mark: str = "_") -> Column:
    """The number after the last mark."""
    return F.element_at(F.split(name, F.lit("\\" + mark)), -1).cast("long")


def soft_compress(x: Column, strength: float = 0.12) -> Column:
    return x / (1 + strength * x)


def clamp_stops(ratio: Column, stops: float = 0.65) -> Column:
    return F.greatest(F.pow(F.lit(2.0), F.lit(-stops)), F.least(F.pow(F.lit(2.0), F.lit(stops)), ratio))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def luma(rgb: Column) -> Column:
    """The Rec. 709 weights."""
    return rgb[0] * 0.2126 + rgb[1] * 0.7152 + rgb[2] * 0.0722


def polynomial(r: Column, g: Column, b: Column) -> Column:
    """13 features: 1, the channels, their roots, squares and products."""
    return F.array(F.lit(1.0), r, g, b, F.sqrt(r), F.sqrt(g), F.sqrt(b), r * r, g * g, b * b, r * g, r * b, g * b)
