"""Arithmetic on ``array<double>`` columns, all inside the JVM."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-8


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)


def scale(vector: Column, factor: Column | float) -> Column:
    return F.transform(vector, lambda x: x * factor)


def add(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a + b)


def unit(vector: Column) -> Column:
    """Vector over its length; the small constant keeps zero vectors at zero."""
    length = F.sqrt(dot(vector, vector)) + EPSILON
    return F.transform(vector, lambda x: x / length)


def unit_exact(vector: Column) -> Column:
    """Vector over its exact length; zero vectors stay as they are."""
    length = F.sqrt(dot(vector, vector))
    return F.when(length == 0, vector).otherwise(F.transform(vector, lambda x: x / length))


def zeros(size: int) -> Column:
    return F.array_repeat(F.lit(0.0), size)


def vector_sum(vector: Column, weight: Column | None = None) -> Column:
    """Element-wise sum as an aggregate with map-side partial sums."""
    dense = array_to_vector(vector)
    total = Summarizer.sum(dense) if weight is None else Summarizer.sum(dense, weight)
    return vector_to_array(total)


def vector_mean(vector: Column) -> Column:
    return vector_to_array(Summarizer.mean(array_to_vector(vector)))
