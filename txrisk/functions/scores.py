"""Scores out of probability vectors, arrays and their text form."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def probability_array(df: DataFrame, column: str = "probability") -> Column:
    """The probabilities as ``array<double>`` from a vector, an array or ``"[p0,p1]"``."""
    kind = df.schema[column].dataType.typeName()
    if kind == "array":
        return F.col(column)
    if kind == "string":
        return F.from_json(column, "array<double>")
    return vector_to_array(F.col(column))


def probability_vector(df: DataFrame, column: str = "probability") -> Column:
    """The probabilities as an ML vector."""
    return array_to_vector(probability_array(df, column))


def probability_text(df: DataFrame, column: str = "probability") -> Column:
    """The probabilities as ``"[p0,p1]"``."""
    items = F.transform(probability_array(df, column), lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def score_of(df: DataFrame, which: str = "positive", column: str = "probability") -> Column:
    """One number per row out of the class probabilities.

    ``positive`` is the probability of class 1. ``unpredicted`` is that of the
    class that was not predicted, in single precision: p0 where the prediction
    is 1 and p1 elsewhere.
    """
    p = probability_array(df, column)
    if which == "positive":
        return p[1]
    if which == "unpredicted":
        return F.when(F.col("prediction") == 1, p[0].cast("float")).otherwise(p[1].cast("float"))
    raise ValueError(f"unknown score {which!r}")
