"""Functions rounded as the C library rounds them. Spark's are the JVM's, which differ in the last bit for some values in ten
thousand; where equal distances are told apart by that bit, results would differ from those of engines that call the library."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _finite(values: pd.Series, f) -> pd.Series:
    """f of each finite value, by Python's math: numpy has versions of its own."""
    return pd.Series([f(v) if math.isfinite(v) else None for v in values.tolist()], dtype="float64")


@F.pandas_udf(DoubleType())
def cos(angle: pd.Series) -> pd.Series:
    return _finite(angle, math.cos)


@F.pandas_udf(DoubleType())
def sin(angle: pd.Series) -> pd.Series:
    return _finite(angle, math.sin)


@F.pandas_udf(DoubleType())
def square(v: pd.Series) -> pd.Series:
    """pow(v, 2), which is not always v * v."""
    return _finite(v, lambda a: math.pow(a, 2.0))
