"""Numeric cleaning and rate expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_number(text: Column) -> Column:
    """Text as a double; anything that is not a number becomes null."""
    return text.try_cast("double")


def to_id(text: Column) -> Column:
    """Text such as ``12`` or ``12.0`` as a whole id; bad text becomes null."""
    return F.coalesce(text.try_cast("long"), finite(to_number(text)).try_cast("long"))


def finite(value: Column) -> Column:
    """The value, or null where it is infinite or not a number."""
    infinite = F.lit(float("inf")).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != infinite), value)


def clean_nonfinite(df: DataFrame) -> DataFrame:
    """Every floating column with infinities and NaN turned into null."""
    floats = {
        field.name: finite(F.col(field.name))
        for field in df.schema.fields
        if isinstance(field.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def rate_per_nine(count: Column, volume: Column) -> Column:
    """``count / volume * 9``; null where the volume is zero or missing."""
    return F.try_divide(count, volume) * 9


def add_rate_stats(df: DataFrame) -> DataFrame:
    """Walk and home-run rates per nine units of volume."""
    return df.withColumns(
        {
            "bb9": finite(rate_per_nine(F.col("bb").cast("double"), F.col("ip").cast("double"))),
            "hr9": finite(rate_per_nine(F.col("hr").cast("double"), F.col("ip").cast("double"))),
        }
    )
