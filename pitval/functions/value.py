"""Value-over-time expressions. All are plain column arithmetic, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitval import constants as C


def decline_rate(age: Column) -> Column:
    """Share of value lost at this age: none up to the peak, then linear, capped."""
    past_peak = age - F.lit(C.PEAK_AGE)
    return F.when(age <= C.PEAK_AGE, F.lit(0.0)).otherwise(
        F.least(C.DECLINE_SLOPE * past_peak + F.lit(C.DECLINE_OFFSET), F.lit(C.DECLINE_CAP))
    )


def value_path(value: Column, age: Column, horizon: int = C.HORIZON_YEARS) -> list[Column]:
    """Value in each year of the horizon; the first is untouched, later ones compound."""
    path = [value]
    for year in range(1, horizon):
        path.append(path[-1] * (F.lit(1) - decline_rate(age + year)))
    return path


def surplus(
    path: list[Column],
    costs: list[Column],
    value_per_unit: float = C.VALUE_PER_UNIT,
    discount_rate: float = C.DISCOUNT_RATE,
) -> Column:
    """Discounted value less undiscounted cost, summed over the horizon."""
    total = F.lit(0.0)
    for year, (value, cost) in enumerate(zip(path, costs, strict=True)):
        total = total + (value * value_per_unit / F.lit((1 + discount_rate) ** year) - cost)
    return total


def realized_value(
    outcome: Column, cost: Column, value_per_unit: float = C.VALUE_PER_UNIT
) -> Column:
    """Value actually produced less what it cost."""
    return outcome * value_per_unit - cost
