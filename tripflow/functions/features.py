"""Derived trip columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.functions.rules import all_of
from tripflow.schema import DROPOFF, PAYMENT_LABELS, PICKUP


def minutes_on_road() -> Column:
    """Whole seconds between pickup and dropoff, in minutes; negative when reversed."""
    seconds = F.unix_timestamp(F.col(DROPOFF)) - F.unix_timestamp(F.col(PICKUP))
    return seconds / F.lit(60)


def miles_per_hour(where: str, otherwise: float | None) -> Column:
    """Speed over ``trip_duration_minutes`` where the condition holds."""
    hours = F.col("trip_duration_minutes") / F.lit(60)
    speed = F.try_divide(F.col("trip_distance"), hours)
    return F.when(F.expr(where), speed).otherwise(F.lit(otherwise).cast("double"))


def tip_share() -> Column:
    """Tip in percent of the fare, 0 without a positive fare."""
    percent = F.try_divide(F.col("tip_amount"), F.col("fare_amount")) * F.lit(100)
    return F.when(F.expr("fare_amount > 0"), percent).otherwise(F.lit(0.0))


def score(full_marks: Mapping[str, str]) -> Column:
    """1.0 for rows that meet all the rules, else 0.5."""
    return F.when(all_of(full_marks), F.lit(1.0)).otherwise(F.lit(0.5))


def payment_label(code: str = "payment_type") -> Column:
    pairs = []
    for number, label in PAYMENT_LABELS.items():
        pairs += [F.lit(number).cast("long"), F.lit(label)]
    known = F.try_element_at(F.create_map(*pairs), F.col(code).cast("long"))
    return F.coalesce(known, F.concat(F.lit("Type "), F.coalesce(F.col(code).cast("string"), F.lit("None"))))
