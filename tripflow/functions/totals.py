"""Sums and means of trip measures, over rows or over stored partial sums.

A mean is a sum divided by the number of non-null values, both of which can be
merged, so one definition of a table serves the trips themselves
(:class:`TripTotals`) and a finer table of partial sums (:class:`RollupTotals`).

With ``units`` a measure is summed as an integer count of its smallest unit.
Such sums are exact and the same for every partitioning and every retry;
without, they are plain double sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


class TripTotals:
    def __init__(self, units: Mapping[str, int] | None = None):
        self.units = dict(units or {})

    def counted(self, measure: str) -> Column:
        """The measure as it is summed."""
        unit = self.units.get(measure)
        if unit is None:
            return F.col(measure)
        return F.rint(F.col(measure) * F.lit(unit)).cast("long")

    def in_wholes(self, measure: str, summed: Column) -> Column:
        unit = self.units.get(measure)
        return summed if unit is None else summed / F.lit(float(unit))

    def trips(self) -> Column:
        return F.count(F.lit(1))

    def known(self, measure: str) -> Column:
        return F.count(measure)

    def total(self, measure: str) -> Column:
        return self.in_wholes(measure, F.sum(self.counted(measure)))

    def mean(self, measure: str) -> Column:
        return F.try_divide(self.total(measure), self.known(measure))

    def highest(self, measure: str) -> Column:
        return F.max(measure)

    def lowest(self, measure: str) -> Column:
        return F.min(measure)


class RollupTotals(TripTotals):
    """The same over the columns that :func:`partial_sums` stores."""

    def trips(self) -> Column:
        return F.sum("trips")

    def known(self, measure: str) -> Column:
        return F.sum(f"{measure}_known")

    def total(self, measure: str) -> Column:
        return self.in_wholes(measure, F.sum(f"{measure}_sum"))

    def highest(self, measure: str) -> Column:
        return F.max(f"{measure}_max")

    def lowest(self, measure: str) -> Column:
        return F.min(f"{measure}_min")


def partial_sums(
    totals: TripTotals, summed: Iterable[str], ranged: Iterable[str] = ()
) -> list[Column]:
    columns = [totals.trips().alias("trips")]
    for measure in summed:
        columns.append(F.sum(totals.counted(measure)).alias(f"{measure}_sum"))
        columns.append(totals.known(measure).alias(f"{measure}_known"))
    for measure in ranged:
        columns.append(totals.highest(measure).alias(f"{measure}_max"))
        columns.append(totals.lowest(measure).alias(f"{measure}_min"))
    return columns
