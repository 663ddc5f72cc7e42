"""Column profiles: counts, moments, range and exact quartiles.

The columns are unpivoted to (column number, value) rows, so that one small
aggregate serves all of them; a wide one outgrows what the JVM compiles.

Quartiles take two scans of the rows at any size: a mergeable sketch brackets
them, an exact pass counts what the brackets hold. With sketches kept from
before, by month for instance, the exact pass is the only one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tripflow.sources.files import remove
from tripflow.sources.scratch import scratch_path
from tripflow.sources.tables import read_table, write_table

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
SKETCH_SIZE = 4_000


def numeric_columns(rows: DataFrame) -> list[str]:
    return [f.name for f in rows.schema if isinstance(f.dataType, NumericType)]


def first_rows(rows: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    return (rows.orderBy(*order_by) if order_by else rows).limit(n)


def describe(
    rows: DataFrame, columns: Sequence[str], units: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per column: non-null count, mean, sample stddev, min, max.

    ``units`` as in :mod:`tripflow.functions.totals`.
    """
    return (
        _unpivoted(rows, columns)
        .groupBy("column")
        .agg(*_moments(columns, units))
        .transform(_named, columns)
    )


def _moments(columns: Sequence[str], units: Mapping[str, int] | None) -> list[Column]:
    value = F.col("value")
    mean = F.avg(value)
    if units:
        unit = _by_column([units.get(name) for name in columns], "long")
        exact_sum = F.sum(F.rint(value * unit).cast("long")) / F.first(unit).cast("double")
        mean = F.coalesce(F.try_divide(exact_sum, F.count(value)), mean)
    return [
        F.count(value).alias("value_count"),
        mean.alias("mean"),
        F.stddev(value).alias("stddev"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    ]


def summary(
    rows: DataFrame,
    columns: Sequence[str] | None = None,
    units: Mapping[str, int] | None = None,
) -> DataFrame:
    """:func:`describe` plus exact quartiles, for all numeric columns by default: two scans."""
    names = list(columns or numeric_columns(rows))
    first = _unpivoted(rows, names).groupBy("column").agg(*_moments(names, units), _sketch())
    first = _named(first, names)
    # One row per profiled column, with a sketch of some 70 KB.
    first = rows.sparkSession.createDataFrame(first.collect(), first.schema)
    sketches = first.select("column_name", "sketch")
    return first.drop("sketch").join(
        exact_quantiles(rows, names, QUARTILES, sketches=sketches), "column_name", "left"
    )


def quantile_sketches(
    rows: DataFrame, columns: Sequence[str], by: Sequence[str] = (), size: int = SKETCH_SIZE
) -> DataFrame:
    """(by, column_name, sketch): what :func:`exact_quantiles` needs to know of the rows at first.

    Sketches of parts of a table, such as its months, merge into one of the table.
    """
    sketches = _unpivoted(rows, columns, by).groupBy(*by, "column").agg(_sketch(size))
    return _named(sketches, columns)


def _sketch(size: int = SKETCH_SIZE) -> Column:
    value = F.when(~F.isnan("value"), F.col("value"))
    return F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch")


def exact_quantiles(
    rows: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    keep: int = 10_000_000,
    sketches: DataFrame | None = None,
    size: int = SKETCH_SIZE,
) -> DataFrame:
    """One row per column that has values, with linearly interpolated quantiles.

    ``sketches`` of exactly these rows, as :func:`quantile_sketches` makes them, in any
    number of parts, save the first scan; those of other rows raise. A column of more than
    ``keep`` values is counted value by value only within three times the rank error of its
    sketch around each quantile, and as lumps between. The counts go to a scratch table; what
    of it is still more than ``keep`` is split there, so no task sorts more and the rows are not
    read again. Brackets that turn out to miss their quantile are widened in a further scan.
    NaN is left out, as null is.
    """
    wanted = list(probabilities.values())
    given = sketches is not None
    if sketches is None:
        sketches = quantile_sketches(rows, columns, size=size)
    values = _unpivoted(rows, columns).where("value IS NOT NULL AND NOT isnan(value)")
    values = values.withColumn("copies", F.lit(1).cast("long"))
    spread = 3 * 2.3 / size**0.9
    sizes, brackets = _bracketed(sketches, columns, wanted, keep, spread)
    positions = [[p * max(known - 1, 0) for known in sizes] for p in wanted]
    if not given and max(sizes, default=0) <= keep:
        return _ranked(_counted(values, brackets), columns, probabilities, positions)

    spark = rows.sparkSession
    while True:
        path = scratch_path(spark, "quantiles")
        try:
            write_table(_counted(values, brackets), path)
            counted = read_table(spark, path)
            if _hit(counted, sizes, brackets, positions):
                brackets = _narrowed(counted, brackets, positions, keep)
                found = _ranked(_counted(counted, brackets), columns, probabilities, positions)
                # One short row per profiled column; the scratch table can go.
                return spark.createDataFrame(found.collect(), found.schema)
        finally:
            remove(spark, path)
        spread *= 4
        _, brackets = _bracketed(sketches, columns, wanted, keep, spread)


class _Bracket:
    """Two values per column with the wanted ones between them."""

    def __init__(self, columns: int):
        self.low, self.high = [-math.inf] * columns, [math.inf] * columns

    def holds(self, value: Column) -> Column:
        return value.between(_by_column(self.low), _by_column(self.high))

    def exceeded_by(self, value: Column) -> Column:
        return value > _by_column(self.high)


def _bracketed(
    sketches: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    keep: int,
    spread: float,
) -> tuple[list[int], list[_Bracket]]:
    """Values per column, and for each probability a bracket in the columns of over ``keep``."""
    ranks = [(max(p - spread, 0.0), min(p + spread, 1.0)) for p in probabilities]
    asked = F.array(*[F.lit(rank) for pair in ranks for rank in pair])
    merged = sketches.groupBy("column_name").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    seen = F.kll_sketch_get_n_double("sketch")
    # One row of a few numbers per profiled column.
    found = merged.select(
        "column_name",
        seen.alias("seen"),
        F.when(seen > keep, F.kll_sketch_get_quantile_double("sketch", asked)).alias("edges"),
    )
    by_name = {row.column_name: row for row in found.collect()}
    unknown = [name for name in columns if name not in by_name]
    if unknown and by_name:
        raise ValueError(f"no sketches of {unknown}")
    brackets = [_Bracket(len(columns)) for _ in probabilities]
    for column, name in enumerate(columns):
        edges = by_name[name].edges if name in by_name else None
        for number, (low, high) in enumerate(ranks if edges else ()):
            if low > 0:
                brackets[number].low[column] = edges[2 * number]
            if high < 1:
                brackets[number].high[column] = edges[2 * number + 1]
    return [by_name[name].seen if name in by_name else 0 for name in columns], brackets


def _counted(values: DataFrame, brackets: Sequence[_Bracket]) -> DataFrame:
    """(column, value, copies): value by value inside the brackets, as lumps between them.

    A lump stands at its lowest value, which is in no bracket.
    """
    value = F.col("value")
    inside, gap = F.lit(False), F.lit(0)
    for bracket in brackets:
        inside = inside | bracket.holds(value)
        gap = gap + bracket.exceeded_by(value).cast("int")
    grouped = values.groupBy(
        "column", F.when(inside, value).alias("kept"), F.when(~inside, gap).alias("gap")
    ).agg(F.min(value).alias("value"), F.sum("copies").alias("copies"))
    return grouped.select("column", "value", "copies")


def _sought(position: float, size: int) -> tuple[int, int]:
    lower = math.floor(position)
    return lower, min(lower + 1, size - 1)


def _hit(
    counted: DataFrame,
    sizes: Sequence[int],
    brackets: Sequence[_Bracket],
    positions: Sequence[Sequence[float]],
) -> bool:
    """Whether each bracket holds the values at its positions."""
    value, copies = F.col("value"), F.col("copies")
    totals = [F.sum("copies").alias("total")]
    for number, bracket in enumerate(brackets):
        below = F.sum(F.when(value < _by_column(bracket.low), copies).otherwise(0))
        inside = F.sum(F.when(bracket.holds(value), copies).otherwise(0))
        totals += [below.alias(f"below{number}"), inside.alias(f"inside{number}")]
    found = {int(row["column"]): row for row in counted.groupBy("column").agg(*totals).collect()}
    if any(size != (found[c].total if c in found else 0) for c, size in enumerate(sizes)):
        raise ValueError("the sketches are of other rows")
    for number, sought in enumerate(positions):
        for column, row in found.items():
            lower, upper = _sought(sought[column], sizes[column])
            below = row[f"below{number}"]
            if lower < below or upper >= below + row[f"inside{number}"]:
                return False
    return True


_CUTS = 64


def _narrowed(
    counted: DataFrame,
    brackets: Sequence[_Bracket],
    positions: Sequence[Sequence[float]],
    keep: int,
) -> list[_Bracket]:
    """Brackets with the same quantiles that hold at most about ``keep`` values each.

    Each turn cuts a bracket into cells of about equally many values, counts their copies and
    goes on with the cells that the positions are in.
    """
    value = F.col("value")
    brackets = list(brackets)
    before = math.inf
    while True:
        cuts = [step / _CUTS for step in range(1, _CUTS)]
        sketches = counted.groupBy("column").agg(
            *[F.count_if(b.holds(value)).alias(f"held{i}") for i, b in enumerate(brackets)],
            *[
                F.percentile_approx(F.when(b.holds(value), value), cuts).alias(f"cuts{i}")
                for i, b in enumerate(brackets)
            ],
        )
        # One row of a few hundred numbers per profiled column.
        found = {int(row["column"]): row for row in sketches.collect()}
        numbers = range(len(brackets))
        most = max((row[f"held{i}"] for row in found.values() for i in numbers), default=0)
        if most <= keep or most >= before:
            return brackets
        before = most
        cells = [_cell(bracket, i, found) for i, bracket in enumerate(brackets)]
        weights = (
            counted.select("column", "value", "copies", F.explode(F.array(*cells)).alias("at"))
            .groupBy("column", "at.bracket", "at.cell")
            .agg(F.sum("copies").alias("copies"), F.min(value).alias("low"), F.max(value).alias("high"))
        )
        by_bracket: dict[tuple[int, int], list] = {}
        for row in weights.collect():  # at most 66 rows per bracket and column
            by_bracket.setdefault((int(row["column"]), row.bracket), []).append(row)
        narrower = [_Bracket(len(b.low)) for b in brackets]
        for (column, number), rows in by_bracket.items():
            size = sum(row.copies for row in rows)
            lower, upper = _sought(positions[number][column], size)
            through = 0
            for row in sorted(rows, key=lambda row: row.cell):
                if through <= lower < through + row.copies:
                    narrower[number].low[column] = row.low
                if through <= upper < through + row.copies:
                    narrower[number].high[column] = row.high
                through += row.copies
        brackets = narrower


def _cell(bracket: _Bracket, number: int, found: Mapping) -> Column:
    """The bracket's number and a cell: -1 below it, 0 to 63 inside, 64 above."""
    value = F.col("value")
    cuts = [(found[c][f"cuts{number}"] if c in found else None) or [] for c in range(len(bracket.low))]
    arrays = [F.array(*[F.lit(cut) for cut in row]).cast("array<double>") for row in cuts]
    reached = F.size(F.filter(F.array(*arrays)[F.col("column").cast("int")], lambda cut: cut < value))
    cell = (
        F.when(value < _by_column(bracket.low), -1)
        .when(bracket.exceeded_by(value), _CUTS)
        .otherwise(reached)
    )
    return F.struct(F.lit(number).alias("bracket"), cell.alias("cell"))


def _ranked(
    counted: DataFrame,
    columns: Sequence[str],
    probabilities: Mapping[str, float],
    positions: Sequence[Sequence[float]],
) -> DataFrame:
    in_order = Window.partitionBy("column").orderBy("value")
    ranked = counted.withColumn("through", F.sum("copies").over(in_order)).withColumns(
        {name: _by_column(at) for name, at in zip(probabilities, positions)}
    )
    quantiles = ranked.groupBy("column").agg(
        *[_interpolated(name).alias(name) for name in probabilities]
    )
    return _named(quantiles, columns)


def _interpolated(position: str) -> Column:
    """The value at a fractional position of the running count."""
    lower = F.floor(position)
    below = F.min(F.when(F.col("through") > lower, F.col("value")))
    above = F.min(F.when(F.col("through") > lower + 1, F.col("value")))
    weight = F.first(F.col(position) - lower)
    above = F.coalesce(above, below)
    # Infinite values are taken as they are.
    between = (weight > 0) & (above > below)
    return F.when(between, below + (above - below) * weight).otherwise(below)


def _unpivoted(rows: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, value) with the columns numbered in the given order."""
    numbered = {str(number): name for number, name in enumerate(columns)}
    doubles = rows.select(
        *by,
        *[F.col(f"`{name}`").cast("double").alias(number) for number, name in numbered.items()],
    )
    return doubles.unpivot(list(by), list(numbered), "column", "value")


def _by_column(numbers: Sequence[float | None], kind: str = "double") -> Column:
    """The number at the place of the row's column; an array of constants."""
    return F.array(*[F.lit(n).cast(kind) for n in numbers])[F.col("column").cast("int")]


def _named(profile: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(name) for name in columns])
    named = profile.withColumn("column_name", names[F.col("column").cast("int")])
    return named.drop("column")
