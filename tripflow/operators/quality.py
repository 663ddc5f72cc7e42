"""Data quality as (metric, score) rows.

Completeness, validity and consistency share one pass that shuffles a single
row per task. Uniqueness needs a shuffle of its own. Counts kept by month merge
into the same metrics, so that a new month costs one month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.digest import row_digest
from tripflow.functions.rules import CONSISTENT_TOTAL, VALID_TRIP, all_of
from tripflow.schema import PICKUP

# Names of the metrics, columns a rate needs, limits of the grades.
VALIDITY, CONSISTENCY, UNIQUENESS = "business_rule_validity", "amount_consistency", "uniqueness"
_VALIDITY_NEEDS = ("trip_distance", "fare_amount", "trip_duration_minutes", "passenger_count")
_CONSISTENCY_NEEDS = ("total_amount", "fare_amount", "extra", "mta_tax")
PASS_FROM, WARN_FROM = 0.95, 0.80


def _share_of_rows(count: Column) -> Column:
    """Null, not an error, when there are no rows."""
    return F.try_divide(count, F.count(F.lit(1)))


def _shares(hits: Mapping[str, Column]) -> dict[str, Column]:
    return {metric: _share_of_rows(count) for metric, count in hits.items()}


def completeness(rows: DataFrame) -> dict[str, Column]:
    return _shares(_complete(rows))


def validity(rows: DataFrame) -> dict[str, Column]:
    return _shares(_valid(rows))


def consistency(rows: DataFrame) -> dict[str, Column]:
    return _shares(_consistent(rows))


def _complete(rows: DataFrame) -> dict[str, Column]:
    return {f"{name}_completeness": F.count(f"`{name}`") for name in rows.columns}


def _valid(rows: DataFrame) -> dict[str, Column]:
    return _hits_if_present(rows, VALIDITY, _VALIDITY_NEEDS, VALID_TRIP)


def _consistent(rows: DataFrame) -> dict[str, Column]:
    return _hits_if_present(rows, CONSISTENCY, _CONSISTENCY_NEEDS, CONSISTENT_TOTAL)


def _hits_if_present(
    rows: DataFrame, metric: str, needs: Sequence[str], rules: Mapping[str, str]
) -> dict[str, Column]:
    if not set(needs) <= set(rows.columns):
        return {}
    return {metric: F.count_if(all_of(rules))}


def measure(rows: DataFrame, rates: Mapping[str, Column]) -> DataFrame:
    """All rates in one aggregate, turned into (position, metric, score) rows."""
    scored = rows.agg(_listed(rates, "score").alias("scores"))
    return scored.select(F.inline("scores"))


def _listed(values: Mapping[str, Column], name: str, first: int = 0) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(position).alias("position"), F.lit(metric).alias("metric"), value.alias(name)
            )
            for position, (metric, value) in enumerate(values.items(), first)
        ]
    )


def uniqueness(
    rows: DataFrame, columns: Sequence[str] | None = None, whole_rows: bool = False
) -> DataFrame:
    """(metric, score): distinct rows over rows.

    Rows are told apart by a 128-bit digest, so 16 bytes per distinct row of a
    task are shuffled instead of the row. Two of 10^12 different rows share a
    digest with probability 10^-15. ``whole_rows=True`` compares the rows.
    """
    names = list(columns or rows.columns)
    identities = rows.select(
        *([F.col(f"`{name}`") for name in names] if whole_rows else row_digest(names))
    )
    # Copies combine per task, so a row with a million copies is one row per task.
    copies = identities.groupBy(*[f"`{name}`" for name in identities.columns]).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    return _unique_share(copies)


def _unique_share(copies: DataFrame) -> DataFrame:
    share = F.try_divide(F.count(F.lit(1)), F.sum("__copies"))
    return copies.agg(share.alias("score")).select(F.lit(UNIQUENESS).alias("metric"), "score")


def quality_metrics(
    rows: DataFrame, unique_columns: Sequence[str] | None = None, whole_rows: bool = False
) -> DataFrame:
    """Every metric as (position, metric, score)."""
    rates = completeness(rows) | validity(rows) | consistency(rows)
    unique = uniqueness(rows, unique_columns, whole_rows).select(
        F.lit(len(rates)).alias("position"), "metric", "score"
    )
    return measure(rows, rates).unionByName(unique)


# --- by month ----------------------------------------------------------------

ROWS = "rows"


def month_decides(columns: Sequence[str] | None, month: Sequence[str]) -> bool:
    """Whether rows equal in ``columns`` are of one month, so that distinct rows add up."""
    return columns is None or PICKUP in columns or set(month) <= set(columns)


def monthly_counts(
    rows: DataFrame, month: Sequence[str], unique_columns: Sequence[str] | None = None
) -> DataFrame:
    """(month, position, metric, hits, over): counts of which the metrics of all months are sums.

    A few dozen rows a month. Distinct rows are counted where they add up over months
    (:func:`month_decides`); elsewhere :func:`monthly_digests` has to be kept as well.
    ``over`` repeats ``unique_columns``. Rows without a month are a month of their own.
    """
    hits = _complete(rows) | _valid(rows) | _consistent(rows)
    counted = {ROWS: F.count(F.lit(1))} | hits
    counts = rows.groupBy(*month).agg(_listed(counted, "hits", -1).alias("counts"))
    counts = counts.select(*month, F.inline("counts"))
    if month_decides(unique_columns, month):
        identities = rows.select(*month, *row_digest(unique_columns or rows.columns)).distinct()
        distinct = identities.groupBy(*month).agg(F.count(F.lit(1)).alias("hits"))
        counts = counts.unionByName(
            distinct.withColumns({"position": F.lit(len(hits)), "metric": F.lit(UNIQUENESS)})
        )
    over = F.lit(None) if unique_columns is None else F.array(*map(F.lit, unique_columns))
    return counts.withColumn("over", over.cast("array<string>"))


def monthly_digests(rows: DataFrame, month: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(month, digest, copies): one row of 24 bytes per distinct row of a month."""
    identities = rows.select(*month, *row_digest(columns))
    return identities.groupBy(*identities.columns).agg(F.count(F.lit(1)).alias("copies"))


def merged_metrics(counts: DataFrame, digests: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`quality_metrics` over all months, from their counts alone.

    A column that some months lack counts as null there.
    """
    total = counts.where(F.col("metric") == ROWS).agg(F.sum("hits")).scalar()
    metrics = (
        counts.where(F.col("metric") != ROWS)
        .groupBy("metric")
        .agg(F.max("position").alias("position"), F.sum("hits").alias("hits"))
        .select("position", "metric", F.try_divide("hits", total).alias("score"))
    )
    if digests is None:
        return metrics
    copies = digests.groupBy("digest_forward", "digest_backward").agg(
        F.sum("copies").alias("__copies")
    )
    last = counts.agg(F.max("position") + 1).scalar()
    return metrics.unionByName(_unique_share(copies).withColumn("position", last))


def graded(metrics: DataFrame) -> DataFrame:
    score = F.col("score")
    status = (
        F.when(score.isNull(), "EMPTY")
        .when(score >= PASS_FROM, "PASS")
        .when(score >= WARN_FROM, "WARN")
        .otherwise("FAIL")
    )
    return metrics.withColumn("status", status)


def report_lines(grades: DataFrame) -> DataFrame:
    """``metric: 12.34% - STATUS``, one line per metric."""
    percent = F.when(
        F.col("score").isNotNull(), F.format_string("%.2f%%", F.col("score") * 100)
    ).otherwise("n/a")
    line = F.concat(F.col("metric"), F.lit(": "), percent, F.lit(" - "), F.col("status"))
    return grades.withColumn("line", line)


def report_text(grades: DataFrame) -> str:
    """The report for a log: one short row per column of the table checked."""
    lines = report_lines(grades).orderBy("position").select("line").collect()
    return "\n".join(row.line for row in lines)
