import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.operators import profile


@pytest.fixture(scope="module")
def numbers(spark):
    """A third of one column is one value; others are wide, tiny, constant or empty."""
    n = F.col("id")
    return (
        spark.range(20_000, numPartitions=7)
        .select(
            F.when(n % 3 == 0, F.lit(5.0)).otherwise((n * 7919 % 20011) / 100).alias("hot"),
            ((n * 104729 % 1_000_003) / 7).alias("wide"),
            F.when(n < 7, n.cast("int")).alias("few"),
            F.lit(3).alias("constant"),
            F.lit(None).cast("double").alias("empty"),
        )
        .cache()
    )


PROBABILITIES = {"low": 0.01, "q25": 0.25, "q50": 0.5, "q75": 0.75, "end": 1.0}


def check(found, numbers, probabilities=PROBABILITIES):
    found = {row.column_name: row for row in found.collect()}
    assert "empty" not in found
    local = numbers.toPandas()
    for name in ("hot", "wide", "few", "constant"):
        for label, p in probabilities.items():
            expected = np.quantile(local[name].dropna().to_numpy(float), p)
            assert math.isclose(found[name][label], expected, rel_tol=1e-12), (name, label)


@pytest.mark.parametrize("keep, size", [(5, 100), (50, 4_000), (300, 1_000), (1_000_000, 4_000)])
def test_quantiles_are_exact(numbers, keep, size):
    """A low ``keep`` needs brackets, which are split again; the high one keeps everything."""
    check(profile.exact_quantiles(numbers, numbers.columns, PROBABILITIES, keep, size=size), numbers)


def test_sketches_of_parts_save_a_scan(numbers, monkeypatch):
    parts = numbers.withColumn("part", F.when(F.col("wide") < 40_000, 1).when(F.col("hot") < 50, 2))
    sketches = profile.quantile_sketches(parts, numbers.columns, ["part"])
    assert sketches.count() == 3 * len(numbers.columns)
    check(profile.exact_quantiles(numbers, numbers.columns, PROBABILITIES, 40, sketches), numbers)
    with pytest.raises(ValueError, match="other rows"):
        profile.exact_quantiles(numbers.limit(19_000), numbers.columns, PROBABILITIES, 40, sketches)
    with pytest.raises(ValueError, match="no sketches of"):
        profile.exact_quantiles(parts, ["hot", "part"], PROBABILITIES, 40, sketches)


def test_a_bracket_that_misses_is_widened(numbers, monkeypatch):
    tried, bracketed = [], profile._bracketed

    def missing(sketches, columns, probabilities, keep, spread):
        tried.append(spread)
        off = [min(p + 0.2, 1.0) for p in probabilities] if len(tried) == 1 else probabilities
        return bracketed(sketches, columns, off, keep, spread)

    monkeypatch.setattr(profile, "_bracketed", missing)
    check(profile.exact_quantiles(numbers, numbers.columns, PROBABILITIES, 40), numbers)
    assert len(tried) == 2 and tried[1] == 4 * tried[0]


def test_brackets_end_up_small(numbers):
    values = numbers.select(F.lit("0").alias("column"), F.col("wide").alias("value"), F.lit(1).alias("copies"))
    (bracket,) = profile._narrowed(values, [profile._Bracket(1)], [[9_999.5]], keep=20)
    assert values.where(bracket.holds(F.col("value"))).count() <= 20


def test_two_scans(spark, tmp_path):
    """At any size the rows are read twice; with sketches, once."""
    reads = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.range(4_000).select((F.col("id") * 7919 % 4001 / 8).alias("a"), (F.col("id") % 9).alias("b"))
    watched = rows.mapInArrow(counting, rows.schema)
    for keep in (50, 10_000):
        reads.value = 0
        profile.exact_quantiles(watched, ["a", "b"], profile.QUARTILES, keep).collect()
        assert reads.value == 8_000
    reads.value = 0
    profile.summary(watched).collect()
    assert reads.value == 8_000
    sketches = profile.quantile_sketches(rows, ["a", "b"])
    reads.value = 0
    profile.exact_quantiles(watched, ["a", "b"], profile.QUARTILES, 50, sketches).collect()
    assert reads.value == 4_000


def test_nan_is_left_out(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,), (float("inf"),)], "a double")
    for keep in (1, 100):
        row = profile.exact_quantiles(rows, ["a"], {"q0": 0.0, "q50": 0.5, "q100": 1.0}, keep).first()
        assert (row.q0, row.q50, row.q100) == (1.0, 3.0, math.inf)


def test_nothing_to_rank(numbers):
    assert profile.exact_quantiles(numbers, ["empty"], {"q50": 0.5}).collect() == []


def test_summary(numbers):
    rows = {row.column_name: row for row in profile.summary(numbers).collect()}
    local = numbers.toPandas().describe()
    for name in ("hot", "wide", "few", "constant"):
        row = rows[name]
        expected = local[name]
        assert row.value_count == expected["count"]
        for ours, theirs in (
            (row["mean"], "mean"),
            (row["stddev"], "std"),
            (row["min"], "min"),
            (row["max"], "max"),
            (row["q25"], "25%"),
            (row["q50"], "50%"),
            (row["q75"], "75%"),
        ):
            assert math.isclose(ours, expected[theirs], rel_tol=1e-9, abs_tol=1e-12), (name, theirs)
    assert (rows["empty"].value_count, rows["empty"].q50) == (0, None)


def test_describe_in_units(spark):
    rows = spark.createDataFrame([(0.1, 1), (0.2, 2), (0.3, 4)], "amount double, n int")
    found = {r.column_name: r for r in profile.describe(rows, ["amount", "n"], {"amount": 10}).collect()}
    assert found["amount"]["mean"] == 0.6 / 3
    assert found["n"]["mean"] == 7 / 3


def test_first_rows(spark):
    assert [r.id for r in profile.first_rows(spark.range(10), 3, ["id"]).collect()] == [0, 1, 2]
    assert profile.first_rows(spark.range(10), 4).count() == 4
