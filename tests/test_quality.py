import pytest
from conftest import trip

from tripflow.operators import quality
from tripflow.operators.silver import with_features


def scores(metrics):
    return {row.metric: row.score for row in metrics.collect()}


def test_all_metrics(trips):
    rows = with_features(
        trips(
            trip(),
            trip(),
            trip(passenger_count=None),
            trip(total_amount=1.0, airport_fee=None),
            trip(extra=None),
        )
    )
    found = scores(quality.quality_metrics(rows))
    assert len(found) == len(rows.columns) + 3
    assert found["passenger_count_completeness"] == 0.8
    assert found["airport_fee_completeness"] == 0.8
    assert found["VendorID_completeness"] == 1.0
    assert found["business_rule_validity"] == 0.8
    # A null part makes the total inconsistent.
    assert found["amount_consistency"] == 0.6
    assert found["uniqueness"] == 0.8


def test_rates_need_their_columns(trips):
    rows = trips(trip()).drop("mta_tax")
    found = scores(quality.quality_metrics(rows))
    assert "amount_consistency" not in found
    assert "business_rule_validity" not in found  # no duration yet
    assert "uniqueness" in found


def test_empty_table_has_null_scores(trips):
    rows = with_features(trips(trip())).where("false")
    grades = quality.graded(quality.quality_metrics(rows)).collect()
    assert {row.score for row in grades} == {None}
    assert {row.status for row in grades} == {"EMPTY"}


@pytest.mark.parametrize(
    "score, status",
    [(1.0, "PASS"), (0.95, "PASS"), (0.9499, "WARN"), (0.8, "WARN"), (0.7999, "FAIL"), (0.0, "FAIL")],
)
def test_grades(spark, score, status):
    metrics = spark.createDataFrame([(0, "m", score)], "position int, metric string, score double")
    assert quality.graded(metrics).first().status == status


def test_report_text(spark):
    metrics = spark.createDataFrame(
        [(1, "b", 0.5), (0, "a", 0.98765), (2, "c", None)],
        "position int, metric string, score double",
    )
    text = quality.report_text(quality.graded(metrics))
    assert text.splitlines() == ["a: 98.77% - PASS", "b: 50.00% - FAIL", "c: n/a - EMPTY"]


@pytest.mark.parametrize("whole_rows", [False, True])
def test_uniqueness_tells_swapped_values_apart(spark, whole_rows):
    rows = spark.createDataFrame(
        [
            (1, None, "x"),
            (None, 1, "x"),
            (1, None, "x"),
            (1, 1, None),
            (None, None, None),
            (None, None, None),
            (2, 1, "x"),
            (1, 2, "x"),
        ],
        "a int, b int, c string",
    )
    assert quality.uniqueness(rows, whole_rows=whole_rows).first().score == 6 / 8


def test_uniqueness_over_many_columns(spark):
    """More columns than null flags fit into one long."""
    names = [f"c{i}" for i in range(70)]
    first = [None] * 70
    second = list(first)
    second[69] = 0
    schema = ", ".join(f"{name} int" for name in names)
    rows = spark.createDataFrame([tuple(first), tuple(second), tuple(first)], schema)
    assert quality.uniqueness(rows).first().score == 2 / 3


def test_zero_signs_are_equal(spark):
    rows = spark.createDataFrame([(0.0,), (-0.0,)], "a double")
    assert quality.uniqueness(rows).first().score == 0.5
    assert quality.uniqueness(rows, whole_rows=True).first().score == 0.5
