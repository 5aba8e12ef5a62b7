"""Expectations fixture: null time, null value, value 1, value 2, null location."""
import pytest
from pyspark.sql import functions as F

from tidewater.operators import quality as q

RULES = {"time_is_valid": "TRY_CAST(MeasurementDateTime AS TIMESTAMP) IS NOT NULL",
         "value_above_one": "SensorValue > 1", "location_present": "SensorLocation IS NOT NULL"}


@pytest.fixture()
def rows(spark):
    data = [(1, None, 5.0, "a"), (2, "2024-01-01 00:00:00", None, "a"), (3, "2024-01-01 00:00:00", 1.0, "a"),
            (4, "2024-01-01 00:00:00", 2.0, "a"), (5, "2024-01-01 00:00:00", 2.0, None)]
    return spark.createDataFrame(data, "Id int, MeasurementDateTime string, SensorValue double, SensorLocation string")


def test_drop_keeps_complete_rows(rows):
    assert [r["Id"] for r in q.expect_or_drop(rows, RULES).collect()] == [4]


def test_quarantine_lists_failed_rules(rows):
    out = {r["Id"]: r["failed_rules"] for r in q.quarantine(rows, RULES).collect()}
    assert out == {1: ["time_is_valid"], 2: ["value_above_one"], 3: ["value_above_one"],
                   5: ["location_present"]}


def test_counts_and_observation(rows):
    c = q.expectation_counts(rows, RULES).first()
    assert (c["rows"], c["dropped"], c["failed_value_above_one"]) == (5, 4, 2)
    df, obs = q.expect(rows, RULES)
    assert df.count() == 5 and obs.get["failed_location_present"] == 1


def test_fail_raises(rows):
    with pytest.raises(Exception, match="expectation failed"):
        q.expect_or_fail(rows, RULES).collect()
    assert q.expect_or_fail(rows.filter(F.col("Id") == 4), RULES).count() == 1
