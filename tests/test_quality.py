"""Data tests fail on bad data and pass on good data."""

from tidewater.operators import quality


def test_checks_detect_problems(spark):
    df = spark.createDataFrame([("a", "gate_in"), ("a", "teleported"), (None, None), ("b", "delivered")],
                               "event_id string, event_type string")
    assert quality.unique(df, "event_id", "u").first().failures == 1          # "a" twice; NULL ignored
    assert quality.not_null(df, "event_id", "n").first().failures == 1
    assert quality.accepted_values(df, "event_type", ["gate_in", "delivered"], "v").first().failures == 1
    assert quality.row_count_equal(df, df.limit(2), "r").first().failures == 1
    assert quality.row_count_equal(df, df, "r").first().failures == 0
    assert quality.identical(df, df).first().failures == 0
    assert quality.identical(df, df.where("event_id = 'b'")).first().failures == 3


def test_checks_pass_on_clean_data(spark):
    df = spark.createDataFrame([("a", "gate_in"), ("b", "delivered")], "event_id string, event_type string")
    assert quality.unique(df, "event_id", "u").first().failures == 0
    assert quality.accepted_values(df, "event_type", ["gate_in", "delivered"], "v").first().failures == 0
