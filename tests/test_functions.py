from datetime import datetime, timezone

from pyspark.sql import functions as F

from ledgerlift.functions.columns import (
    ceil_div,
    detection_time_string,
    name_contains,
    percent_of,
    weight_or_default,
)


def test_detection_time_is_kolkata_wall_clock():
    utc = datetime(2025, 8, 8, 19, 24, 5, tzinfo=timezone.utc)
    assert detection_time_string(utc) == "2025-08-09 00:54:05"


def test_column_helpers(spark):
    df = spark.createDataFrame([(None, 7, 3, "Data_Transactions.CSV")],
                               "w double, n long, d long, name string")
    r = df.select(weight_or_default("w").alias("w"), ceil_div("n", "d").alias("c"),
                  percent_of(F.col("d"), F.col("n")).alias("p"),
                  name_contains("name", "transactions.csv").alias("hit")).first()
    assert (r.w, r.c, r.p, r.hit) == (1.0, 3, 42.9, True)
