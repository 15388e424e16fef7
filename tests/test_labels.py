import pytest
from pyspark.sql import functions as F

from cartwheel.functions.labels import basket_size_category, day_name, hour_label, reorder_interval

INTERVALS = [(None, "Unknown"), (float("nan"), "Unknown"), (0.0, "Same Day"), (0.5, "Unknown"),
             (1.0, "1-7 Days"), (7.0, "1-7 Days"), (7.5, "Unknown"), (8.0, "8-14 Days"),
             (14.0, "8-14 Days"), (15.0, "15-21 Days"), (21.0, "15-21 Days"),
             (21.5, ">21 Days"), (-1.0, "Unknown")]


def test_reorder_interval(spark):
    from cartwheel.functions.coerce import to_double
    from pyspark.sql import types as T
    df = spark.createDataFrame([(v,) for v, _ in INTERVALS], "d double")
    # NaN arrives as NULL after ingest coercion.
    got = [r.x for r in df.select(reorder_interval(to_double(F.col("d"), T.DoubleType())).alias("x")).collect()]
    assert got == [label for _, label in INTERVALS]


@pytest.mark.parametrize("n,label", [(1, "Small Basket (1-5)"), (5, "Small Basket (1-5)"),
                                     (6, "Medium Basket (6-10)"), (10, "Medium Basket (6-10)"),
                                     (11, "Large Basket (11-20)"), (20, "Large Basket (11-20)"),
                                     (21, "Very Large Basket (>20)"), (0, "Unknown")])
def test_basket_size(spark, n, label):
    df = spark.createDataFrame([(n,)], "n long")
    assert df.select(basket_size_category(F.col("n")).alias("x")).first().x == label


def test_day_names_and_hours(spark):
    df = spark.createDataFrame([(d, h) for d, h in [(0, 7), (6, 23), (-1, 0), (7, 12), (None, None)]],
                               "d long, h long")
    got = [tuple(r) for r in df.select(day_name(F.col("d")), hour_label(F.col("h"))).collect()]
    assert got == [("Sunday", "7:00"), ("Saturday", "23:00"), ("Unknown", "0:00"),
                   ("Unknown", "12:00"), ("Unknown", None)]
