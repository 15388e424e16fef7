"""Shuffled and repartitioned input must give identical facts (keep-first is
deterministic, not whatever row a task happens to see first)."""

from pyspark.sql import functions as F

from cartwheel.operators.facts import build_fact_order_products, build_fact_orders
from cartwheel.schemas import ROW_INDEX
from cartwheel.sources.fixtures import raw_orders
from conftest import SF_SMALL


def rows_of(df):
    return sorted(tuple(r) for r in df.drop("loaded_at").collect())


def check_permutations(doubled):
    base_o, base_p = rows_of(build_fact_orders(doubled)), rows_of(build_fact_order_products(doubled))
    for seed in (1, 2):
        shuffled = doubled.orderBy(F.rand(seed)).repartition(5)
        assert rows_of(build_fact_orders(shuffled)) == base_o
        assert rows_of(build_fact_order_products(shuffled)) == base_p
    return base_o


def test_duplicate_rows_with_positions(spark):
    raw = raw_orders(spark, SF_SMALL).cache()
    # Every order appears twice; the copy is a later source row.
    copy = (raw.withColumn("eval_set", F.lit("zzz"))
            .withColumn(ROW_INDEX, F.col(ROW_INDEX) + F.lit(10 ** 9)))
    orders = check_permutations(raw.unionByName(copy))
    assert all(r[6] != "zzz" for r in orders)      # the earlier row wins
    raw.unpersist()


def test_duplicate_rows_without_positions(spark):
    raw = raw_orders(spark, SF_SMALL).drop(ROW_INDEX).cache()
    # No row positions at all: ties are broken by the rows' own values.
    check_permutations(raw.unionByName(raw.withColumn("eval_set", F.lit("zzz"))))
    raw.unpersist()
