import pytest
from pyspark.sql import functions as F

from cartwheel.operators.facts import (
    MissingColumnsError,
    build_fact_order_products,
    build_fact_orders,
)
from cartwheel.plans import dashboard as Q
from cartwheel.plans import quality as D
from cartwheel.schemas import FACT_ORDER_PRODUCTS_COLUMNS, FACT_ORDERS_COLUMNS, ORDER_COLUMNS
from conftest import raw_frame


def test_fact_orders_semantics(spark):
    rows = [
        ("1", "10", "1", "0", "7", "", "prior", ""),        # kept
        ("1", "11", "2", "1", "8", "3", "train", ""),       # duplicate order_id: dropped
        ("2", None, "1", "0", "7", None, "prior", '[{"product_id":5}]'),  # null user → dropped
        (None, "12", "1", "0", "7", None, "prior", ""),     # null order_id → dropped
        ("3", "13", "1", "-1", "24", "NaN", None, None),    # kept; bad ranges are kept
        ("4.0", "14", "x", "3", "1", "2.5", "test", None),  # '4.0' → 4, bad order_number → NULL
    ]
    fo = build_fact_orders(raw_frame(spark, rows))
    assert fo.columns == FACT_ORDERS_COLUMNS
    got = {r.order_id: r for r in fo.collect()}
    assert sorted(got) == [1, 3, 4]
    assert got[1].user_id == 10 and got[1].days_since_prior_order is None
    assert got[3].eval_set == "" and got[3].days_since_prior_order is None
    assert got[3].order_dow == -1 and got[3].order_hour_of_day == 24
    assert got[4].order_number is None and got[4].days_since_prior_order == 2.5


def test_products_keep_orphans(spark):
    rows = [("2", None, "1", "0", "7", None, "prior", '[{"product_id":5},{"product_id":6}]'),
            ("3", "1", "1", "0", "7", None, "prior", '[{"product_id":7}]')]
    raw = raw_frame(spark, rows)
    fo, fp = build_fact_orders(raw), build_fact_order_products(raw)
    assert fp.columns == FACT_ORDER_PRODUCTS_COLUMNS
    assert fp.count() == 3
    orphan = D.dq_orphan_products(fo, fp).first()
    assert (orphan.orphan_product_rows, orphan.orphan_orders) == (2, 1)


def test_products_dedup_across_duplicate_order_rows(spark):
    rows = [("1", "1", "1", "0", "7", None, "prior", '[{"product_id":5,"add_to_cart_order":1}]'),
            ("1", "1", "1", "0", "7", None, "prior",
             '[{"product_id":5,"add_to_cart_order":1},{"product_id":6,"add_to_cart_order":2}]')]
    fp = build_fact_order_products(raw_frame(spark, rows))
    assert sorted((r.product_id, r.add_to_cart_order) for r in fp.collect()) == [(5, 1), (6, 2)]


def test_missing_products_column_gives_empty_table(spark):
    rows = [("1", "1", "1", "0", "7", None, "prior")]
    raw = raw_frame(spark, rows, columns=ORDER_COLUMNS)
    fp = build_fact_order_products(raw)
    assert fp.columns == FACT_ORDER_PRODUCTS_COLUMNS and fp.count() == 0
    assert build_fact_orders(raw).count() == 1


def test_missing_order_column_is_an_error(spark):
    cols = [c for c in ORDER_COLUMNS if c != "user_id"]
    raw = raw_frame(spark, [("1", "1", "0", "7", None, "prior")], columns=cols)
    with pytest.raises(MissingColumnsError, match="user_id"):
        build_fact_orders(raw)


def test_per_file_dedup_and_row_order(spark):
    schema = ("source_file string, row_index long, order_id string, user_id string, "
              "order_number string, order_dow string, order_hour_of_day string, "
              "days_since_prior_order string, eval_set string, products string")
    rows = [("a", 1, "1", "20", "1", "0", "7", None, "late", '[{"product_id":1,"product_name":"b"}]'),
            ("a", 0, "1", "10", "1", "0", "7", None, "early", '[{"product_id":1,"product_name":"a"}]'),
            ("b", 0, "1", "30", "1", "0", "7", None, "other", '[{"product_id":1,"product_name":"c"}]')]
    raw = spark.createDataFrame(rows, schema)
    fo = build_fact_orders(raw).orderBy("user_id").collect()
    assert [(r.user_id, r.eval_set) for r in fo] == [(10, "early"), (30, "other")]
    fp = build_fact_order_products(raw).orderBy("product_name").collect()
    assert [r.product_name for r in fp] == ["a", "c"]
    dup = D.dq_order_duplicates(build_fact_orders(raw)).first()
    assert (dup.total_rows, dup.unique_orders, dup.duplicate_orders) == (2, 1, 1)


def test_largest_basket_counts_duplicate_orders(spark):
    schema = ("source_file string, order_id string, user_id string, order_number string, "
              "order_dow string, order_hour_of_day string, days_since_prior_order string, "
              "eval_set string, products string")
    rows = [("a", "1", "5", "1", "1", "9", None, "prior",
             '[{"product_id":1,"add_to_cart_order":1},{"add_to_cart_order":2}]'),
            ("b", "1", "5", "1", "1", "9", None, "prior", "[]"),
            ("a", "2", "6", "1", "2", "10", None, "prior", "")]
    raw = spark.createDataFrame(rows, schema)
    fo, fp = build_fact_orders(raw), build_fact_order_products(raw)
    got = [tuple(r) for r in Q.largest_basket_orders(fo, fp).collect()]
    # Order 1 appears twice in fact_orders; one non-null product id each join → 2.
    assert got == [(1, 5, 1, "Monday", "9:00", 2), (2, 6, 1, "Tuesday", "10:00", 0)]


def test_day_hour_matrix_fills_empty_cells(spark):
    rows = [("1", "1", "1", "0", "7", None, "prior", ""), ("2", "1", "2", "0", "7", None, "prior", ""),
            ("3", "1", "3", "6", "23", None, "prior", ""), ("4", "1", "4", "9", "1", None, "prior", "")]
    got = {r.order_dow: r for r in Q.day_hour_matrix(build_fact_orders(raw_frame(spark, rows))).collect()}
    assert sorted(got) == [0, 6, 9]
    assert got[0].hour_7 == 2 and got[0].hour_8 == 0 and got[6].hour_23 == 1
    assert got[9].day_name == "Unknown" and got[9].hour_1 == 1
    assert sum(got[0][f"hour_{h}"] for h in range(24)) == 2


def test_dq_raw_orders_counts_what_would_be_lost(spark):
    raw = spark.createDataFrame(
        [("1", "x", '[{"a":NaN}]'), ("2", "3", "[]"), (None, "1.5", "{}"), ("4", "", None)],
        "order_id string, order_number string, products string")
    assert [tuple(r) for r in D.dq_raw_orders(raw).collect()] == [(4, 2, 2)]


def test_list_rank_orders_as_row_then_position(spark):
    from cartwheel.operators.facts import LIST_BITS, ROW_BITS, list_rank
    rows = [(r, p) for r in (0, 1, 2, (1 << ROW_BITS) - 1) for p in (0, 1, (1 << LIST_BITS) - 1)]
    ranked = spark.createDataFrame(rows, "r bigint, p int").select("r", "p", list_rank(F.col("r"), F.col("p")).alias("k")).collect()
    assert [(x.r, x.p) for x in sorted(ranked, key=lambda x: x.k)] == sorted(rows)
    assert len({x.k for x in ranked}) == len(rows)


@pytest.mark.parametrize("row, pos", [(1 << 38, 0), (0, 1 << 25), (-1, 0), (None, 0)])
def test_list_rank_refuses_what_does_not_fit(spark, row, pos):
    from cartwheel.operators.facts import list_rank
    df = spark.createDataFrame([(row, pos)], "r bigint, p int").select(list_rank(F.col("r"), F.col("p")).alias("k"))
    with pytest.raises(Exception, match="needed to rank products"):
        df.collect()


def test_first_product_by_row_then_list_position(spark):
    from cartwheel.schemas import ROW_INDEX
    def line(name):
        return f'{{"product_id": 5, "add_to_cart_order": 1, "product_name": "{name}"}}'
    cells = {2: "[" + line("late") + "]", 1: "[" + line("first") + "," + line("second") + "]", 3: "[" + line("last") + "]"}
    rows = [("7", "1", "1", "0", "7", None, "prior", cell, index) for index, cell in cells.items()]
    raw = raw_frame(spark, rows, schema="order_id string, user_id string, order_number string, order_dow string, order_hour_of_day string, "
                    f"days_since_prior_order string, eval_set string, products string, {ROW_INDEX} bigint")
    got = build_fact_order_products(raw.repartition(3)).collect()
    assert [r.product_name for r in got] == ["first"]
