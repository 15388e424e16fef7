"""Properties of the fact builders and of landing on generated input, none of
which needs a model of the contract, and hand-written cases with expected rows."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwheel.operators.facts import build_fact_order_products, build_fact_orders

SCHEMA = ("row_index long, order_id string, user_id string, order_number string, "
          "order_dow string, order_hour_of_day string, days_since_prior_order string, "
          "eval_set string, products string")
QUICK = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    """Raw orders of (order_id, user_id, products) in file order."""
    return spark.createDataFrame([(i, o, u, "1", "0", "7", None, "prior", c) for i, (o, u, c) in enumerate(rows)], SCHEMA)


def facts(raw):
    orders = sorted((r.order_id, r.user_id) for r in build_fact_orders(raw).collect())
    return orders, sorted((tuple(r) for r in build_fact_order_products(raw).drop("loaded_at").collect()), key=repr)


# ----------------------------------------------------------------- generators
numberish = st.one_of(
    st.none(), st.booleans(), st.integers(-3, 12),
    st.sampled_from([1.0, 2.5, -0.0, 3.0, 1e3, 1e20]),
    st.sampled_from(["1", "2", " 3 ", "1.0", "1e1", "x", "", "2.5", "true", "-4"]),
)
texty = st.one_of(st.none(), st.integers(0, 9), st.text("ab é", max_size=3))
product = st.fixed_dictionaries({}, optional={
    "product_id": numberish, "product_name": texty, "aisle": texty,
    "department": texty, "add_to_cart_order": numberish, "reordered": numberish,
})
element = st.one_of(product, product, st.integers(0, 3), st.none(), st.text("xy", max_size=2))
cell = st.one_of(
    st.none(),
    st.sampled_from(["", "  ", "not json", "[{\"product_id\":1", "5", "{}", "[]"]),
    st.lists(element, max_size=4).map(json.dumps),
    product.map(json.dumps),
)
order_key = st.one_of(st.sampled_from(["1", "2", "3", "2.0", " 3", "x", None]),
                      st.integers(1, 4).map(str))
raw_rows = st.lists(st.tuples(order_key, st.sampled_from(["7", None, "8.0", "u"]), cell),
                    min_size=1, max_size=12)


@QUICK
@given(raw_rows, st.randoms())
def test_keys_are_unique_and_arrival_order_does_not_matter(spark, rows, rnd):
    raw = frame(spark, rows)
    orders, products = facts(raw)
    keys = [o for o, _ in orders]
    assert len(keys) == len(set(keys)) and None not in keys
    lines = [(p[0], p[1], p[5]) for p in products]
    assert len(lines) == len(set(lines)) and all(k[0] is not None for k in lines)
    shuffled = raw.collect()
    rnd.shuffle(shuffled)
    assert facts(spark.createDataFrame(shuffled, SCHEMA)) == (orders, products)


@QUICK
@given(st.lists(st.integers(0, 10**6), unique=True, max_size=6))
def test_a_list_of_distinct_products_gives_a_row_each(spark, ids):
    cell = json.dumps([{"product_id": i, "add_to_cart_order": k} for k, i in enumerate(ids)])
    _, products = facts(frame(spark, [("1", "7", cell)]))
    assert sorted(p[1] for p in products) == sorted(ids)


@pytest.mark.parametrize("cell,want", [
    (None, []), ("", []), ("  ", []), ("not json", []), ("5", []), ("{}", []), ("[]", []),
    ('[1, null, "x"]', []),
    ('[{"product_id": 3}]', [(1, 3, "", "", "", None, None)]),
    ('[{"product_id": "4", "product_name": "tea", "aisle": null, "add_to_cart_order": 2.0, "reordered": true}]',
     [(1, 4, "tea", "", "", 2, 1)]),
    ('[{"product_id": 5, "add_to_cart_order": 1, "aisle": "a"}, {"product_id": 5, "add_to_cart_order": 1, "aisle": "b"}]',
     [(1, 5, "", "a", "", 1, None)]),
])
def test_cells(spark, cell, want):
    assert facts(frame(spark, [("1", "7", cell)]))[1] == want


@pytest.mark.parametrize("text", ["1d", "1f", "2.0D", "2.0 F", "x", ""])
def test_text_that_is_no_number(spark, text):
    assert facts(frame(spark, [(text, "7", None), ("2", "8", None)]))[0] == [(2, 8)]


record = st.fixed_dictionaries({}, optional={
    "order_id": st.one_of(st.none(), st.integers(0, 99), st.text("ab1", max_size=3), st.booleans()),
    "products": st.lists(st.fixed_dictionaries({"product_id": st.integers(0, 5)}), max_size=2),
})
document = st.one_of(
    st.lists(record, max_size=4),
    st.dictionaries(st.sampled_from(["status", "zdata", "adata", "meta", "b"]),
                    st.one_of(st.lists(record, max_size=3), st.text("ok", max_size=2),
                              st.integers(0, 3), record),
                    max_size=4),
    st.integers(0, 9),
    record,
)


def landed(spark, texts):
    from pyspark.sql import functions as F
    from cartwheel.sources.landing import envelope_records, record_columns, records_to_rows
    payloads = spark.createDataFrame(texts, "source_file string, text string").select(
        "source_file", "text", F.try_parse_json("text").alias("payload"))
    records = envelope_records(payloads)
    columns = dict(record_columns(records))
    return columns, records_to_rows(records, list(columns.items())).collect()


@QUICK
@given(st.lists(document, min_size=1, max_size=4))
def test_payloads_do_not_mix_and_places_count_up(spark, docs):
    texts = [(f"p{i}.json", json.dumps(d)) for i, d in enumerate(docs)]
    _, rows = landed(spark, texts)
    places = {}
    for r in rows:
        places.setdefault(r.source_file, []).append(r.row_index)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    for i, doc in enumerate(docs):
        if isinstance(doc, list):                    # a bare list is its records
            assert len(places.get(f"p{i}.json", [])) == len(doc)


@pytest.mark.parametrize("doc,ids", [
    ([{"order_id": 1}, {"order_id": "2"}], ["1", "2"]),
    ({"status": "ok", "orders": [{"order_id": 3}]}, ["3"]),
    ({"order_id": 4}, ["4"]),
    ([{"order_id": True}, {"order_id": None}], ["true", None]),
    ([], []),
])
def test_envelopes(spark, doc, ids):
    _, rows = landed(spark, [("p.json", json.dumps(doc))])
    assert [r["order_id"] for r in sorted(rows, key=lambda r: r.row_index)] == ids
