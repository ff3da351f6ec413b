"""Shop sales: averages, running totals, merge, feed, restore and branch."""

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import changes, ordering, quality
from tallyhouse.plans import model, reports
from tallyhouse.sources.delimited import read_table
from tallyhouse.sources.tables import literal_rows


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("shop")
    load = lambda n, text, schema: read_table(spark, fx.put(folder, n, text), schema)
    return {
        "customers": load("customers.csv", fx.SHOP_CUSTOMERS, model.CUSTOMERS),
        "products": load("products.csv", fx.SHOP_PRODUCTS, model.PRODUCTS),
        "sales": load("sales.csv", fx.SHOP_SALES, model.SALES),
        "history": load("history.csv", fx.SALES_HISTORY, model.SALES),
        "new": load("new.csv", fx.NEW_SALES, model.SALES)}


def column(df, name):
    return [row[name] for row in df.collect()]


def test_columns_bind_by_position(shop):
    assert shop["sales"].columns[0] == "sales_id"
    assert column(shop["sales"].orderBy("sales_id"), "sales_id") == list(range(1, 13))


def test_averages(shop):
    sales, customers = shop["sales"], shop["customers"]
    assert reports.revenue(sales).first()[0] == 290500
    spent = reports.revenue_per_entity(sales, customers, "customer_id", [], order=["customer_id"])
    assert column(spent, "total_revenue") == [91000, 68000, 69000, 13500, 49000]
    by_sale = reports.above_average_sale(sales, customers, "customer_id", ["customer_name"])
    assert sorted(column(by_sale, "customer_id")) == [1, 2, 3, 5]
    by_customer = reports.above_average_entity(sales, customers, "customer_id", ["customer_name"])
    assert sorted(column(by_customer, "customer_id")) == [1, 2, 3]


def test_best_product_of_each_category(shop):
    best = reports.best_in_group(shop["sales"], shop["products"], "product_id", [], "category")
    assert {r.category: (r.product_id, r.total_revenue) for r in best.collect()} == {
        "Electronics": (101, 120000), "Accessories": (103, 21000)}
    listed = reports.numbered_in_group(shop["sales"], shop["products"], "product_id", [], "category")
    assert {(r.category, r.product_id): r.row_number for r in listed.collect()} == {
        ("Electronics", 101): 1, ("Electronics", 102): 2, ("Electronics", 105): 3,
        ("Accessories", 103): 1, ("Accessories", 104): 2}


def test_running_revenue(shop):
    up = ordering.running_total(shop["sales"], ["sale_date", "sales_id"], "total_amount", "run", unique=True)
    assert column(up.orderBy("sales_id"), "run")[:3] == [60000, 110000, 119000]
    down = ordering.running_by_day(shop["sales"], "sale_date", "total_amount", "run", descending=True)
    assert column(down.orderBy(F.desc("sale_date")), "run")[:3] == [6000, 12000, 37000]


def test_merge_twice(shop):
    merged = changes.merge_insert(shop["history"], shop["new"], ["sales_id"])
    assert merged.count() == 10
    assert reports.revenue(merged).first()[0] == 266000
    again = changes.merge_insert(merged, shop["new"], ["sales_id"])
    assert again.count() == 10
    assert quality.duplicate_keys(merged, ["sales_id"]).count() == 0
    assert quality.orphan_rows(merged, shop["customers"], "customer_id").count() == 0
    spent = reports.revenue_per_entity(merged, shop["customers"], "customer_id", [], order=["customer_id"])
    assert column(spent, "total_revenue") == [85000, 62000, 63000, 7000, 49000]


def test_states_and_feed(spark, shop):
    """Load, merge, delete sale 10, bring it back; then one sale more in a what-if copy of the log."""
    def entries(df, version, op="I"):
        return df.withColumns({"op": F.lit(op), "version": F.lit(version).cast("long")})

    key = ["sales_id"]
    log = entries(shop["history"], 1)
    log = log.unionByName(entries(changes.new_rows(changes.state_of(log, key, 1), shop["new"], key), 2))
    feed = changes.net_changes(changes.state_of(log, key, 1), changes.state_of(log, key, 2), key)
    assert sorted(column(feed, "sales_id")) == [6, 7, 8, 9, 10]
    assert {(r.action, r.is_update) for r in feed.collect()} == {("INSERT", False)}

    tenth = changes.state_of(log, key, 2).filter("sales_id = 10")
    log = log.unionByName(entries(tenth, 3, "D"))
    assert changes.state_of(log, key, 3).count() == 9
    log = log.unionByName(entries(tenth, 4))
    assert changes.state_of(log, key, 4).count() == 10
    assert changes.net_changes(changes.state_of(log, key, 2), changes.state_of(log, key, 4), key).count() == 0

    from datetime import date
    from decimal import Decimal
    more = literal_rows(spark, [(11, 1, 105, 1, 2, date(2026, 7, 11), Decimal(24000))], model.SALES)
    copy = log.unionByName(entries(more, 5))
    assert (changes.state_of(copy, key, 5).count(), changes.state_of(log, key, 5).count()) == (11, 10)
    assert changes.state_of(copy, key, 1).count() == 5
