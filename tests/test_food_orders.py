"""Order reports on twelve food orders loaded from CSV."""

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from tallyhouse.functions.expressions import after_day, full_name
from tallyhouse.plans import model, reports
from tallyhouse.sources.delimited import read_table


@pytest.fixture(scope="module")
def food(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("food")
    load = lambda n, text, schema: read_table(spark, fx.put(folder, n, text), schema)
    customers = load("customers.csv", fx.FOOD_CUSTOMERS, model.FOOD_CUSTOMERS)
    return (customers.withColumn("customer_name", full_name("first_name", "last_name")),
            load("items.csv", fx.FOOD_ITEMS, model.FOOD_ITEMS),
            load("orders.csv", fx.FOOD_ORDERS, model.FOOD_ORDERS))


def pairs(df, *columns):
    return [tuple(row[c] for c in columns) for row in df.collect()]


def test_load(food):
    assert [df.count() for df in food] == [5, 5, 12]
    assert dict(food[0].dtypes)["phone"] == "string"


def test_totals(food):
    customers, items, orders = food
    assert reports.revenue(orders).first()[0] == 3470
    spent = reports.revenue_per_entity(orders, customers, "customer_id", ["customer_name"])
    assert pairs(spent, "customer_id", "total_revenue") == [
        (1, 1150), (2, 970), (5, 500), (3, 460), (4, 390)]
    assert spent.first()["customer_name"] == "Amit Sharma"
    assert pairs(reports.revenue_by(orders, ["status"]), "status", "total_revenue") == [
        ("Delivered", 3350), ("Preparing", 120)]
    assert pairs(reports.revenue_per_attribute(orders, items, "food_id", ["category"]),
                 "category", "total_revenue") == [
        ("Main Course", 2000), ("Breakfast", 720), ("Snacks", 450), ("Dessert", 300)]


def test_ranks_and_frequency(food):
    customers, _, orders = food
    top = reports.ranked(orders, customers, "customer_id", ["customer_name"], n=3)
    assert pairs(top, "rank", "customer_id") == [(1, 1), (2, 2), (3, 5)]
    best = reports.top_sellers(orders, customers, "customer_id", ["customer_name"], 1)
    assert pairs(best, "customer_id", "total_revenue") == [(1, 1150)]
    often = reports.purchase_frequency(orders, customers, "customer_id", ["customer_name"], "quantity")
    assert pairs(often, "customer_id", "purchases") == [(1, 3), (2, 3), (3, 2), (4, 2), (5, 2)]


def test_filters(food):
    _, _, orders = food
    assert orders.filter(F.col("status") == "Delivered").count() == 11
    late = orders.filter(after_day("order_date", "2026-07-12")).orderBy("order_id")
    assert pairs(late, "order_id") == [(n,) for n in range(6, 13)]


def test_date_filter_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = df.filter(after_day("o_orderdate", "2000-07-12")).select("o_orderkey")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,2000-07-13T00:00)" in text
    assert "o_totalprice" not in text
