"""Star and snowflake models over 100 sales."""

import fixtures as fx
import pytest

from tallyhouse.operators.totals import key_profile
from tallyhouse.operators.dimensions import date_dimension
from tallyhouse.plans import catalog, reports
from tallyhouse.plans.model import Snowflake, load_star

CUSTOMERS = {13: 720000, 3: 675000, 5: 550000, 4: 360000, 1: 325000, 15: 312500, 2: 280000,
             12: 120000, 9: 110000, 10: 105000}
BRANCHES = [400000, 400000, 1395000, 424000, 862500, 56500, 74000, 70500, 146000, 167500]
CATEGORIES = {"Electronics": 2190000, "Office Equipment": 915000, "Networking": 376500,
              "Accessories": 285500, "Storage": 130500, "Mobile Accessories": 98500}
BRANDS = {"Apple": 1225000, "Epson": 720000, "LG": 360000, "Samsung": 327500, "Dell": 325000,
          "Cisco": 312500, "Canon": 120000, "Logitech": 114000, "JBL": 110000, "HP": 84000,
          "Seagate": 65000, "TP-Link": 64000, "Anker": 62500, "Sony": 52500, "Mi": 36000,
          "SanDisk": 18000}
REGIONS = {"South": 2341000, "North": 1100500, "West": 480500, "East": 74000}


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("star")
    days = date_dimension(spark, "2026-07-01", "2026-07-31").drop("month_no")
    rows = [",".join(map(str, row)) for row in days.orderBy("date_id").collect()]
    return load_star(spark, {
        "dim_customer": fx.put(folder, "customers.csv", fx.STAR_CUSTOMERS),
        "dim_product": fx.put(folder, "products.csv", fx.STAR_PRODUCTS),
        "dim_branch": fx.put(folder, "branches.csv", fx.STAR_BRANCHES),
        "dim_date": fx.put(folder, "calendar.csv", "\n".join([",".join(days.columns), *rows])),
        "fact_sales": fx.put(folder, "sales.csv", fx.star_sales())})


@pytest.fixture(scope="module")
def flake(star):
    return Snowflake(star)


def totals(df, name):
    return {row[name]: row["total_revenue"] for row in df.collect()}


def test_calendar_attributes(star):
    days = {r.date_id: r for r in star.date.collect()}
    assert (days[1].day_name, days[1].week_no, days[1].month, days[1].quarter) == ("Wednesday", 27, "July", "Q3")
    assert [days[n].is_weekend for n in (3, 4, 5, 6)] == ["No", "Yes", "Yes", "No"]
    assert days[6].week_no == 28 and days[31].week_no == 31


def test_load_checks(star):
    assert {r.table_name: r.row_count for r in star.load_counts().collect()} == {
        "dim_customer": 20, "dim_product": 20, "dim_branch": 10, "dim_date": 31, "fact_sales": 100}
    assert all(r.unmatched_rows == 0 for r in star.unmatched_facts().collect())
    assert all(r.null_keys == 0 and r.repeated_keys == 0 for r in star.declared_key_report().collect())
    profile = key_profile(star.sales, {"customers": "customer_id", "products": "product_id",
                                       "branches": "branch_id", "dates": "date_id"}, "total_sales")
    assert tuple(profile.first()) == (100, 20, 20, 10, 31)


def test_star_reports(star):
    both = reports.revenue(star.sales, {"quantity": ("sum", "quantity"), "amount": ("sum", "total_amount")})
    assert tuple(both.first()) == (300, 3996000)
    top = reports.top_sellers(star.sales, star.customer, "customer_id", ["customer_name"], 10)
    assert totals(top, "customer_id") == CUSTOMERS
    assert [r.customer_id for r in top.collect()] == list(CUSTOMERS)
    branches = reports.revenue_per_entity(star.sales, star.branch, "branch_id", ["branch_name"],
                                          order=["branch_id"])
    assert [r.total_revenue for r in branches.collect()] == BRANCHES
    ranks = reports.ranked(star.sales, star.branch, "branch_id", ["branch_name"])
    placed = {r.branch_id: r["rank"] for r in ranks.collect()}
    assert [placed[b] for b in (3, 5, 4, 1, 2, 10)] == [1, 2, 3, 4, 4, 6]
    daily = reports.revenue_per_period(star.sales, star.date, "date_id", ["date"])
    amounts = [r.total_revenue for r in daily.collect()]
    assert (len(amounts), amounts[0], amounts[-1]) == (31, 236800, 215000)
    monthly = reports.revenue_per_period(star.sales, star.date, "date_id", ["month", "year"])
    assert totals(monthly, "month") == {"July": 3996000}


def test_snowflake_lookups(flake):
    assert flake.category.count() == 6
    assert flake.brand.count() == 18
    assert flake.brand.select("brand_name").distinct().count() == 16
    assert (flake.product.count(), flake.customer.count(), flake.branch.count()) == (20, 20, 10)
    assert (flake.region.count(), flake.state.count()) == (4, 14)
    assert flake.city.count() == 20
    assert flake.state.filter("region_id is null").count() == 0
    assert (flake.year.count(), flake.quarter.count(), flake.month.count()) == (1, 1, 1)
    assert all(r.unmatched_rows == 0 for r in flake.unmatched_facts().collect())


def test_snowflake_reports_equal_star_reports(star, flake):
    def by(flat, key, name):
        return totals(reports.revenue_per_attribute(star.sales, flat, key, [name]), name)

    assert by(flake.product_flat(), "product_id", "category_name") == CATEGORIES
    assert by(star.product, "product_id", "category") == CATEGORIES
    assert by(flake.product_flat(), "product_id", "brand_name") == BRANDS
    assert by(flake.branch_flat(), "branch_id", "region_name") == REGIONS
    assert by(star.branch, "branch_id", "region") == REGIONS
    states = by(flake.customer_flat(), "customer_id", "state_name")
    assert states == by(star.customer, "customer_id", "state")
    regional = reports.revenue_per_attribute(
        star.sales, flake.customer_flat(), "customer_id", ["region_name"], reports.dashboard(),
        count_keys_as="customers")
    assert sum(r.customers for r in regional.collect()) == 20
    assert sum(r.total_transactions for r in regional.collect()) == 100


def test_sql_over_views(spark, star):
    star.register_views()
    row = spark.sql("""SELECT c.customer_id, sum(f.total_amount) AS t FROM dim_customer c
        JOIN fact_sales f ON c.customer_id = f.customer_id GROUP BY c.customer_id
        ORDER BY t DESC LIMIT 1""").first()
    assert (row.customer_id, row.t) == (13, 720000)


def test_lookup_ids_stay(spark, star):
    from tallyhouse.operators.dimensions import extract_lookup
    first = extract_lookup(star.product.filter("product_id > 110"), ["category"], "category_id")
    grown = {r.category: r.category_id
             for r in extract_lookup(star.product, ["category"], "category_id", first).collect()}
    old = {r.category: r.category_id for r in first.collect()}
    assert {c: grown[c] for c in old} == old
    assert sorted(grown.values()) == [1, 2, 3, 4, 5, 6]


def test_star_load_numbers_sales_of_several_partitions(spark, tmp_path):
    """Generated sale numbers of the second partition and later ones need more than 32 bits."""
    given = "/root/testdata/sf0.001"
    for name in "region nation customer supplier part orders".split():
        (tmp_path / f"{name}.parquet").symlink_to(f"{given}/{name}.parquet")
    lines = spark.read.parquet(f"{given}/lineitem.parquet")
    lines.repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    counts = {r.table_name: r.row_count for r in catalog.QUERIES["star_load"](spark, str(tmp_path)).collect()}
    assert counts["fact_sales"] == lines.count() > 0
