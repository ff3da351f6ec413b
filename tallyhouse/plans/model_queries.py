"""Dimension modelling, CSV loading and views on the given tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, functions as F, types as T

from tallyhouse.operators import dimensions, quality
from tallyhouse.operators.joins import union_all
from tallyhouse.plans import reports
from tallyhouse.plans.model import LONG, STAR, TEXT, Snowflake, Star, columns, load_star
from tallyhouse.plans.registry import Warehouse, amounts, query, whole
from tallyhouse.plans.sales_queries import (
    FOLDED_DASHBOARD, LINE_DASHBOARD, STRAYS, SUM_LINES, SUM_ORDERS, lines_with_strays)
from tallyhouse.session import new_table_path, written
from tallyhouse.sources.delimited import NULL_TOKENS, read_table


def star_of(w: Warehouse) -> Star:
    """The star model over the given tables: line-grain facts, nations as cities and states.

    Customers and branches have no city of their own, so the nation takes
    both places; the chain nation, region then is a real one.
    """
    customers = w.customers().withColumn("city", F.col("state"))
    branches = w.branches().withColumn("city", F.col("state"))
    dates = written(w.dates(), "dates")
    numbered = dates.select("date_id", F.col("date").alias("sale_date"))
    orders = w.orders().select("order_id", "customer_id", "sale_date")
    # A sale without a known order or date stays, so that the reference checks can find it.
    sales = (w.lines().join(orders, "order_id", "left").join(numbered, "sale_date", "left")
             .select("order_id", "customer_id", "product_id", "branch_id", "date_id",
                     "quantity", "total_amount"))
    return Star(customers, w.products(), branches, dates, sales)


def snowflake_of(w: Warehouse) -> Snowflake:
    return Snowflake(star_of(w))


# --- dates and lookups ------------------------------------------------------------

@query("SELECT * FROM v_dates")
def date_dimension(w: Warehouse):
    return whole(w.dates(), "date_id", "day", "week_no", "month_no", "year")


@query("""SELECT category, row_number() OVER (ORDER BY category) AS category_id
    FROM (SELECT DISTINCT category FROM v_products)""")
def extract_category(w: Warehouse):
    return dimensions.extract_lookup(w.products(), ["category"], "category_id")


@query("""SELECT brand, category, row_number() OVER (ORDER BY brand, category) AS brand_id,
    dense_rank() OVER (ORDER BY category) AS category_id
    FROM (SELECT DISTINCT brand, category FROM v_products)""")
def extract_brand(w: Warehouse):
    products = w.products()
    category = dimensions.extract_lookup(products, ["category"], "category_id")
    brand = dimensions.extract_lookup(products, ["brand", "category"], "brand_id")
    return dimensions.add_parent(brand, category, ["category"], "category_id")


@query("""SELECT state, region, row_number() OVER (ORDER BY state, region) AS state_id,
    dense_rank() OVER (ORDER BY region) AS region_id FROM (SELECT state, region FROM v_customers
    UNION SELECT state, region FROM v_branches)""")
def extract_state(w: Warehouse):
    """States of customers and branches together, each with its region."""
    places = w.customers().select("state", "region").unionByName(w.branches().select("state", "region"))
    region = dimensions.extract_lookup(places, ["region"], "region_id")
    state = dimensions.extract_lookup(places, ["state", "region"], "state_id")
    return dimensions.add_parent(state, region, ["region"], "region_id")


@query("""SELECT year, quarter, month, row_number() OVER (ORDER BY year, quarter, month) AS month_id,
    dense_rank() OVER (ORDER BY year, quarter) AS quarter_id, dense_rank() OVER (ORDER BY year) AS year_id
    FROM (SELECT DISTINCT year, quarter, month FROM v_dates)""")
def extract_calendar(w: Warehouse):
    dates = written(w.dates(), "dates")
    year = dimensions.extract_lookup(dates, ["year"], "year_id")
    quarter = dimensions.extract_lookup(dates, ["year", "quarter"], "quarter_id")
    month = dimensions.extract_lookup(dates, ["year", "quarter", "month"], "month_id")
    chained = dimensions.add_parent(month, quarter, ["year", "quarter"], "quarter_id")
    return whole(dimensions.add_parent(chained, year, ["year"], "year_id"), "year")


@query("""SELECT brand, category, CASE WHEN price_rank = 1 THEN row_number() OVER (
    PARTITION BY price_rank ORDER BY brand, category) ELSE count(*) FILTER (price_rank = 1) OVER ()
    + row_number() OVER (PARTITION BY price_rank ORDER BY brand, category) END AS brand_id
    FROM (SELECT brand, category, CASE WHEN min(price) < 905 THEN 1 ELSE 2 END AS price_rank
    FROM v_products GROUP BY brand, category)""")
def extend_lookup(w: Warehouse):
    """Brands of the first price list get ids; a later load numbers only the new ones."""
    first = written(dimensions.extract_lookup(
        w.products().filter("price < 905"), ["brand", "category"], "brand_id"), "brands")
    return dimensions.extract_lookup(w.products(), ["brand", "category"], "brand_id", first)


@query("""SELECT product_id, product_name, CAST(price AS DOUBLE) AS price,
    dense_rank() OVER (ORDER BY brand, category) AS brand_id FROM v_products""")
def normalise_product(w: Warehouse):
    products = w.products()
    brand = dimensions.extract_lookup(products, ["brand", "category"], "brand_id")
    lean = dimensions.normalise_dimension(products, brand, ["brand", "category"], "brand_id")
    return lean.withColumn("price", F.col("price").cast("double"))


@query("SELECT *, row_number() OVER (ORDER BY customer_name, customer_id) AS customer_key FROM v_customers")
def load_with_generated_key(w: Warehouse):
    return dimensions.assign_keys(w.customers(), "customer_key", ["customer_name", "customer_id"])


# --- the same reports from the snowflake --------------------------------------------

@query(f"""SELECT category AS category_name, {SUM_LINES} FROM v_lines
    JOIN v_products USING (product_id) GROUP BY ALL""")
def snowflake_category_revenue(w: Warehouse):
    products = w.products()
    category = dimensions.extract_lookup(products, ["category"], "category_id")
    named = dimensions.extract_lookup(products, ["brand", "category"], "brand_id")
    brand = (dimensions.add_parent(named, category, ["category"], "category_id")
             .select("brand_id", "category_id"))
    lean = dimensions.normalise_dimension(products, named, ["brand", "category"], "brand_id")
    flat = dimensions.flatten_dimension(lean, [
        (brand, "brand_id"), (category.withColumnRenamed("category", "category_name"), "category_id")])
    return amounts(reports.revenue_per_attribute(
        w.lines(), flat, "product_id", ["category_name"]), "total_revenue")


@query(f"""SELECT region AS region_name, count(DISTINCT customer_id) AS customers,
    count(*) AS total_transactions, CAST(sum(quantity) AS DOUBLE) AS units_sold, {SUM_LINES}
    FROM v_sales JOIN v_customers USING (customer_id) GROUP BY region""")
def snowflake_regional_dashboard(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.sales_per_order(), snowflake_of(w).customer_flat(), "customer_id", ["region_name"],
        FOLDED_DASHBOARD, count_keys_as="customers"), "total_revenue")


def dated_orders(w: Warehouse, flake: Snowflake) -> DataFrame:
    """Sales folded per order, with the number of their date."""
    numbered = flake.star.date.select("date_id", F.col("date").alias("sale_date"))
    return w.sales_per_order().join(numbered, "sale_date", "left")


@query(f"""SELECT year AS year_value, month AS month_name, {SUM_LINES} FROM v_sales
    JOIN v_dates ON date = sale_date GROUP BY ALL""")
def snowflake_monthly_revenue(w: Warehouse):
    flake = snowflake_of(w)
    return whole(amounts(reports.revenue_per_period(
        dated_orders(w, flake), flake.date_flat(), "date_id", ["year_value", "month_name"]), "total_revenue"),
        "year_value")


@query(f"""SELECT year AS year_value, quarter AS quarter_name, {SUM_LINES} FROM v_sales
    JOIN v_dates ON date = sale_date GROUP BY ALL""")
def snowflake_quarterly_revenue(w: Warehouse):
    flake = snowflake_of(w)
    return whole(amounts(reports.revenue_per_period(
        dated_orders(w, flake), flake.date_flat(), "date_id", ["year_value", "quarter_name"]), "total_revenue"),
        "year_value")


@query(f"""SELECT year AS year_value, quarter AS quarter_name, month AS month_name, date, {SUM_LINES} FROM v_sales
    JOIN v_dates ON date = sale_date GROUP BY ALL""")
def snowflake_daily_trend(w: Warehouse):
    """Each day's revenue with the parts of the calendar it belongs to."""
    flake = snowflake_of(w)
    return whole(amounts(reports.revenue_per_period(
        dated_orders(w, flake), flake.date_flat(), "date_id", ["year_value", "quarter_name", "month_name", "date"]),
        "total_revenue"), "year_value")


@query(f"""SELECT product_id, product_name, category AS category_name, brand AS brand_name,
    count(*) AS total_transactions, CAST(sum(quantity) AS DOUBLE) AS units_sold, {SUM_LINES}
    FROM v_lines JOIN v_products USING (product_id) GROUP BY ALL""")
def snowflake_product_board(w: Warehouse):
    return amounts(reports.revenue_per_entity(
        w.lines(), snowflake_of(w).product_flat(), "product_id", ["product_name", "category_name", "brand_name"],
        LINE_DASHBOARD), "total_revenue")


@query(f"""SELECT region AS region_name, {SUM_LINES} FROM v_lines JOIN v_branches USING (branch_id) GROUP BY ALL""")
def snowflake_region_by_branch(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.lines(), snowflake_of(w).branch_flat(), "branch_id", ["region_name"]), "total_revenue")


@query(f"""SELECT 'customer' AS dimension, count(*) FILTER (status = 'P') AS unmatched_rows FROM v_orders
    UNION ALL SELECT 'date', count(*) FILTER (status = 'P') FROM v_orders
    UNION ALL SELECT 'product', count(*) FILTER (product_id < 0) FROM {STRAYS}
    UNION ALL SELECT 'branch', count(*) FILTER (branch_id IS NULL) FROM {STRAYS}""")
def snowflake_unmatched(w: Warehouse):
    """References into the split dimensions, counted on the facts' own keys; only the planted strays break one."""
    flake = snowflake_of(w)
    orders = w.orders().select("customer_id", F.col("sale_date").alias("date"), "status")
    strays = orders.filter("status = 'P'").withColumns(
        {"customer_id": -1 - F.col("customer_id"), "date": F.lit(None).cast("date")})
    return union_all([
        quality.orphan_counts(orders.unionByName(strays), {
            "customer": (flake.customer, "customer_id"), "date": (flake.date, "date")}),
        quality.orphan_counts(lines_with_strays(w), {
            "product": (flake.product, "product_id"), "branch": (flake.branch, "branch_id")})])


# --- CSV ------------------------------------------------------------------------------

_PRODUCT_FILE = columns(product_id=LONG, product_name=TEXT, category=TEXT, brand=TEXT,
                        price=T.DecimalType(15, 2))


@query("""SELECT product_id, product_name, category, brand, CAST(price AS DOUBLE) AS price
    FROM v_products""")
def csv_load(w: Warehouse):
    """Products out to CSV and back through the typed, positional loader."""
    path = new_table_path(w.spark, "products-csv")
    (w.products().withColumnRenamed("product_id", "some_other_header")
     .write.option("header", True).csv(path))
    loaded = read_table(w.spark, path, _PRODUCT_FILE, name_pattern="*.csv")
    return loaded.withColumn("price", F.col("price").cast("double"))


_CUSTOMER_FILE = columns(customer_id=LONG, customer_name=TEXT, membership=TEXT,
                         balance=T.DecimalType(15, 2))


@query("""SELECT c_custkey AS customer_id, c_name || ', "' || c_mktsegment || '"' AS customer_name, membership,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
    FROM customer JOIN v_customers ON customer_id = c_custkey""")
def csv_load_quoted(w: Warehouse):
    """Quoted fields with doubled quotes and both null tokens, one of them in a number column."""
    path = new_table_path(w.spark, "customers-csv")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(15,2)").cast("string"))
    raw = w.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"')).alias("customer_name"),
        F.coalesce(balance, F.lit("null")).alias("balance"))
    tiers = w.customers().select("customer_id", F.coalesce("membership", F.lit("NULL")).alias("membership"))
    (raw.join(tiers, "customer_id").select("customer_id", "customer_name", "membership", "balance")
     .write.option("header", True).option("quote", '"').option("escape", '"').csv(path))
    loaded = read_table(w.spark, path, _CUSTOMER_FILE, quote='"', null_tokens=NULL_TOKENS)
    return loaded.withColumn("balance", F.col("balance").cast("double"))


# --- views -------------------------------------------------------------------------------

@query(f"""SELECT customer_id, customer_name, {SUM_ORDERS} FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL""")
def view_customer_sales(w: Warehouse):
    """A named view over a report, sorted where it is read."""
    report = reports.revenue_per_entity(w.orders(), w.customer_names(), "customer_id", ["customer_name"],
                                        {"total_revenue": ("sum", "order_amount")}, [])
    report.createOrReplaceTempView("customer_sales_report")
    ordered = w.spark.sql("SELECT * FROM customer_sales_report ORDER BY total_revenue DESC, customer_id")
    return amounts(ordered, "total_revenue")


@query(f"SELECT category, brand, {SUM_LINES} FROM v_lines JOIN v_products USING (product_id) GROUP BY ALL")
def view_star_sql(w: Warehouse):
    """Plain SQL over the star tables; the facts keep their own keys, so a product report reads lines and products only."""
    star = Star(w.customers(), w.products(), w.branches(), w.dates(), w.lines())
    names = {name: f"{name}_{uuid4().hex[:8]}" for name in ("fact_sales", "dim_product")}
    for name, view in names.items():
        star.tables()[name].createOrReplaceTempView(view)
    return w.spark.sql(f"""
        SELECT p.category, p.brand, sum(f.total_amount) / 100D AS total_revenue
        FROM {names["fact_sales"]} f JOIN {names["dim_product"]} p ON f.product_id = p.product_id
        GROUP BY p.category, p.brand ORDER BY total_revenue DESC""")


# --- loads from CSV ------------------------------------------------------------------------

@query("SELECT *, row_number() OVER (ORDER BY customer_id) AS customer_key FROM "
       "(SELECT customer_id, customer_name, segment FROM v_customers)")
def csv_load_with_generated_key(w: Warehouse):
    """A file with fewer columns than its table: the key is generated as the rows come in."""
    path = new_table_path(w.spark, "customers-csv")
    w.customers().select("customer_id", "customer_name", "segment").write.option("header", True).csv(path)
    loaded = read_table(w.spark, path, columns(customer_id=LONG, customer_name=TEXT, segment=TEXT))
    return whole(dimensions.assign_keys(loaded, "customer_key", ["customer_id"]), "customer_key")


@query("""SELECT 'dim_customer' AS table_name, count(*) AS row_count FROM v_customers UNION ALL
    SELECT 'dim_product', count(*) FROM v_products UNION ALL SELECT 'dim_branch', count(*) FROM v_branches UNION ALL
    SELECT 'dim_date', count(*) FROM v_dates UNION ALL SELECT 'fact_sales', count(*) FROM v_lines""")
def star_load(w: Warehouse):
    """The five tables of the star out to quoted CSV and back through the loader, counted."""
    star = star_of(w)
    files = {}
    for name, table in star.tables().items():
        files[name] = new_table_path(w.spark, name)
        schema = STAR[name]
        sources = {c: F.col(c) for c in table.columns}
        if name == "fact_sales":  # numbered here, and in whole units instead of cents
            sources |= {"sale_id": F.monotonically_increasing_id(), "total_amount": F.col("total_amount") / 100}
        (table.select(*[F.coalesce(sources.get(f.name, F.lit(None)).cast(f.dataType).cast("string"), F.lit("NULL")).alias(f.name)
                        for f in schema.fields])
         .write.option("header", True).option("quote", '"').option("escape", '"').csv(files[name]))
    return load_star(w.spark, files).load_counts()


