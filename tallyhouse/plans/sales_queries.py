"""Sales reports, ranks, running totals and checks on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.expressions import after_day, code_of, full_name, month_start
from tallyhouse.operators import ordering, quality, totals
from tallyhouse.plans import reports
from tallyhouse.plans.registry import Warehouse, amounts, query, whole

LINE_SALES = {"total_revenue": ("sum", "total_amount")}
ORDER_SALES = {"total_revenue": ("sum", "order_amount")}
LINE_DASHBOARD = reports.dashboard(sale="order_id")
# Order-grain rows already carry the number of their lines.
FOLDED_DASHBOARD = {"total_transactions": ("sum", "line_count"), "units_sold": ("sum", "quantity"),
                    "total_revenue": ("sum", "total_amount")}

SUM_LINES = "CAST(sum(total_amount) AS DOUBLE) AS total_revenue"
SUM_ORDERS = "CAST(sum(order_amount) AS DOUBLE) AS total_revenue"


# --- totals -------------------------------------------------------------------

@query("""SELECT CAST(sum(quantity) AS DOUBLE) AS total_quantity,
    CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM v_lines""")
def total_revenue(w: Warehouse):
    both = {"total_quantity": ("sum", "quantity"), "total_revenue": ("sum", "total_amount")}
    return amounts(reports.revenue(w.lines(), both), "total_revenue")


@query("""SELECT count(*) AS sales, CAST(sum(CAST(order_amount * 100 AS BIGINT)) AS DOUBLE)
    / count(*) / 100 AS average_sale FROM v_orders""")
def average_sale(w: Warehouse):
    both = w.orders().agg(F.count(F.lit(1)).alias("sales"), F.avg("order_amount").alias("average_sale"))
    return amounts(both, "average_sale")


@query(f"SELECT status, {SUM_ORDERS} FROM v_orders GROUP BY status ORDER BY 2 DESC")
def status_revenue(w: Warehouse):
    return amounts(reports.revenue_by(w.orders(), ["status"], ORDER_SALES), "total_revenue")


@query(f"""SELECT customer_id, customer_name, {SUM_LINES} FROM v_sales
    JOIN v_customers USING (customer_id) GROUP BY ALL""")
def customer_revenue(w: Warehouse):
    return amounts(reports.revenue_per_entity(
        w.sales_per_order(), w.customer_names(), "customer_id", ["customer_name"], LINE_SALES), "total_revenue")


@query(f"""SELECT product_id, product_name, {SUM_LINES} FROM v_lines
    JOIN v_products USING (product_id) GROUP BY ALL""")
def product_revenue(w: Warehouse):
    return amounts(reports.revenue_per_entity(
        w.lines(), w.products(), "product_id", ["product_name"]), "total_revenue")


@query(f"""SELECT branch_id, branch_name, {SUM_LINES} FROM v_lines
    JOIN v_branches USING (branch_id) GROUP BY ALL""")
def branch_revenue(w: Warehouse):
    return amounts(reports.revenue_per_entity(
        w.lines(), w.branch_names(), "branch_id", ["branch_name"]), "total_revenue")


@query(f"SELECT category, {SUM_LINES} FROM v_lines JOIN v_products USING (product_id) GROUP BY ALL")
def category_revenue(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.lines(), w.products(), "product_id", ["category"]), "total_revenue")


@query(f"SELECT brand, {SUM_LINES} FROM v_lines JOIN v_products USING (product_id) GROUP BY ALL")
def brand_revenue(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.lines(), w.products(), "product_id", ["brand"]), "total_revenue")


@query(f"SELECT state, {SUM_LINES} FROM v_lines JOIN v_branches USING (branch_id) GROUP BY ALL")
def state_revenue_by_branch(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.lines(), w.branches(), "branch_id", ["state"]), "total_revenue")


@query(f"SELECT state, {SUM_LINES} FROM v_sales JOIN v_customers USING (customer_id) GROUP BY ALL")
def state_revenue_by_customer(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.sales_per_order(), w.customers(), "customer_id", ["state"]), "total_revenue")


@query(f"SELECT region, {SUM_LINES} FROM v_lines JOIN v_branches USING (branch_id) GROUP BY ALL")
def region_revenue_by_branch(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.lines(), w.branches(), "branch_id", ["region"]), "total_revenue")


@query(f"""SELECT region, count(DISTINCT customer_id) AS customers, count(*) AS total_transactions,
    CAST(sum(quantity) AS DOUBLE) AS units_sold, {SUM_LINES}
    FROM v_sales JOIN v_customers USING (customer_id) GROUP BY region""")
def regional_dashboard(w: Warehouse):
    return amounts(reports.revenue_per_attribute(
        w.sales_per_order(), w.customers(), "customer_id", ["region"], FOLDED_DASHBOARD,
        count_keys_as="customers"), "total_revenue")


@query(f"""SELECT product_id, product_name, category, brand, count(*) AS total_transactions,
    CAST(sum(quantity) AS DOUBLE) AS units_sold, {SUM_LINES}
    FROM v_lines JOIN v_products USING (product_id) GROUP BY ALL""")
def product_dashboard(w: Warehouse):
    return amounts(reports.revenue_per_entity(
        w.lines(), w.products(), "product_id", ["product_name", "category", "brand"],
        LINE_DASHBOARD), "total_revenue")


@query(f"""SELECT branch_id, branch_name, state, region, count(*) AS total_transactions,
    CAST(sum(quantity) AS DOUBLE) AS units_sold, {SUM_LINES}
    FROM v_lines JOIN v_branches USING (branch_id) GROUP BY ALL""")
def branch_dashboard(w: Warehouse):
    return amounts(reports.revenue_per_entity(
        w.lines(), w.branches(), "branch_id", ["branch_name", "state", "region"],
        LINE_DASHBOARD), "total_revenue")


# --- periods --------------------------------------------------------------------

@query(f"""SELECT year, month, {SUM_LINES} FROM v_sales JOIN v_dates ON date = sale_date
    GROUP BY year, month""")
def monthly_revenue(w: Warehouse):
    dates = w.dates().withColumn("sale_date", F.col("date"))
    report = reports.revenue_per_period(w.sales_per_order(), dates, "sale_date", ["year", "month"])
    return whole(amounts(report, "total_revenue"), "year")


@query(f"""SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month_start, {SUM_ORDERS}
    FROM v_orders GROUP BY ALL""")
def revenue_by_month_start(w: Warehouse):
    orders = w.orders().withColumn("month_start", month_start("sale_date"))
    return amounts(reports.revenue_by(orders, ["month_start"], ORDER_SALES, ["month_start"]),
                   "total_revenue")


@query(f"""SELECT year, quarter, {SUM_LINES} FROM v_sales JOIN v_dates ON date = sale_date
    GROUP BY year, quarter""")
def quarterly_revenue(w: Warehouse):
    dates = w.dates().withColumn("sale_date", F.col("date"))
    report = reports.revenue_per_period(w.sales_per_order(), dates, "sale_date", ["year", "quarter"])
    return whole(amounts(report, "total_revenue"), "year")


@query(f"SELECT sale_date, {SUM_LINES} FROM v_sales GROUP BY sale_date")
def daily_trend(w: Warehouse):
    return amounts(reports.revenue_by(
        w.sales_per_order(), ["sale_date"], LINE_SALES, ["sale_date"]), "total_revenue")


@query(f"""SELECT customer_id, customer_name, year, month, count(*) AS purchases, {SUM_LINES}
    FROM v_sales JOIN v_customers USING (customer_id) JOIN v_dates ON date = sale_date GROUP BY ALL""")
def purchase_trend(w: Warehouse):
    dates = w.dates().withColumn("sale_date", F.col("date"))
    report = reports.purchase_trend(
        w.sales_per_order(), w.customer_names(), dates, "customer_id", "sale_date", ["customer_name"],
        ["year", "month"], {"purchases": ("sum", "line_count"), **LINE_SALES})
    return whole(amounts(report, "total_revenue"), "year")


# --- top lists and ranks ----------------------------------------------------------

@query(f"""SELECT customer_id, customer_name, {SUM_LINES} FROM v_sales
    JOIN v_customers USING (customer_id) GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 10""")
def top10_customers(w: Warehouse):
    return amounts(reports.top_sellers(
        w.sales_per_order(), w.customer_names(), "customer_id", ["customer_name"], 10), "total_revenue")


@query(f"""SELECT product_id, product_name, {SUM_LINES} FROM v_lines
    JOIN v_products USING (product_id) GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 10""")
def top10_products(w: Warehouse):
    return amounts(reports.top_sellers(
        w.lines(), w.products(), "product_id", ["product_name"], 10), "total_revenue")


@query(f"""SELECT branch_id, branch_name, {SUM_LINES} FROM v_lines
    JOIN v_branches USING (branch_id) GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 10""")
def top10_branches(w: Warehouse):
    return amounts(reports.top_sellers(
        w.lines(), w.branch_names(), "branch_id", ["branch_name"], 10), "total_revenue")


@query(f"""SELECT product_id, product_name, {SUM_LINES} FROM v_lines
    JOIN v_products USING (product_id) GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 5""")
def top5_products(w: Warehouse):
    return amounts(reports.top_sellers(
        w.lines(), w.products(), "product_id", ["product_name"], 5), "total_revenue")


@query(f"""SELECT branch_id, branch_name, {SUM_LINES} FROM v_lines
    JOIN v_branches USING (branch_id) GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 1""")
def top1_branch(w: Warehouse):
    return amounts(reports.top_sellers(
        w.lines(), w.branch_names(), "branch_id", ["branch_name"], 1), "total_revenue")


@query(f"""SELECT customer_id, customer_name, {SUM_ORDERS} FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL ORDER BY 3 DESC, 1 LIMIT 1""")
def top1_customer(w: Warehouse):
    return amounts(reports.top_sellers(
        w.orders(), w.customer_names(), "customer_id", ["customer_name"], 1, ORDER_SALES), "total_revenue")


@query(f"""SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS rank FROM (
    SELECT customer_id, customer_name, {SUM_ORDERS} FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL)""")
def customer_rank(w: Warehouse):
    return amounts(reports.ranked(
        w.orders(), w.customer_names(), "customer_id", ["customer_name"], ORDER_SALES), "total_revenue")


@query(f"""SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS rank FROM (
    SELECT branch_id, branch_name, {SUM_LINES} FROM v_lines
    JOIN v_branches USING (branch_id) GROUP BY ALL)""")
def branch_rank(w: Warehouse):
    return amounts(reports.ranked(
        w.lines(), w.branch_names(), "branch_id", ["branch_name"]), "total_revenue")


@query("""SELECT *, rank() OVER (ORDER BY purchases DESC) AS rank FROM (
    SELECT customer_id, customer_name, count(*) AS purchases FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL) QUALIFY rank <= 3""")
def top3_ranks_with_ties(w: Warehouse):
    return reports.ranked(w.orders(), w.customer_names(), "customer_id", ["customer_name"],
                          {"purchases": ("count", "order_id")}, "purchases", 3)


@query(f"""SELECT *, row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC, product_id)
    AS row_number FROM (SELECT product_id, product_name, category, {SUM_LINES} FROM v_lines
    JOIN v_products USING (product_id) GROUP BY ALL)""")
def product_row_number(w: Warehouse):
    return amounts(reports.numbered_in_group(
        w.lines(), w.products(), "product_id", ["product_name"], "category"), "total_revenue")


@query(f"""SELECT * FROM (SELECT product_id, product_name, category, {SUM_LINES} FROM v_lines
    JOIN v_products USING (product_id) GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY category ORDER BY total_revenue DESC, product_id) = 1""")
def top_product_per_category(w: Warehouse):
    return amounts(reports.best_in_group(
        w.lines(), w.products(), "product_id", ["product_name"], "category"), "total_revenue")


# --- running totals -----------------------------------------------------------------

@query("""SELECT order_id, sale_date, CAST(order_amount AS DOUBLE) AS order_amount,
    CAST(sum(order_amount) OVER (ORDER BY sale_date, order_id) AS DOUBLE) AS running_revenue
    FROM v_orders""")
def running_revenue_asc(w: Warehouse):
    orders = w.orders().select("order_id", "sale_date", "order_amount")
    run = ordering.running_total(orders, ["sale_date", "order_id"], "order_amount",
                                 "running_revenue", unique=True)
    return amounts(run, "order_amount", "running_revenue")


@query("""SELECT order_id, sale_date,
    CAST(sum(order_amount) OVER (ORDER BY sale_date DESC) AS DOUBLE) AS cumulative_sales
    FROM v_orders""")
def running_revenue_desc(w: Warehouse):
    run = ordering.running_by_day(w.orders(), "sale_date", "order_amount",
                                  total_as="cumulative_sales", descending=True)
    return amounts(run.select("order_id", "sale_date", "cumulative_sales"), "cumulative_sales")


@query("""SELECT order_id, sale_date, CAST(CAST(sum(order_amount) OVER w * 100 AS BIGINT) AS DOUBLE)
    / CAST(count(order_amount) OVER w AS DOUBLE) / 100 AS avg_sales
    FROM v_orders WINDOW w AS (ORDER BY sale_date DESC)""")
def running_avg(w: Warehouse):
    run = ordering.running_by_day(w.orders(), "sale_date", "order_amount",
                                  average_as="avg_sales", descending=True)
    return amounts(run.select("order_id", "sale_date", "avg_sales"), "avg_sales")


@query("""SELECT order_id, line_number, ship_date, branch_id, CAST(sum(total_amount) OVER (
    PARTITION BY branch_id ORDER BY ship_date) AS DOUBLE) AS branch_running_revenue FROM v_lines""")
def running_revenue_per_branch(w: Warehouse):
    lines = w.lines().select("order_id", "line_number", "ship_date", "branch_id", "total_amount")
    run = ordering.running_total(lines, ["ship_date"], "total_amount", "branch_running_revenue",
                                 within=["branch_id"])
    return amounts(run.drop("total_amount"), "branch_running_revenue")


# --- filters and comparisons ----------------------------------------------------------

@query(f"""SELECT customer_id, customer_name, {SUM_ORDERS} FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL
    HAVING sum(order_amount) > (SELECT avg(order_amount) FROM v_orders)""")
def customers_above_avg_txn(w: Warehouse):
    return amounts(reports.above_average_sale(
        w.orders(), w.customer_names(), "customer_id", ["customer_name"], "order_amount"), "total_revenue")


@query(f"""SELECT * FROM (SELECT customer_id, customer_name, {SUM_ORDERS} FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL) WHERE total_revenue > (SELECT avg(total) FROM
    (SELECT sum(order_amount) AS total FROM v_orders JOIN v_customers USING (customer_id)
    GROUP BY customer_id))""")
def customers_above_avg_customer(w: Warehouse):
    return amounts(reports.above_average_entity(
        w.orders(), w.customer_names(), "customer_id", ["customer_name"], "order_amount"), "total_revenue")


@query("""SELECT customer_id, customer_name, count(order_id) AS purchases FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL""")
def purchase_frequency(w: Warehouse):
    return reports.purchase_frequency(
        w.orders(), w.customer_names(), "customer_id", ["customer_name"], "order_id")


@query("""SELECT c.customer_id, c.customer_name, count(o.order_id) AS purchases
    FROM (SELECT customer_id, customer_name FROM v_customers
    UNION ALL SELECT -1 - customer_id, customer_name FROM v_customers) c
    LEFT JOIN v_orders o ON o.customer_id = c.customer_id GROUP BY ALL""")
def purchase_frequency_all(w: Warehouse):
    """Every customer comes a second time under an id that never bought."""
    names = w.customer_names()
    without = names.withColumn("customer_id", -1 - F.col("customer_id"))
    return reports.purchase_frequency_all(w.orders(), names.unionByName(without), "customer_id", ["customer_name"])


@query("""SELECT order_id, customer_id, status, CAST(order_amount AS DOUBLE) AS order_amount
    FROM v_orders WHERE status = 'F'""")
def orders_by_status(w: Warehouse):
    return amounts(w.orders().filter(F.col("status") == "F")
                   .select("order_id", "customer_id", "status", "order_amount"), "order_amount")


@query("""SELECT order_id, customer_name, sale_date, status, CAST(order_amount AS DOUBLE) AS order_amount
    FROM v_orders JOIN v_customers USING (customer_id) WHERE sale_date > DATE '2000-07-12'""")
def orders_after_date(w: Warehouse):
    late = w.table("orders").filter(after_day("o_orderdate", "2000-07-12")).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("sale_date"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("order_amount"))
    names = w.customer_names()
    return late.join(names, "customer_id").select(
        "order_id", "customer_name", "sale_date", "status", "order_amount")


@query("SELECT customer_id, customer_name || ' ' || membership AS label FROM v_customers")
def full_name_concat(w: Warehouse):
    return w.customers().select("customer_id", full_name("customer_name", "membership").alias("label"))


# The codes of the order states.
STATUS_CODES = {"O": 1, "P": 2, "F": 3}


@query("""SELECT order_id, CAST(CASE status WHEN 'O' THEN 1 WHEN 'P' THEN 2 WHEN 'F' THEN 3 END
    AS BIGINT) AS status_code FROM v_orders""")
def code_mapping(w: Warehouse):
    return whole(w.orders().select("order_id", code_of("status", STATUS_CODES).alias("status_code")),
                 "status_code")


@query("SELECT DISTINCT category FROM v_products WHERE category LIKE 'S%'")
def prefix_match(w: Warehouse):
    return w.products().filter(F.col("category").like("S%")).select("category").distinct()


# --- checks -----------------------------------------------------------------------------

@query("""SELECT count(*) AS total_sales, count(DISTINCT order_id) AS orders,
    count(DISTINCT product_id) AS products, count(DISTINCT branch_id) AS branches,
    count(DISTINCT ship_date) AS dates FROM v_lines""")
def key_profile(w: Warehouse):
    keys = {"orders": "order_id", "products": "product_id", "branches": "branch_id", "dates": "ship_date"}
    return totals.key_profile(w.lines(), keys, "total_sales")


@query("""SELECT order_id, line_number, count(*) AS duplicate_count FROM v_lines
    GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(w: Warehouse):
    return quality.duplicate_keys(w.lines(), ["order_id", "line_number"])


#: All lines, and the large ones once more with keys that no table has.
STRAYS = """(SELECT order_id, line_number, product_id, branch_id FROM v_lines UNION ALL
    SELECT -1 - order_id, line_number, -1 - product_id, NULL FROM v_lines WHERE quantity >= 45)"""


def lines_with_strays(w: Warehouse) -> DataFrame:
    lines = w.lines()
    strays = lines.filter("quantity >= 45").withColumns({
        "order_id": -1 - F.col("order_id"), "product_id": -1 - F.col("product_id"), "branch_id": F.lit(None).cast("long")})
    return lines.unionByName(strays).select("order_id", "line_number", "product_id", "branch_id")


@query("SELECT -1 - order_id AS order_id, line_number, -1 - product_id AS product_id, CAST(NULL AS BIGINT) AS branch_id "
       "FROM v_lines WHERE quantity >= 45")
def orphan_rows(w: Warehouse):
    """The planted strays among all sales."""
    return quality.orphan_rows(lines_with_strays(w), w.branch_names(), "branch_id")


@query(f"""SELECT 'branch' AS dimension, count(*) AS unmatched_rows FROM {STRAYS} l
    WHERE NOT EXISTS (SELECT 1 FROM v_branches b WHERE b.branch_id = l.branch_id AND balance >= 0) UNION ALL
    SELECT 'product', count(*) FROM {STRAYS} WHERE product_id NOT IN
    (SELECT product_id FROM v_products WHERE price >= 1000) UNION ALL
    SELECT 'order', count(*) FROM {STRAYS} WHERE order_id NOT IN (SELECT order_id FROM v_orders)""")
def orphan_counts(w: Warehouse):
    """Sales, strays among them, outside branches in good standing, dear products and all orders."""
    return quality.orphan_counts(lines_with_strays(w), {
        "branch": (w.branch_names().filter("balance >= 0"), "branch_id"),
        "product": (w.products().filter("price >= 1000"), "product_id"),
        "order": (w.orders(), "order_id")})


@query(f"""SELECT 'product' AS dimension, count(*) AS unmatched_rows FROM {STRAYS}
    WHERE product_id NOT IN (SELECT product_id FROM v_products) UNION ALL
    SELECT 'branch', count(*) FROM {STRAYS} l WHERE NOT EXISTS
    (SELECT 1 FROM v_branches b WHERE b.branch_id = l.branch_id)
    UNION ALL SELECT 'order', count(*) FROM {STRAYS} WHERE order_id NOT IN (SELECT order_id FROM v_orders)""")
def reference_report(w: Warehouse):
    """Every declared reference of the sales; only the strays break one."""
    return quality.orphan_counts(lines_with_strays(w), {
        "product": (w.products(), "product_id"), "branch": (w.branch_names(), "branch_id"),
        "order": (w.orders(), "order_id")})


@query(f"""SELECT state || ' ' || (customer_id % 7) AS city, {SUM_ORDERS} FROM v_orders
    JOIN v_customers USING (customer_id) GROUP BY ALL""")
def city_revenue(w: Warehouse):
    """Revenue by city; the customers' cities follow a rule, as the given table has none."""
    city = F.concat_ws(" ", "state", (F.col("customer_id") % 7).cast("string"))
    placed = w.customers().select("customer_id", city.alias("city"))
    return amounts(reports.revenue_per_attribute(
        w.orders(), placed, "customer_id", ["city"], {"total_revenue": ("sum", "order_amount")}), "total_revenue")


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem")))
def row_counts(w: Warehouse):
    return quality.row_counts({t: w.table(t) for t in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem")})


def _keys_sql(table: str, key: str, is_null: str) -> str:
    return f"""SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count,
        CAST(coalesce(sum(n) FILTER ({is_null}), 0) AS BIGINT) AS null_keys,
        count(*) FILTER (n > 1 AND NOT ({is_null})) AS repeated_keys
        FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})"""


@query(" UNION ALL ".join([
    _keys_sql("customer", "c_custkey", "c_custkey IS NULL"),
    _keys_sql("part", "p_partkey", "p_partkey IS NULL"),
    _keys_sql("supplier", "s_suppkey", "s_suppkey IS NULL"),
    _keys_sql("orders", "o_orderkey", "o_orderkey IS NULL"),
    _keys_sql("lineitem", "l_orderkey, l_linenumber", "l_orderkey IS NULL OR l_linenumber IS NULL")]))
def pk_fk_report(w: Warehouse):
    return quality.key_report({
        "customer": (w.table("customer"), ["c_custkey"]), "part": (w.table("part"), ["p_partkey"]),
        "supplier": (w.table("supplier"), ["s_suppkey"]), "orders": (w.table("orders"), ["o_orderkey"]),
        "lineitem": (w.table("lineitem"), ["l_orderkey", "l_linenumber"])})
