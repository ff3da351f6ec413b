"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.functions.expressions import cents, from_cents, money
from tallyhouse.operators.dimensions import date_dimension_for
from tallyhouse.session import written
from tallyhouse.sources.tables import scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
EXPECTED: dict[str, str] = {}


def query(sql: str):
    """Register a function of a :class:`Warehouse` under its own name."""
    def register(build):
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Warehouse(spark, folder))
        EXPECTED[name] = with_sources(sql)
        return build
    return register


class Warehouse:
    """The given tables in their retail roles.

    Customers are ``customer`` with nation as state, branches are
    ``supplier``, products are ``part`` (type as category), sales are
    ``lineitem`` and carry customer and date through ``orders``. Amounts of
    sales and orders are in cents.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._scans: dict[str, DataFrame] = {}
        self._staged: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The table; its files are listed and their schema read once per query."""
        if name not in self._scans:
            self._scans[name] = scan(self.spark, self.folder, name)
        return self._scans[name]

    def staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table that a query reads more than once, stored on first use."""
        if name not in self._staged:
            self._staged[name] = written(build(), name)
        return self._staged[name]

    def _placed(self, df: DataFrame, nation_key: str) -> DataFrame:
        """Nation and region are put together first, so the big table meets one small one.

        A row whose nation is unknown stays, without state and region.
        """
        nation = self.table("nation").select(
            F.col("n_nationkey").alias(nation_key), F.col("n_name").alias("state"), "n_regionkey")
        region = self.table("region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
        placed = nation.join(region, "n_regionkey", "left").drop("n_regionkey")
        return df.join(placed, nation_key, "left")

    def customer_names(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))

    def branch_names(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("branch_id"), F.col("s_name").alias("branch_name"),
            money("s_acctbal").alias("balance"))

    def customers(self) -> DataFrame:
        balance = F.col("c_acctbal")
        tier = (F.when(balance < 0, F.lit(None)).when(balance < 3000, "Bronze")
                .when(balance < 6000, "Silver").when(balance < 9000, "Gold").otherwise("Platinum"))
        base = self.table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
            tier.alias("membership"), F.col("c_mktsegment").alias("segment"), "c_nationkey")
        return self._placed(base, "c_nationkey").select(
            "customer_id", "customer_name", "state", "region", "membership", "segment")

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
            money("p_retailprice").alias("price"))

    def branches(self) -> DataFrame:
        base = self.table("supplier").select(
            F.col("s_suppkey").alias("branch_id"), F.col("s_name").alias("branch_name"),
            money("s_acctbal").alias("balance"), "s_nationkey")
        return self._placed(base, "s_nationkey").select(
            "branch_id", "branch_name", "state", "region", "balance")

    def dates(self) -> DataFrame:
        return date_dimension_for(self.orders(), "sale_date")

    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("sale_date"),
            F.col("o_orderstatus").alias("status"), cents("o_totalprice").alias("order_amount"))

    def lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("branch_id"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            F.col("l_quantity").cast("decimal(15,2)").alias("quantity"),
            cents("l_extendedprice").alias("total_amount"))

    def sales_per_order(self) -> DataFrame:
        """Line totals at order grain with customer, date and status.

        Lines are folded per order before the join: the join then moves one
        row per order and reuses the partitioning of the fold.
        """
        per_order = self.lines().groupBy("order_id").agg(
            F.sum("total_amount").alias("total_amount"), F.sum("quantity").alias("quantity"),
            F.count(F.lit(1)).alias("line_count"))
        return per_order.join(self.orders(), "order_id")


#: Sums of quantities, which are exact decimals until the end.
QUANTITIES = ("total_quantity", "units_sold")


def amounts(df: DataFrame, *columns: str) -> DataFrame:
    """Amounts in cents, and quantities, as doubles, once the exact sums are final."""
    units = {c: F.col(c).cast("double") for c in QUANTITIES if c in df.columns}
    return df.withColumns({c: from_cents(c) for c in columns} | units)


def whole(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


# The same roles in SQL, put in front of every expected query that names them.
_SOURCES = {
    "v_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CAST(o_orderdate AS DATE) AS sale_date, o_orderstatus AS status,
        CAST(o_totalprice AS DECIMAL(15,2)) AS order_amount FROM orders""",
    "v_lines": """SELECT l_orderkey AS order_id, l_linenumber AS line_number,
        l_partkey AS product_id, l_suppkey AS branch_id, CAST(l_shipdate AS DATE) AS ship_date,
        CAST(l_quantity AS DECIMAL(15,2)) AS quantity,
        CAST(l_extendedprice AS DECIMAL(15,2)) AS total_amount FROM lineitem""",
    "v_sales": """SELECT o.customer_id, o.sale_date, o.status, o.order_amount, l.*
        FROM v_lines l JOIN v_orders o ON o.order_id = l.order_id""",
    "v_customers": """SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS state,
        r_name AS region, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 3000 THEN 'Bronze'
        WHEN c_acctbal < 6000 THEN 'Silver' WHEN c_acctbal < 9000 THEN 'Gold'
        ELSE 'Platinum' END AS membership, c_mktsegment AS segment
        FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "v_products": """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
        p_brand AS brand, CAST(p_retailprice AS DECIMAL(15,2)) AS price FROM part""",
    "v_branches": """SELECT s_suppkey AS branch_id, s_name AS branch_name, n_name AS state,
        r_name AS region, CAST(s_acctbal AS DECIMAL(15,2)) AS balance
        FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
        LEFT JOIN region ON r_regionkey = n_regionkey""",
    "v_days": """SELECT CAST(d AS DATE) AS date, CAST(row_number() OVER (ORDER BY d) AS BIGINT) AS date_id
        FROM (SELECT unnest(generate_series(min(sale_date)::TIMESTAMP, max(sale_date)::TIMESTAMP,
        INTERVAL 1 DAY)) AS d FROM v_orders)""",
    "v_dates": """SELECT date_id, date, CAST(day(date) AS BIGINT) AS day, dayname(date) AS day_name,
        CAST(weekofyear(date) AS BIGINT) AS week_no, monthname(date) AS month,
        CAST(month(date) AS BIGINT) AS month_no, 'Q' || quarter(date) AS quarter,
        CAST(year(date) AS BIGINT) AS year,
        CASE WHEN isodow(date) IN (6, 7) THEN 'Yes' ELSE 'No' END AS is_weekend FROM v_days""",
    "v_years": """SELECT customer_id, CAST(year(sale_date) AS BIGINT) AS y,
        sum(order_amount) AS spend FROM v_orders GROUP BY ALL""",
    "v_reviews": """SELECT r.customer_id, c.customer_name, c.state, c.region,
        CASE WHEN spend >= 600000 THEN 'Platinum' WHEN spend >= 300000 THEN 'Gold'
        WHEN spend >= 100000 THEN 'Silver' ELSE 'Bronze' END AS membership,
        CASE WHEN spend >= 600000 THEN 'PREMIUM' ELSE c.segment END AS segment,
        make_date(y + 1, 1, 1) AS effective_date
        FROM v_years r JOIN v_customers c ON c.customer_id = r.customer_id""",
    "v_last_review": """SELECT * FROM v_reviews
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY effective_date DESC) = 1""",
    "v_steps": """SELECT * FROM (SELECT u.*, d.customer_id IS NULL AS is_new_key,
        lag(u.membership) OVER w AS lag_membership, lag(u.segment) OVER w AS lag_segment,
        row_number() OVER w AS step, d.membership AS base_membership, d.segment AS base_segment
        FROM v_reviews u LEFT JOIN v_customers d ON d.customer_id = u.customer_id
        WINDOW w AS (PARTITION BY u.customer_id ORDER BY u.effective_date))
        WHERE CASE WHEN step = 1
        THEN membership IS DISTINCT FROM base_membership OR segment IS DISTINCT FROM base_segment
        ELSE membership IS DISTINCT FROM lag_membership OR segment IS DISTINCT FROM lag_segment END""",
    "v_versions": """SELECT customer_id, customer_name, state, region, membership, segment,
        CASE WHEN step = 1 THEN base_membership ELSE lag_membership END AS previous_membership,
        effective_date, coalesce(lead(effective_date) OVER w - 1, DATE '9999-12-31') AS expiry_date,
        lead(effective_date) OVER w IS NULL AS is_current FROM v_steps
        WINDOW w AS (PARTITION BY customer_id ORDER BY effective_date)
        UNION ALL
        SELECT c.customer_id, c.customer_name, c.state, c.region, c.membership, c.segment, NULL,
        DATE '1995-01-01', coalesce(f.first - 1, DATE '9999-12-31'), f.first IS NULL
        FROM v_customers c LEFT JOIN (SELECT customer_id, min(effective_date) AS first
        FROM v_steps GROUP BY customer_id) f ON f.customer_id = c.customer_id""",
}


def with_sources(sql: str) -> str:
    """Add a WITH clause holding the sources the text names, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in _SOURCES.items():
            if name in text and name not in needed:
                visit(body)
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_SOURCES[n]})" for n in needed) + "\n" + sql
