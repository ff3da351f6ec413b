"""Row changes and dimension history on the given tables.

The changes are derived from the orders: each year with orders ends in a
review of the customer on the first of January, which sets the membership by
the year's spending and the segment with it. A batch thus holds several
changes per customer, reviews that change nothing, and customers whose
membership was unknown (NULL) before.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators import changes, history
from tallyhouse.operators.asof import asof_join
from tallyhouse.operators.dimensions import assign_keys
from tallyhouse.operators.totals import totals_by
from tallyhouse.plans.registry import Warehouse, amounts, query
from tallyhouse.session import new_table_path
from tallyhouse.sources.tables import append_rows, literal_rows, replace_rows

TRACKED = ["customer_name", "state", "region", "membership", "segment"]
COMPARED = ["state", "region", "membership", "segment"]
START = "1995-01-01"


def reviews(w: Warehouse) -> DataFrame:
    """The staging table of changes."""
    return w.staged("reviews", lambda: _yearly_reviews(w))


def _yearly_reviews(w: Warehouse) -> DataFrame:
    yearly = (w.orders().groupBy("customer_id", F.year("sale_date").alias("y"))
              .agg(F.sum("order_amount").alias("spend")))
    spend = F.col("spend")
    tier = (F.when(spend >= 600000_00, "Platinum").when(spend >= 300000_00, "Gold")
            .when(spend >= 100000_00, "Silver").otherwise("Bronze"))
    known = w.customers().drop("membership")
    return yearly.join(known, "customer_id").select(
        "customer_id", "customer_name", "state", "region", tier.alias("membership"),
        F.when(spend >= 600000_00, "PREMIUM").otherwise(F.col("segment")).alias("segment"),
        F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).alias("effective_date"))


def last_reviews(w: Warehouse) -> DataFrame:
    return changes.one_per_key(_yearly_reviews(w), ["customer_id"], ["effective_date"])


# --- writes -------------------------------------------------------------------------------

@query("""SELECT order_id, customer_id, sale_date, status, CAST(order_amount AS DOUBLE) AS order_amount
    FROM v_orders UNION ALL SELECT -1, -1, DATE '2002-01-01', 'X', 240.0""")
def insert_select(w: Warehouse):
    """A table filled by two appended selections and one row of literals."""
    orders, path = w.orders(), new_table_path(w.spark, "orders")
    append_rows(orders.filter("status = 'P'"), path)
    append_rows(orders.filter("status <> 'P'"), path)
    append_rows(literal_rows(w.spark, [(-1, -1, date(2002, 1, 1), "X", 240_00)], orders.schema), path)
    return amounts(w.spark.read.schema(orders.schema).parquet(path), "order_amount")


@query("""SELECT order_id, customer_id, sale_date, status, CAST(order_amount AS DOUBLE) AS order_amount
    FROM v_orders WHERE status = 'F'""")
def truncate_reload(w: Warehouse):
    orders, path = w.orders(), new_table_path(w.spark, "orders")
    append_rows(orders.filter("status <> 'F'"), path)
    replace_rows(orders.filter("status = 'F'"), path)
    return amounts(w.spark.read.schema(orders.schema).parquet(path), "order_amount")


# --- merge, delete, restore -----------------------------------------------------------

_ORDER_COLUMNS = "order_id, customer_id, sale_date, status, CAST(order_amount AS DOUBLE) AS order_amount"


@query(f"""SELECT {_ORDER_COLUMNS} FROM v_orders UNION ALL
    SELECT NULL, customer_id, sale_date, status, CAST(order_amount AS DOUBLE) FROM v_orders
    WHERE sale_date >= DATE '1999-07-01' AND status = 'P'""")
def merge_insert(w: Warehouse):
    """A batch that overlaps the history by half a year, merged on the order id.

    Its pending orders come once more without an id; each of them is inserted.
    """
    orders = w.orders()
    held = orders.filter("sale_date < date '2000-01-01'")
    batch = orders.filter("sale_date >= date '1999-07-01'")
    nameless = batch.filter("status = 'P'").withColumn("order_id", F.lit(None).cast("long"))
    return amounts(changes.merge_insert(held, batch.unionByName(nameless), ["order_id"]), "order_amount")


@query("SELECT count(*) AS new_records FROM v_orders WHERE sale_date >= DATE '2000-01-01'")
def new_record_count(w: Warehouse):
    orders = w.orders()
    fresh = changes.new_rows(orders.filter("sale_date < date '2000-01-01'"),
                             orders.filter("sale_date >= date '1999-07-01'"), ["order_id"])
    return fresh.agg(F.count(F.lit(1)).alias("new_records"))


@query(f"""SELECT {_ORDER_COLUMNS} FROM v_orders
    WHERE NOT (status = 'P' AND sale_date < DATE '1997-01-01')""")
def delete_where(w: Warehouse):
    stale = (F.col("status") == "P") & (F.col("sale_date") < F.lit("1997-01-01").cast("date"))
    return amounts(changes.delete_where(w.orders(), stale), "order_amount")


@query(f"""SELECT {_ORDER_COLUMNS}, status = 'P' AND sale_date < DATE '1997-01-01' AS restored FROM v_orders""")
def restore_rows(w: Warehouse):
    """Restored rows carry a mark."""
    stale = (F.col("status") == "P") & (F.col("sale_date") < F.lit("1997-01-01").cast("date"))
    left = changes.delete_where(w.orders(), stale).withColumn("restored", F.lit(False))
    earlier = w.orders().withColumn("restored", F.lit(True))
    return amounts(changes.restore_rows(left, earlier, ["order_id"], stale), "order_amount")


# --- change reports and type 1 ----------------------------------------------------------

@query("""SELECT c.customer_id, c.state AS old_state, u.state AS new_state, c.region AS old_region,
    u.region AS new_region, c.membership AS old_membership, u.membership AS new_membership,
    c.segment AS old_segment, u.segment AS new_segment FROM v_customers c
    JOIN v_last_review u ON u.customer_id = c.customer_id
    WHERE c.membership IS DISTINCT FROM u.membership OR c.segment IS DISTINCT FROM u.segment""")
def changed_rows(w: Warehouse):
    return changes.changed_rows(w.customers(), last_reviews(w), "customer_id", COMPARED) \
        .orderBy("customer_id")


@query("""SELECT c.customer_id, 'membership' AS attribute, c.membership AS old_value,
    u.membership AS new_value FROM v_customers c JOIN v_last_review u ON u.customer_id = c.customer_id
    WHERE c.membership IS DISTINCT FROM u.membership UNION ALL
    SELECT c.customer_id, 'segment', c.segment, u.segment FROM v_customers c
    JOIN v_last_review u ON u.customer_id = c.customer_id WHERE c.segment IS DISTINCT FROM u.segment""")
def changed_attributes(w: Warehouse):
    return changes.changed_attributes(w.customers(), last_reviews(w), "customer_id", COMPARED) \
        .orderBy("customer_id", "attribute")


@query("""SELECT c.customer_id, c.customer_name, c.state, c.region,
    CASE WHEN u.customer_id IS NULL THEN c.membership ELSE u.membership END AS membership,
    CASE WHEN u.customer_id IS NULL THEN c.segment ELSE u.segment END AS segment
    FROM v_customers c LEFT JOIN v_last_review u ON u.customer_id = c.customer_id""")
def scd1(w: Warehouse):
    return changes.overwrite_attributes(w.customers(), last_reviews(w), "customer_id", TRACKED)


# --- type 2 -------------------------------------------------------------------------------

_STATE = "customer_id, customer_name, state, region, membership, segment"
_PERIOD = "effective_date, expiry_date, is_current"


def versions(w: Warehouse) -> DataFrame:
    """The dimension after one batch."""
    return history.apply_versions(history.start_versions(w.customers(), START), reviews(w),
                                  "customer_id", TRACKED)


@query(f"""SELECT {_STATE}, DATE '1995-01-01' AS effective_date, DATE '9999-12-31' AS expiry_date,
    TRUE AS is_current FROM v_customers""")
def scd2_load(w: Warehouse):
    return history.start_versions(w.customers(), START)


@query(f"SELECT {_STATE}, {_PERIOD} FROM v_versions")
def scd2_apply(w: Warehouse):
    return versions(w)


@query(f"SELECT {_STATE} FROM v_versions WHERE is_current")
def scd2_current(w: Warehouse):
    return history.current_rows(versions(w)).drop(*history.PERIOD)


@query(f"SELECT customer_id, membership, {_PERIOD} FROM v_versions")
def scd2_history(w: Warehouse):
    return (versions(w).select("customer_id", "membership", *history.PERIOD)
            .orderBy("customer_id", "effective_date"))


@query(f"""SELECT customer_id, membership, {_PERIOD} FROM v_versions WHERE customer_id IN (7, 42, 99)""")
def scd2_history_of_keys(w: Warehouse):
    """The versions of three customers, oldest first."""
    return (history.history_of(versions(w), "customer_id", [7, 42, 99])
            .select("customer_id", "membership", *history.PERIOD))


@query(f"""SELECT {_STATE}, effective_date, expiry_date FROM v_versions
    WHERE DATE '1999-06-30' BETWEEN effective_date AND expiry_date""")
def scd2_as_of(w: Warehouse):
    return history.as_of(versions(w), "1999-06-30").drop("is_current")


@query("""SELECT count(*) AS total_records, count(*) FILTER (is_current) AS current_records,
    count(*) FILTER (NOT is_current) AS historical_records FROM v_versions""")
def scd2_counts(w: Warehouse):
    return history.version_counts(versions(w))


def stored_versions(w: Warehouse) -> DataFrame:
    return w.staged("versions", lambda: versions(w))


@query("""SELECT u.*, c.effective_date AS current_since FROM v_reviews u JOIN v_versions c
    ON c.customer_id = u.customer_id AND c.is_current AND u.effective_date <= c.effective_date""")
def scd2_late_changes(w: Warehouse):
    """The same batch again: what lies before the current versions is reported."""
    return history.late_changes(stored_versions(w), reviews(w), "customer_id", TRACKED)


@query(f"SELECT {_STATE}, {_PERIOD} FROM v_versions")
def scd2_replay(w: Warehouse):
    """Applying a batch twice gives what applying it once gives."""
    return history.apply_versions(stored_versions(w), reviews(w), "customer_id", TRACKED)


@query("""SELECT customer_id, effective_date, CASE WHEN effective_date = DATE '1995-01-01'
    THEN row_number() OVER w ELSE (SELECT count(*) FROM v_customers) + row_number() OVER w END
    AS customer_key FROM v_versions WINDOW w AS (PARTITION BY effective_date = DATE '1995-01-01'
    ORDER BY customer_id, effective_date)""")
def scd2_surrogates(w: Warehouse):
    """New versions are numbered after the keys given at the load."""
    loaded = assign_keys(history.start_versions(w.customers(), START), "customer_key", ["customer_id"])
    applied = history.apply_versions(loaded, reviews(w), "customer_id", TRACKED,
                                     surrogate="customer_key")
    filled = history.fill_surrogates(applied, "customer_key", ["customer_id", "effective_date"])
    return filled.select("customer_id", "effective_date", "customer_key")


@query("""SELECT customer_id, 'not exactly one current version' AS fault FROM
    (SELECT customer_id FROM v_versions WHERE is_current INTERSECT SELECT customer_id FROM v_steps)
    UNION ALL SELECT DISTINCT customer_id, 'overlapping versions' FROM v_steps""")
def scd_invariants(w: Warehouse):
    """After a careless second load of the initial rows: changed customers break two rules.

    Customers without changes get an equal row, which ``distinct`` removes.
    """
    applied = versions(w)
    careless = applied.unionByName(history.start_versions(w.customers(), START)).distinct()
    return history.version_faults(careless, "customer_id")


# --- type 3 -----------------------------------------------------------------------------

@query("""SELECT customer_id, customer_name, state, region, membership AS current_membership,
    CAST(NULL AS VARCHAR) AS previous_membership, segment FROM v_customers""")
def scd3_load(w: Warehouse):
    return history.start_previous_value(w.customers(), "membership")


@query("""SELECT c.customer_id, c.customer_name, c.state, c.region,
    CASE WHEN u.customer_id IS NULL THEN c.membership ELSE u.membership END AS current_membership,
    CASE WHEN u.customer_id IS NOT NULL AND c.membership IS DISTINCT FROM u.membership
    THEN c.membership END AS previous_membership,
    CASE WHEN u.customer_id IS NULL THEN c.segment ELSE u.segment END AS segment
    FROM v_customers c LEFT JOIN v_last_review u ON u.customer_id = c.customer_id""")
def scd3_apply(w: Warehouse):
    loaded = history.start_previous_value(w.customers(), "membership")
    return history.shift_previous_value(loaded, last_reviews(w), "customer_id", "membership",
                                        ["customer_name", "state", "region", "segment"])


# --- type 6 -----------------------------------------------------------------------------

_HYBRID = f"""customer_id, customer_name, state, region, membership AS current_membership,
    previous_membership, membership AS historical_membership, segment, {_PERIOD}"""


def hybrid(w: Warehouse) -> DataFrame:
    loaded = history.start_hybrid(w.customers(), "membership", START)
    return history.apply_hybrid(loaded, reviews(w), "customer_id", "membership",
                                ["customer_name", "state", "region", "segment"])


@query("""SELECT customer_id, customer_name, state, region, membership AS current_membership,
    CAST(NULL AS VARCHAR) AS previous_membership, membership AS historical_membership, segment,
    DATE '1995-01-01' AS effective_date, DATE '9999-12-31' AS expiry_date, TRUE AS is_current
    FROM v_customers""")
def scd6_load(w: Warehouse):
    return history.start_hybrid(w.customers(), "membership", START)


@query(f"SELECT {_HYBRID} FROM v_versions")
def scd6_apply(w: Warehouse):
    return hybrid(w)


@query("""SELECT customer_id, membership AS current_membership, previous_membership
    FROM v_versions WHERE is_current""")
def scd6_current(w: Warehouse):
    return history.current_rows(hybrid(w)).select(
        "customer_id", "current_membership", "previous_membership")


@query("""SELECT customer_id, customer_name, membership AS current_membership, effective_date, expiry_date
    FROM v_versions WHERE DATE '1999-06-30' BETWEEN effective_date AND expiry_date""")
def scd6_as_of(w: Warehouse):
    return history.as_of(hybrid(w), "1999-06-30").select(
        "customer_id", "customer_name", "current_membership", "effective_date", "expiry_date")


@query("""SELECT count(*) AS total_records, count(*) FILTER (is_current) AS current_records,
    count(*) FILTER (NOT is_current) AS historical_records FROM v_versions""")
def scd6_counts(w: Warehouse):
    return history.version_counts(hybrid(w))


# --- facts and the versions of their own day ----------------------------------------------

_VERSION = ["membership", "effective_date"]


@query("""SELECT o.order_id, o.customer_id, o.sale_date, v.membership, v.effective_date
    FROM v_orders o ASOF LEFT JOIN v_versions v ON o.customer_id = v.customer_id AND o.sale_date >= v.effective_date""")
def sales_as_of_version(w: Warehouse):
    """Every order with the membership its customer had on the day of the sale."""
    orders = w.orders().select("order_id", "customer_id", "sale_date")
    return asof_join(orders, stored_versions(w), "customer_id", "sale_date", _VERSION)


@query("""SELECT v.membership AS membership_then, n.membership AS membership_now, count(*) AS orders,
    CAST(sum(o.order_amount) AS DOUBLE) AS total_revenue
    FROM v_orders o ASOF LEFT JOIN v_versions v ON o.customer_id = v.customer_id AND o.sale_date >= v.effective_date
    LEFT JOIN v_versions n ON n.customer_id = o.customer_id AND n.is_current GROUP BY ALL""")
def revenue_by_membership_then_and_now(w: Warehouse):
    """Revenue by the membership of the sale's day and by today's; orders are folded per customer and day first."""
    daily = totals_by(w.orders(), ["customer_id", "sale_date"],
                      {"total_revenue": ("sum", "order_amount"), "orders": ("count", "order_id")})
    then = asof_join(daily, stored_versions(w).withColumnRenamed("membership", "membership_then"),
                     "customer_id", "sale_date", ["membership_then"])
    now = history.current_rows(stored_versions(w)).select("customer_id", F.col("membership").alias("membership_now"))
    both = then.join(now, "customer_id", "left").groupBy("membership_then", "membership_now").agg(
        F.sum("orders").alias("orders"), F.sum("total_revenue").alias("total_revenue"))
    return amounts(both, "total_revenue")


@query("""SELECT o.order_id, o.sale_date, c.membership, c.effective_date FROM v_orders o
    ASOF JOIN v_reviews c ON o.customer_id = c.customer_id AND o.sale_date >= c.effective_date""")
def sales_as_of_change(w: Warehouse):
    """The latest review before each sale, straight from the feed; orders before the first review are left out."""
    orders = w.orders().select("order_id", "customer_id", "sale_date")
    found = asof_join(orders, reviews(w), "customer_id", "sale_date", _VERSION, how="inner")
    return found.select("order_id", "sale_date", *_VERSION)
