"""Earlier states and net changes of a log, stored totals, incremental loads.

The log of orders, derived from the orders, has four versions: (1) orders up
to 1998 arrive, (2) the later ones arrive, (3) all pending (P) orders are
deleted, (4) open (O) orders of 1995 to 1997 turn finished (F).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators import changes
from tallyhouse.operators.stored_totals import Dashboard, Maintained, add_totals, read_totals
from tallyhouse.plans.registry import Warehouse, amounts, query
from tallyhouse.plans.reports import first_rows
from tallyhouse.session import new_table_path
from tallyhouse.sources.delimited import stream_table
from tallyhouse.streaming.incremental import load_new_files, loaded_per_batch, loaded_rows

LOADED, ARRIVED, DELETED, CLOSED = 1, 2, 3, 4
KEY = ["order_id"]
_COLUMNS = "order_id, customer_id, sale_date, status, CAST(order_amount AS DOUBLE) AS order_amount"


def order_log(w: Warehouse) -> DataFrame:
    """One pass over the orders gives every entry of the log."""
    early = F.col("sale_date") < F.lit("1999-01-01").cast("date")
    reopened = (F.col("status") == "O") & (F.col("sale_date") < F.lit("1998-01-01").cast("date"))
    entry = lambda version, op, status: F.struct(
        F.lit(version).cast("long").alias("version"), F.lit(op).alias("op"), status.alias("status"))
    own = F.col("status")
    entries = F.filter(F.array(
        F.when(early, entry(LOADED, "I", own)).otherwise(entry(ARRIVED, "I", own)),
        F.when(own == "P", entry(DELETED, "D", own)), F.when(reopened, entry(CLOSED, "D", own)),
        F.when(reopened, entry(CLOSED, "I", F.lit("F")))), lambda e: e.isNotNull())
    exploded = w.orders().withColumn("e", F.explode(entries)).drop("status")
    return exploded.select("order_id", "customer_id", "sale_date", "e.status", "order_amount", "e.op", "e.version")


@query(f"SELECT {_COLUMNS} FROM v_orders WHERE status <> 'P'")
def snapshot_as_of(w: Warehouse):
    """The orders as they were after the deletion and before the closing."""
    return amounts(changes.state_of(order_log(w), KEY, DELETED), "order_amount")


@query("""SELECT order_id, customer_id, sale_date, CAST(order_amount AS DOUBLE) AS order_amount,
    CASE WHEN status = 'O' AND sale_date < DATE '1998-01-01' THEN 'F' ELSE status END AS status
    FROM v_orders WHERE status <> 'P'""")
def snapshot_latest(w: Warehouse):
    return amounts(changes.state_of(order_log(w), KEY, CLOSED), "order_amount")


@query(f"""SELECT {_COLUMNS}, 'INSERT' AS action, FALSE AS is_update FROM v_orders
    WHERE status <> 'P' AND sale_date >= DATE '1999-01-01' UNION ALL
    SELECT {_COLUMNS}, 'DELETE', FALSE FROM v_orders WHERE status = 'P' AND sale_date < DATE '1999-01-01'
    UNION ALL SELECT {_COLUMNS}, 'DELETE', TRUE FROM v_orders
    WHERE status = 'O' AND sale_date < DATE '1998-01-01' UNION ALL
    SELECT order_id, customer_id, sale_date, 'F', CAST(order_amount AS DOUBLE), 'INSERT', TRUE
    FROM v_orders WHERE status = 'O' AND sale_date < DATE '1998-01-01'""")
def change_feed(w: Warehouse):
    """Everything since the first load; pending orders that came and went are not listed."""
    log = order_log(w)
    feed = changes.net_changes(changes.state_of(log, KEY, LOADED), changes.state_of(log, KEY, CLOSED), KEY)
    return amounts(feed, "order_amount")


@query("""SELECT action, count(*) AS feed_rows FROM (SELECT 'INSERT' AS action FROM v_orders
    WHERE status <> 'P' AND sale_date >= DATE '1999-01-01' UNION ALL
    SELECT 'DELETE' FROM v_orders WHERE status = 'P' AND sale_date < DATE '1999-01-01') GROUP BY action""")
def change_feed_count(w: Warehouse):
    log = order_log(w)
    feed = changes.net_changes(changes.state_of(log, KEY, LOADED), changes.state_of(log, KEY, DELETED), KEY)
    return feed.groupBy("action").agg(F.count(F.lit(1)).alias("feed_rows"))


@query(f"SELECT {_COLUMNS}, status = 'P' AS restored FROM v_orders")
def restore_from_ledger(w: Warehouse):
    """Deleted rows, marked, brought back from the version before the deletion."""
    log = order_log(w)
    left = changes.state_of(log, KEY, DELETED).withColumn("restored", F.lit(False))
    earlier = changes.state_of(log, KEY, ARRIVED).withColumn("restored", F.lit(True))
    return amounts(changes.restore_rows(left, earlier, KEY, F.col("status") == "P"), "order_amount")


@query("""SELECT 'base' AS side, count(*) AS orders, CAST(sum(order_amount) AS DOUBLE) AS order_amount
    FROM v_orders UNION ALL SELECT 'branch', count(*), CAST(sum(order_amount) AS DOUBLE)
    FROM v_orders WHERE status <> 'F'""")
def branch_isolation(w: Warehouse):
    """What if finished orders were deleted: the log with those entries beside the log without them."""
    log = order_log(w)
    what_if = log.unionByName(w.orders().filter("status = 'F'").withColumns(
        {"op": F.lit("D"), "version": F.lit(ARRIVED + 1).cast("long")}))

    def summary(side: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("orders"), F.sum("order_amount").alias("order_amount")) \
            .select(F.lit(side).alias("side"), "orders", "order_amount")

    arrived = log.filter(F.col("version") <= ARRIVED)
    tried = what_if.filter((F.col("version") <= ARRIVED) | (F.col("status") == "F") & (F.col("op") == "D"))
    both = summary("base", changes.state_of(arrived, KEY, DELETED)).unionByName(
        summary("branch", changes.state_of(tried, KEY, DELETED)))
    return amounts(both, "order_amount")


@query("""SELECT version, op, count(*) AS rows, min(order_id) AS first_key, max(order_id) AS last_key
    FROM (SELECT CAST(CASE WHEN sale_date < DATE '1999-01-01' THEN 1 ELSE 2 END AS BIGINT) AS version,
    'I' AS op, order_id FROM v_orders UNION ALL SELECT 3, 'D', order_id FROM v_orders WHERE status = 'P')
    GROUP BY ALL""")
def audit_trail(w: Warehouse):
    """Rows per version and operation, with the range of their keys."""
    return order_log(w).filter(F.col("version") <= DELETED).groupBy("version", "op").agg(
        F.count(F.lit(1)).alias("rows"), F.min("order_id").alias("first_key"), F.max("order_id").alias("last_key"))


_TOTALS = {"total_revenue": ("sum", "order_amount"), "orders": ("count", "order_id")}


@query("""SELECT customer_id, CAST(sum(order_amount) AS DOUBLE) AS total_revenue, count(*) AS orders
    FROM v_orders GROUP BY customer_id""")
def refresh_aggregate(w: Warehouse):
    """Stored customer totals, refreshed with the later orders; one refresh is repeated."""
    orders, path = w.orders(), new_table_path(w.spark, "customer-totals")
    early = F.col("sale_date") < F.lit("1999-01-01").cast("date")
    add_totals(orders.filter(early), path, ["customer_id"], _TOTALS, "1")
    add_totals(orders.filter(~early), path, ["customer_id"], _TOTALS, "2")
    add_totals(orders.filter(~early), path, ["customer_id"], _TOTALS, "2")
    return amounts(read_totals(w.spark, path, ["customer_id"], list(_TOTALS)), "total_revenue")


@query("""SELECT customer_id, CAST(sum(order_amount) AS DOUBLE) AS total_revenue FROM v_orders
    GROUP BY customer_id ORDER BY 2 DESC, 1 LIMIT 1""")
def stored_top_customer(w: Warehouse):
    """The head of a stored aggregate, sorted where it is read."""
    path = new_table_path(w.spark, "top-customers")
    add_totals(w.orders(), path, ["customer_id"], {"total_revenue": ("sum", "order_amount")}, "1")
    stored = read_totals(w.spark, path, ["customer_id"], ["total_revenue"])
    return amounts(first_rows(stored, ["-total_revenue", "customer_id"], 1), "total_revenue")


@query("""SELECT c.region, count(*) AS orders, count(DISTINCT o.customer_id) AS customers,
    count(DISTINCT o.sale_date) AS days, CAST(sum(o.order_amount) AS DOUBLE) AS total_revenue,
    avg(CAST(o.order_amount AS DOUBLE)) AS average_order
    FROM v_orders o JOIN v_customers c ON c.customer_id = o.customer_id GROUP BY c.region""")
def stored_regional_dashboard(w: Warehouse):
    """A stored dashboard with exact distinct counts and averages after three batches; one of them is added twice."""
    placed = w.orders().join(w.customers().select("customer_id", "region"), "customer_id")
    board = Dashboard(new_table_path(w.spark, "regional-dashboard"), ["region"], "orders",
                      sums={"total_revenue": "order_amount"}, averages={"average_order": "order_amount"},
                      distincts={"customers": "customer_id", "days": "sale_date"})
    batches = {"1": F.year("sale_date") < 1997, "2": F.year("sale_date").between(1997, 1999), "3": F.year("sale_date") > 1999}
    for name, arrived in [*batches.items(), ("2", batches["2"])]:
        board.add(placed.filter(arrived), name)
    return amounts(board.read(w.spark), "total_revenue", "average_order")


_FINAL = """(SELECT CAST(year(sale_date) AS BIGINT) AS year, order_amount,
    CASE WHEN status = 'O' AND sale_date < DATE '1998-01-01' THEN 'F' ELSE status END AS status
    FROM v_orders WHERE status <> 'P' OR year(sale_date) = 1997)"""


def _maintained_orders(w: Warehouse) -> tuple[Maintained, int]:
    """Totals by status and year that followed the log: loads, deletions, updates, then deleted orders of 1997 restored."""
    spans = w.staged("order-spans", lambda: changes.row_spans(order_log(w), KEY).select(
        *KEY, "status", F.year("sale_date").cast("long").alias("year"), "order_amount", "since", "until"))
    totals = Maintained(new_table_path(w.spark, "maintained-orders"), ["status", "year"], "orders",
                        sums={"total_revenue": "order_amount"},
                        extremes={"smallest_order": ("min", "order_amount"), "largest_order": ("max", "order_amount")})
    for version in (LOADED, ARRIVED, DELETED, CLOSED):
        totals.apply(changes.changes_at(spans, version), version, changes.present_at(spans, version))
    lost = (F.col("status") == "P") & (F.col("year") == 1997)
    before, arrived = (changes.present_at(spans, version) for version in (CLOSED, ARRIVED))
    restored = w.staged("orders-restored", lambda: changes.lost_rows(before, arrived, KEY, lost))
    for _ in range(2):
        totals.apply(restored.withColumn("action", F.lit("INSERT")), CLOSED + 1, before.unionByName(restored))
    return totals, CLOSED + 1


_MONEY = ("total_revenue", "smallest_order", "largest_order")
_MAINTAINED = """SELECT status, year, count(*) AS orders, CAST(sum(order_amount) AS DOUBLE) AS total_revenue,
    CAST(min(order_amount) AS DOUBLE) AS smallest_order, CAST(max(order_amount) AS DOUBLE) AS largest_order"""


@query(f"{_MAINTAINED} FROM {_FINAL} GROUP BY ALL")
def maintained_totals(w: Warehouse):
    """Stored totals after inserts, deletes, updates and a restoration, the last one applied twice."""
    totals, version = _maintained_orders(w)
    return amounts(totals.read(w.spark, version), *_MONEY)


@query(f"""{_MAINTAINED} FROM (SELECT CAST(year(sale_date) AS BIGINT) AS year, status, order_amount
    FROM v_orders WHERE status <> 'P') GROUP BY ALL""")
def maintained_totals_as_of(w: Warehouse):
    """The same stored totals as they were after the deletion."""
    totals, _ = _maintained_orders(w)
    return amounts(totals.read(w.spark, DELETED), *_MONEY)


# --- incremental loads --------------------------------------------------------------------

#: Events arrive three times; the later arrivals repeat all earlier events with another value.
_FILE = "CASE WHEN value < 20 THEN 1 WHEN value < 60 THEN 2 ELSE 3 END"


def _event_loads(w: Warehouse) -> tuple[str, DataFrame]:
    """Each arrival is loaded when it has come, as one batch of all its files; a last call finds nothing new."""
    events = w.table("events").withColumn("file", F.coalesce(F.expr(_FILE), F.lit(3)))
    schema = w.table("events").schema
    source, target, progress = (new_table_path(w.spark, name) for name in ("event-files", "events", "events-progress"))
    for number in (1, 2, 3, None):
        if number:
            value = F.when(F.col("file") < number, F.col("value") + 1000).otherwise(F.col("value"))
            (events.filter(F.col("file") <= number).withColumn("value", value).drop("file")
             .write.mode("append").parquet(source))
        load_new_files(w.spark.readStream.schema(schema).parquet(source), target, ["event_id"], progress)
    return target, w.table("events")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def incremental_load(w: Warehouse):
    """Each event as it was when it first arrived."""
    target, events = _event_loads(w)
    return loaded_rows(w.spark, target, events.schema)


@query(f"SELECT CAST({_FILE} AS BIGINT) AS version, count(*) AS inserted_rows FROM events GROUP BY 1")
def incremental_load_counts(w: Warehouse):
    target, events = _event_loads(w)
    counted = loaded_per_batch(w.spark, target, events.schema)
    number = F.regexp_extract("batch", r"-(\d+)$", 1).try_cast("long") + 1
    return counted.select(number.alias("version"), "inserted_rows")


@query("""SELECT c_custkey AS customer_id, c_name || ' says "hi", ok' AS customer_name,
    CAST(CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS DOUBLE) AS balance FROM customer""")
def csv_stream_load(w: Warehouse):
    """Quoted CSV with doubled quotes and null tokens, in two files, as a stream into a keyed table."""
    source = new_table_path(w.spark, "customer-files")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(15,2)").cast("string"))
    rows = w.table("customer").select(
        F.col("c_custkey").alias("other_header"), F.concat("c_name", F.lit(' says "hi", ok')).alias("name"),
        F.coalesce(balance, F.lit("NULL")).alias("balance"), "c_acctbal")
    for part in ("c_acctbal < 5000", "c_acctbal is null or c_acctbal >= 0"):  # half of them twice
        (rows.filter(part).drop("c_acctbal").write.mode("append").option("header", True)
         .option("quote", '"').option("escape", '"').csv(source))
    schema = "customer_id long, customer_name string, balance decimal(15,2)"
    target, progress = new_table_path(w.spark, "customers"), new_table_path(w.spark, "customers-progress")
    stream = stream_table(w.spark, source, _schema_of(w, schema), quote='"', null_tokens=("NULL", "null"))
    load_new_files(stream, target, ["customer_id"], progress)
    return loaded_rows(w.spark, target, stream.schema).withColumn("balance", F.col("balance").cast("double"))


def _schema_of(w: Warehouse, ddl: str):
    return w.spark.createDataFrame([], ddl).schema
