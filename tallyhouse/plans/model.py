"""Table schemas, the star model and the snowflake model built from it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyhouse.operators.changes import one_per_key
from tallyhouse.operators.dimensions import (
    add_parent, extract_lookup, flatten_dimension, normalise_dimension)
from tallyhouse.operators.joins import union_all
from tallyhouse.operators.quality import key_report, orphan_counts, row_counts
from tallyhouse.session import written
from tallyhouse.sources.delimited import NULL_TOKENS, read_table


INT, LONG, TEXT, DATE, MOMENT = (
    T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType())


def columns(**types: T.DataType) -> T.StructType:
    """A table schema, in the order given."""
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


# Food orders: order grain, amounts on the order.
FOOD_CUSTOMERS = columns(
    customer_id=INT, first_name=TEXT, last_name=TEXT, email=TEXT, phone=TEXT, address=TEXT)
FOOD_ITEMS = columns(
    food_id=INT, name=TEXT, price=T.DecimalType(10, 2), category=TEXT, availability=TEXT)
FOOD_ORDERS = columns(
    order_id=INT, customer_id=INT, food_id=INT, quantity=INT, order_date=MOMENT, status=TEXT,
    total_amount=T.DecimalType(10, 2))

# Retail sales with a sale date on each row.
SALES = columns(
    sales_id=INT, customer_id=INT, product_id=INT, branch_id=INT, quantity=INT,
    sale_date=DATE, total_amount=T.DecimalType(12, 2))
PRODUCTS = columns(product_id=INT, product_name=TEXT, category=TEXT, price=T.DecimalType(12, 2))
CUSTOMERS = columns(customer_id=INT, customer_name=TEXT, city=TEXT, membership=TEXT)
BRANCHES = columns(branch_id=INT, branch_name=TEXT, state=TEXT)

# Star model. Generated sale numbers have gaps and outgrow 32 bits.
STAR = {
    "dim_customer": columns(
        customer_id=INT, customer_name=TEXT, city=TEXT, state=TEXT, membership=TEXT),
    "dim_product": columns(
        product_id=INT, product_name=TEXT, category=TEXT, brand=TEXT,
        price=T.DecimalType(15, 2)),
    "dim_branch": columns(
        branch_id=INT, branch_name=TEXT, city=TEXT, state=TEXT, region=TEXT,
        manager_name=TEXT),
    "dim_date": columns(
        date_id=INT, date=DATE, day=INT, day_name=TEXT, week_no=INT, month=TEXT,
        quarter=TEXT, year=INT, is_weekend=TEXT),
    "fact_sales": columns(
        sale_id=LONG, customer_id=INT, product_id=INT, branch_id=INT, date_id=INT,
        quantity=INT, total_amount=T.DecimalType(15, 2)),
}

# Customer history.
CUSTOMER_STATE = columns(
    customer_id=INT, customer_name=TEXT, city=TEXT, state=TEXT, membership=TEXT, segment=TEXT)
CUSTOMER_UPDATES = columns(
    customer_id=INT, customer_name=TEXT, city=TEXT, state=TEXT, membership=TEXT, segment=TEXT,
    effective_date=DATE)

# The region each state belongs to.
STATE_REGION = {
    "Telangana": "South", "Karnataka": "South", "Tamil Nadu": "South", "Maharashtra": "West",
    "Delhi": "North", "Gujarat": "West", "West Bengal": "East", "Rajasthan": "North",
    "Kerala": "South", "Uttar Pradesh": "North", "Andhra Pradesh": "South", "Bihar": "North",
    "Madhya Pradesh": "North", "Chandigarh": "North",
}


@dataclass(frozen=True)
class Star:
    customer: DataFrame
    product: DataFrame
    branch: DataFrame
    date: DataFrame
    sales: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_customer": self.customer, "dim_product": self.product,
                "dim_branch": self.branch, "dim_date": self.date, "fact_sales": self.sales}

    def register_views(self) -> None:
        """Make the tables available to ``spark.sql`` under their usual names."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    def references(self) -> dict[str, tuple[DataFrame, str]]:
        return {"customer": (self.customer, "customer_id"), "product": (self.product, "product_id"),
                "branch": (self.branch, "branch_id"), "date": (self.date, "date_id")}

    def load_counts(self) -> DataFrame:
        return row_counts(self.tables())

    def declared_key_report(self) -> DataFrame:
        keys = {"dim_customer": ["customer_id"], "dim_product": ["product_id"],
                "dim_branch": ["branch_id"], "dim_date": ["date_id"], "fact_sales": ["sale_id"]}
        return key_report({name: (df, keys[name]) for name, df in self.tables().items()})

    def unmatched_facts(self) -> DataFrame:
        return orphan_counts(self.sales, self.references())


def load_star(spark: SparkSession, files: Mapping[str, str], quote: str = '"',
              null_tokens=NULL_TOKENS) -> Star:
    """Load the five tables from CSV; ``files`` maps a table name to its path."""
    loaded = {name: read_table(spark, files[name], schema, quote=quote, null_tokens=null_tokens)
              for name, schema in STAR.items()}
    return Star(loaded["dim_customer"], loaded["dim_product"], loaded["dim_branch"],
                loaded["dim_date"], loaded["fact_sales"])


def stored_property(build):
    """A lookup that is built when first used, stored, and read from there by every other part."""
    @wraps(build)
    def once(self) -> DataFrame:
        return written(build(self), build.__name__.strip("_"))

    return cached_property(once)


class Snowflake:
    """The star's dimensions split into lookup chains; each part is built when first used.

    Places come from customers and branches together. Every lookup is made
    distinct on its full natural key before it is numbered, and joined back
    on that key, so no row is multiplied or lost.
    """

    def __init__(self, star: Star, state_region: Mapping[str, str] = STATE_REGION):
        self.star, self.state_region = star, state_region
        self.sales = star.sales

    # --- places: region, state, city -------------------------------------------------

    @stored_property
    def _states(self) -> DataFrame:
        """Each state with its region: as the dimensions say, else by the fixed list."""
        holders = [d for d in (self.star.branch, self.star.customer) if "region" in d.columns]
        stated = one_per_key(union_all([d.select("state", "region") for d in holders]), ["state"])
        listed = F.create_map(*[F.lit(x) for pair in self.state_region.items() for x in pair])
        return (self._places.select("state").distinct().join(stated, "state", "left")
                .withColumn("region", F.coalesce("region", F.try_element_at(listed, F.col("state")))))

    @property
    def _places(self) -> DataFrame:
        return self.star.branch.select("city", "state").unionByName(
            self.star.customer.select("city", "state"))

    @stored_property
    def _region_ids(self) -> DataFrame:
        return extract_lookup(self._states.filter("region is not null"), ["region"], "region_id")

    @stored_property
    def _state_ids(self) -> DataFrame:
        return extract_lookup(self._states, ["state", "region"], "state_id")

    @stored_property
    def _city_ids(self) -> DataFrame:
        return extract_lookup(self._places, ["city", "state"], "city_id")

    @property
    def region(self) -> DataFrame:
        return self._region_ids.select("region_id", F.col("region").alias("region_name"))

    @property
    def state(self) -> DataFrame:
        return (add_parent(self._state_ids, self._region_ids, ["region"], "region_id")
                .select("state_id", F.col("state").alias("state_name"), "region_id"))

    @property
    def city(self) -> DataFrame:
        return (add_parent(self._city_ids, self._state_ids, ["state"], "state_id")
                .select("city_id", F.col("city").alias("city_name"), "state_id"))

    # --- products: category, brand ---------------------------------------------------

    @stored_property
    def _category_ids(self) -> DataFrame:
        return extract_lookup(self.star.product, ["category"], "category_id")

    @stored_property
    def _brand_ids(self) -> DataFrame:
        return extract_lookup(self.star.product, ["brand", "category"], "brand_id")

    @property
    def category(self) -> DataFrame:
        return self._category_ids.select("category_id", F.col("category").alias("category_name"))

    @property
    def brand(self) -> DataFrame:
        return (add_parent(self._brand_ids, self._category_ids, ["category"], "category_id")
                .select("brand_id", F.col("brand").alias("brand_name"), "category_id"))

    # --- calendar: year, quarter, month ----------------------------------------------

    @stored_property
    def _year_ids(self) -> DataFrame:
        return extract_lookup(self.star.date, ["year"], "year_id")

    @stored_property
    def _quarter_ids(self) -> DataFrame:
        return extract_lookup(self.star.date, ["year", "quarter"], "quarter_id")

    @stored_property
    def _month_ids(self) -> DataFrame:
        return extract_lookup(self.star.date, ["year", "quarter", "month"], "month_id")

    @property
    def year(self) -> DataFrame:
        return self._year_ids.select("year_id", F.col("year").alias("year_value"))

    @property
    def quarter(self) -> DataFrame:
        return (add_parent(self._quarter_ids, self._year_ids, ["year"], "year_id")
                .select("quarter_id", F.col("quarter").alias("quarter_name"), "year_id"))

    @property
    def month(self) -> DataFrame:
        return (add_parent(self._month_ids, self._quarter_ids, ["year", "quarter"], "quarter_id")
                .select("month_id", F.col("month").alias("month_name"), "quarter_id"))

    # --- dimensions that refer to the lookups ------------------------------------------

    @property
    def customer(self) -> DataFrame:
        return normalise_dimension(self.star.customer, self._city_ids, ["city", "state"], "city_id") \
            .drop("region")

    @property
    def branch(self) -> DataFrame:
        return normalise_dimension(self.star.branch, self._city_ids, ["city", "state"], "city_id") \
            .drop("region")

    @property
    def product(self) -> DataFrame:
        return normalise_dimension(self.star.product, self._brand_ids, ["brand", "category"], "brand_id")

    @property
    def date(self) -> DataFrame:
        return normalise_dimension(self.star.date, self._month_ids, ["year", "quarter", "month"],
                                   "month_id")

    # --- flattened back for reports ------------------------------------------------------

    def product_flat(self) -> DataFrame:
        return flatten_dimension(self.product, [(self.brand, "brand_id"), (self.category, "category_id")])

    def customer_flat(self) -> DataFrame:
        return flatten_dimension(self.customer, self._place_chain())

    def branch_flat(self) -> DataFrame:
        return flatten_dimension(self.branch, self._place_chain())

    def date_flat(self) -> DataFrame:
        return flatten_dimension(self.date, [(self.month, "month_id"), (self.quarter, "quarter_id"),
                                             (self.year, "year_id")])

    def _place_chain(self):
        return [(self.city, "city_id"), (self.state, "state_id"), (self.region, "region_id")]

    def unmatched_facts(self) -> DataFrame:
        return orphan_counts(self.sales, {
            "customer": (self.customer, "customer_id"), "product": (self.product, "product_id"),
            "branch": (self.branch, "branch_id"), "date": (self.date, "date_id")})
