"""Raw ``sales`` and ``inventory`` inputs derived from the star-schema tables
(``lineitem orders customer supplier part nation region``).

The two raw files of the retail contract are produced here by joins, so every
pipeline stage runs on data whose volume grows with the given tables. The
mapping is fixed (``FIXTURES.md`` §3) and mirrored by the oracle SQL.

Plan shape (per view): the line table is the only large input. Dimension
sides are joined without hints (``join_dimension``): Spark broadcasts them
when they measure small, else both sides are shuffled and sort-merged;
``orders`` meets the line table through a sort-merge join on the order key
(``join_facts``); customers (with region and first-order date) meet
``orders`` behind an exchange of their own (``fresh_exchange``), so AQE can
split the partition of a customer who holds a third of all orders. The
first-order date is a ``groupBy`` (partial aggregation, so such a customer
is combined map-side) rather than a window, which would put that customer
into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import fresh_exchange, join_dimension, join_facts

# Fixed values of the mapping.
# The inventory view stores part type STANDARD as "Groceries" so that the
# category remap has work to do; the remap for these views maps it back.
TESTDATA_CATEGORY_MAP = {"Groceries": "STANDARD"}
ONLINE_PRIORITIES = ["1-URGENT", "2-HIGH"]
PRICE_FACTOR = 55            # part retail price → shelf / competitor price
STOCK_PER_SIZE = 30.0        # part size → units on hand
FORECAST_PER_UNIT = 30       # ordered quantity → demand forecast
DISCOUNT_FACTOR = 4          # line discount (0–0.1) → 0–0.4 discount share
HOLIDAY_LAST_DAY = 7         # days 1..7 of a month count as promotion days
SEASONS = {12: "Winter", 1: "Winter", 2: "Winter",
           3: "Spring", 4: "Spring", 5: "Spring",
           6: "Summer", 7: "Summer", 8: "Summer",
           9: "Autumn", 10: "Autumn", 11: "Autumn"}


#: The given tables that the two raw inputs are derived from.
SOURCES = ("lineitem", "orders", "customer", "supplier", "part", "nation", "region")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (join_dimension(nation, region, nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", "r_name"))


def _orders_enriched(spark: SparkSession, sf_dir: str, geo: DataFrame) -> DataFrame:
    """Order key → sale date, customer region, new/returning, channel."""
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cust_region = (join_dimension(customer, geo, customer.c_nationkey == geo.n_nationkey)
                   .select("c_custkey", F.col("r_name").alias("Region")))
    orders = (_table(spark, sf_dir, "orders")
              .select("o_orderkey", "o_custkey",
                      F.col("o_orderdate").cast("date").alias("Sale_Date"),
                      "o_orderpriority"))
    first_order = (orders.groupBy("o_custkey")
                   .agg(F.min("Sale_Date").alias("first_date"))
                   .withColumnRenamed("o_custkey", "f_custkey"))
    customers = fresh_exchange(
        cust_region.join(first_order, cust_region.c_custkey == first_order.f_custkey)
        .select("c_custkey", "Region", "first_date"), "c_custkey")
    return (
        join_dimension(orders, customers, orders.o_custkey == customers.c_custkey)
        .select(
            "o_orderkey", "Sale_Date", "Region",
            F.when(F.col("Sale_Date") == F.col("first_date"), F.lit("New"))
             .otherwise(F.lit("Returning")).alias("Customer_Type"),
            F.when(F.col("o_orderpriority").isin(*ONLINE_PRIORITIES), F.lit("Online"))
             .otherwise(F.lit("Retail")).alias("Sales_Channel"),
        )
    )


def _supplier_regions(spark: SparkSession, sf_dir: str, geo: DataFrame) -> DataFrame:
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (join_dimension(supplier, geo, supplier.s_nationkey == geo.n_nationkey)
            .select("s_suppkey", F.col("r_name").alias("Region")))


def _sales_columns(region: str) -> list[tuple[str, F.Column]]:
    """The sales contract's columns over joined lines (FIXTURES §3)."""
    return [
        ("Sale_Date", F.col("Sale_Date")),
        ("Region", F.col(region)),
        ("Product_Category", F.col("p_type")),
        ("Sales_Amount", F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))),
        ("Quantity_Sold", F.col("l_quantity").cast("bigint")),
        ("Unit_Cost", F.col("p_retailprice") * F.col("l_quantity")),
        ("Unit_Price", F.col("l_extendedprice")),
        ("Discount", F.col("l_discount") * F.lit(DISCOUNT_FACTOR)),
        ("Product_ID", F.col("l_partkey").cast("string")),
        ("Customer_Type", F.col("Customer_Type")),
        ("Sales_Channel", F.col("Sales_Channel")),
    ]


def _inventory_columns(region: str) -> list[tuple[str, F.Column]]:
    """The inventory contract's columns over joined lines (renamed names)."""
    ship = F.col("l_shipdate").cast("date")
    return [
        ("Date", ship),
        ("Region", F.col(region)),
        ("Category", F.when(F.col("p_type") == "STANDARD", F.lit("Groceries"))
         .otherwise(F.col("p_type"))),
        ("Inventory_Level", F.col("p_size") * F.lit(STOCK_PER_SIZE)),
        ("Units_Sold", F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))
         .otherwise(F.lit(0.0)).cast("bigint")),
        ("Units_Ordered", F.col("l_quantity").cast("bigint")),
        ("Demand_Forecast", F.col("l_quantity") * F.lit(FORECAST_PER_UNIT)),
        ("Price", F.col("p_retailprice") * F.lit(PRICE_FACTOR)),
        ("Discount", F.col("l_discount") * F.lit(DISCOUNT_FACTOR)),
        ("Weather_Condition", F.col("l_returnflag")),
        ("Holiday_Promotion", F.when(F.dayofmonth(ship) <= HOLIDAY_LAST_DAY, F.lit(1))
         .otherwise(F.lit(0))),
        ("Competitor_Pricing", F.col("p_retailprice") * F.lit(PRICE_FACTOR)),
        ("Seasonality", _season(F.month(ship))),
    ]


def _lines(spark: SparkSession, sf_dir: str, *cols: str | F.Column) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(*cols)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")


def sales_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, in the raw sales contract."""
    geo = _nation_regions(spark, sf_dir)
    orders_enriched = _orders_enriched(spark, sf_dir, geo)
    part = _parts(spark, sf_dir)
    lines = _lines(spark, sf_dir, "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
                   "l_discount")
    joined = join_facts(lines, orders_enriched, lines.l_orderkey == orders_enriched.o_orderkey)
    joined = join_dimension(joined, part, joined.l_partkey == part.p_partkey)
    return joined.select(*[c.alias(n) for n, c in _sales_columns("Region")])


def _season(month: F.Column) -> F.Column:
    expr = None
    for m, name in SEASONS.items():
        expr = (F.when(month == m, F.lit(name)) if expr is None
                else expr.when(month == m, F.lit(name)))
    return expr


def inventory_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item, in the raw inventory contract (renamed columns)."""
    geo = _nation_regions(spark, sf_dir)
    supp_region = _supplier_regions(spark, sf_dir, geo)
    part = _parts(spark, sf_dir)
    lines = _lines(spark, sf_dir, "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                   "l_returnflag", "l_linestatus", "l_shipdate")
    joined = join_dimension(lines, supp_region, lines.l_suppkey == supp_region.s_suppkey)
    joined = join_dimension(joined, part, joined.l_partkey == part.p_partkey)
    return joined.select(*[c.alias(n) for n, c in _inventory_columns("Region")])


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both views in one pass over the line table: ``s_*`` (sales) and
    ``i_*`` (inventory) columns per line, ``s_ok`` / ``i_ok`` marking lines
    that belong to each view (inner-join semantics of the separate views).

    The line table is scanned once and joined to supplier (left), orders
    (left, sort-merge) and part (both views need it). Every join but the last
    hands on only what is needed later, and as little of it as says the same:
    dates for times, flags for two-valued texts, no key whose join is done.
    Part comes last, so its columns never travel with the lines. A supplier's
    region is looked up at the line (the few nations are broadcast): Spark
    takes a join's size for the product of its sides, so suppliers joined to
    nations beforehand look large at any size and the lines are shuffled for
    them. Suppliers without a nation go first, as in ``inventory_view``."""
    geo = _nation_regions(spark, sf_dir)
    orders = _orders_enriched(spark, sf_dir, geo).select(
        "o_orderkey", "Sale_Date", F.col("Region").alias("o_region"), F.lit(True).alias("s_ok"),
        (F.col("Customer_Type") == "New").alias("_new"), (F.col("Sales_Channel") == "Online").alias("_online"))
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    supplier = supplier.join(geo, supplier.s_nationkey == geo.n_nationkey, "left_semi")
    nations = F.broadcast(geo.select(F.col("n_nationkey").alias("sup_nation"), F.col("r_name").alias("sup_region"),
                                     F.lit(True).alias("i_ok")))
    part = _parts(spark, sf_dir)
    lines = _lines(spark, sf_dir, "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                   "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    carried = ["l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
               "sup_region", "i_ok"]
    j = join_dimension(lines, supplier, lines.l_suppkey == supplier.s_suppkey, "left")
    j = join_dimension(j, nations, j.s_nationkey == nations.sup_nation, "left").select("l_orderkey", *carried)
    j = join_facts(j, orders, j.l_orderkey == orders.o_orderkey, "left").select(
        *carried, "Sale_Date", "o_region", "s_ok", "_new", "_online")
    j = join_dimension(j, part, j.l_partkey == part.p_partkey)
    j = j.withColumns({"Customer_Type": F.when(F.col("_new"), F.lit("New")).when(~F.col("_new"), F.lit("Returning")),
                       "Sales_Channel": F.when(F.col("_online"), F.lit("Online")).when(~F.col("_online"), F.lit("Retail"))})
    sales = [c.alias(f"s_{'Category' if n == 'Product_Category' else n}")
             for n, c in _sales_columns("o_region")]
    inv = [c.alias(f"i_{n}") for n, c in _inventory_columns("sup_region")]
    return j.select(F.col("s_ok").isNotNull().alias("s_ok"), F.col("i_ok").isNotNull().alias("i_ok"), *sales, *inv)
