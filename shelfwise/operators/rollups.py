"""Monthly roll-ups of the raw inputs to (Month, Region, Category).

Two forms with the same results (tested against each other):

* ``sales_rollup`` / ``inventory_rollup``: one per input, lazy (inventory in
  two aggregations: by key, weather and season, then by key).
* ``*_parts`` + ``combined_rollup_finish``: a hash aggregation of additive
  parts (line level, partial aggregation map-side, one small shuffle), then
  totals and modes on the small result. Parts of disjoint inputs add up, so
  all paths use it.

Rows with a NULL key are removed first, as pandas' ``groupby`` drops them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EXACT_TYPE, davg, dsum0, month_start, sum0
from ..schema import DEFAULT_CATEGORY_MAP, KEY


def remap_category(df: DataFrame, mapping: dict[str, str] | None = None,
                   column: str = "Category") -> DataFrame:
    """Value remap of the category name (inventory spelling → sales)."""
    mapping = DEFAULT_CATEGORY_MAP if mapping is None else mapping
    if not mapping:
        return df
    return df.withColumn(column, _remapped(column, mapping))


def _remapped(column: str, mapping: dict[str, str] | None) -> F.Column:
    """Simultaneous value mapping (each test sees the original value)."""
    mapping = DEFAULT_CATEGORY_MAP if mapping is None else mapping
    expr = F.col(column)
    for old, new in mapping.items():
        expr = F.when(F.col(column) == old, F.lit(new)).otherwise(expr)
    return expr


def _non_null_keys(df: DataFrame) -> DataFrame:
    return df.filter(F.col("Month").isNotNull() & F.col("Region").isNotNull()
                     & F.col("Category").isNotNull())


def _sales_measures(c=lambda n: n) -> list:
    """A2 measures; ``c`` maps a sales column name to the input column."""
    return [
        dsum0(c("Sales_Amount")).alias("Total_Sales_Amount"),
        sum0(c("Quantity_Sold")).alias("Total_Qty_Sold"),
        davg(c("Unit_Cost")).alias("Avg_Unit_Cost"),
        davg(c("Unit_Price")).alias("Avg_Unit_Price"),
        davg(c("Discount")).alias("Avg_Discount_Sales"),
        F.count(c("Product_ID")).alias("Num_Transactions"),
        F.count_if(F.col(c("Customer_Type")) == "New").alias("New_Customers"),
        F.count_if(F.col(c("Customer_Type")) == "Returning").alias("Returning_Customers"),
        F.count_if(F.col(c("Sales_Channel")) == "Online").alias("Online_Txn"),
        F.count_if(F.col(c("Sales_Channel")) == "Retail").alias("Retail_Txn"),
    ]


SALES_MEASURES = ["Total_Sales_Amount", "Total_Qty_Sold", "Avg_Unit_Cost", "Avg_Unit_Price",
                  "Avg_Discount_Sales", "Num_Transactions", "New_Customers",
                  "Returning_Customers", "Online_Txn", "Retail_Txn"]
INVENTORY_MEASURES = ["Inventory_Level", "Units_Sold_Online", "Units_Ordered", "Demand_Forecast",
                      "Avg_Price", "Avg_Discount_Inv", "Weather_Mode", "Holiday_Days",
                      "Competitor_Pricing", "Seasonality"]
SALES_INPUTS = ["Sales_Amount", "Quantity_Sold", "Unit_Cost", "Unit_Price", "Discount",
                "Product_ID", "Customer_Type", "Sales_Channel"]
INVENTORY_INPUTS = ["Inventory_Level", "Units_Sold", "Units_Ordered", "Demand_Forecast", "Price",
                    "Discount", "Weather_Condition", "Holiday_Promotion", "Competitor_Pricing",
                    "Seasonality"]


def inventory_rollup(inventory: DataFrame, category_map: dict[str, str] | None = None) -> DataFrame:
    """A1: inventory records → inv_agg (means, zero-default sums, modes).

    The records meet in a plain hash aggregation of additive parts by key,
    weather and season; each key's few (value, count) pairs then give its
    modes: the most frequent value, the smallest of tied ones, NULL if there
    is none."""
    rows = _non_null_keys(_inventory_rows(remap_category(inventory, category_map), {}, {}))
    sources = [src for _, src in _MODES]
    parts = rows.groupBy(*KEY, *sources).agg(F.count(F.lit(1)).alias("rows"), *_parts(_INVENTORY_SPEC))
    found = [F.collect_list(F.when(F.col(src).isNotNull(), F.struct(F.col(src).alias("v"), "rows"))).alias(name)
             for name, src in _MODES]
    out = parts.groupBy(*KEY).agg(*_finals(_INVENTORY_SPEC), *found)
    return out.withColumns({name: _most_frequent(name) for name, _ in _MODES}).select(*KEY, *INVENTORY_MEASURES)


def _most_frequent(pairs: str) -> F.Column:
    """Of (v, rows) pairs the v with the most rows, the smallest of tied ones."""
    def counted(v):
        mine = F.filter(pairs, lambda p: p["v"] == v)
        return F.struct((-F.aggregate(mine, F.lit(0).cast("bigint"), lambda n, p: n + p["rows"])).alias("c"), v.alias("v"))
    return F.array_min(F.transform(F.array_distinct(F.transform(pairs, lambda p: p["v"])), counted))["v"]


def sales_rollup(sales: DataFrame) -> DataFrame:
    """A2 (+P2, F1): sales transactions → sales_agg. Double sums and means
    are exact (``dsum``), so results do not depend on the partitioning."""
    df = (sales.withColumnRenamed("Product_Category", "Category")
          .withColumn("Month", month_start("Sale_Date")))
    return _non_null_keys(df).groupBy(*KEY).agg(*_sales_measures())


def split_rollup(combined: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sales_agg, inv_agg) from :func:`combined_rollup_finish`."""
    sales = combined.filter(F.col("kind") == "S").select(*KEY, *SALES_MEASURES)
    inv = combined.filter(F.col("kind") == "I").select(*KEY, *INVENTORY_MEASURES)
    return sales, inv


# --------------------------------------------------------------------------
# Two-step form of the combined roll-up (line level → small table).
#
# ``mode`` is an object aggregate; with more than a few hundred keys per
# task Spark's object hash aggregation falls back to sorting every input
# row. The line-level step therefore only computes additive parts (sums,
# counts, the integer / fraction parts of exact sums) in a plain hash
# aggregation, with the two mode columns added to the group key (their
# values are few: weather conditions, seasons). The second step runs on that
# small table: it adds the parts up per (kind, month, region, category) and
# picks each mode as the most frequent value, smallest on ties.
# --------------------------------------------------------------------------
_SCALE = 1024.0   # same split as functions.columns.dsum


_LOW = 24         # bits of the lower half of an exact sum's integers


def _exact_parts(col: str, name: str) -> list:
    """The integers are summed as two halves in BIGINT, which costs a line a
    fraction of a DECIMAL sum; together they hold what no BIGINT sum could
    (values of 2^40 in 2^37 lines of a group)."""
    y = F.col(col) * F.lit(_SCALE)
    hi = F.floor(y)
    whole = hi.cast("bigint")
    return [F.sum(F.shiftright(whole, _LOW)).alias(f"{name}__hi"),
            F.sum(whole.bitwiseAND(F.lit((1 << _LOW) - 1).cast("bigint"))).alias(f"{name}__mid"),
            F.sum(y - hi).alias(f"{name}__lo")]


def _exact_total(name: str) -> F.Column:
    hi, mid = (F.sum(F.col(f"{name}__{half}").cast(EXACT_TYPE)) for half in ("hi", "mid"))
    return ((hi * F.lit(1 << _LOW) + mid).cast("double") + F.sum(f"{name}__lo")) / F.lit(_SCALE)


# (output name, kind of measure, input column or (column, value) to count)
_SALES_SPEC = [
    ("Total_Sales_Amount", "dsum0", "s_Sales_Amount"),
    ("Total_Qty_Sold", "sum0", "s_Quantity_Sold"),
    ("Avg_Unit_Cost", "davg", "s_Unit_Cost"),
    ("Avg_Unit_Price", "davg", "s_Unit_Price"),
    ("Avg_Discount_Sales", "davg", "s_Discount"),
    ("Num_Transactions", "count", "s_Product_ID"),
    ("New_Customers", "count_if", ("s_Customer_Type", "New")),
    ("Returning_Customers", "count_if", ("s_Customer_Type", "Returning")),
    ("Online_Txn", "count_if", ("s_Sales_Channel", "Online")),
    ("Retail_Txn", "count_if", ("s_Sales_Channel", "Retail")),
]
_INVENTORY_SPEC = [
    ("Inventory_Level", "davg", "i_Inventory_Level"),
    ("Units_Sold_Online", "sum0", "i_Units_Sold"),
    ("Units_Ordered", "sum0", "i_Units_Ordered"),
    ("Demand_Forecast", "davg", "i_Demand_Forecast"),
    ("Avg_Price", "davg", "i_Price"),
    ("Avg_Discount_Inv", "davg", "i_Discount"),
    ("Holiday_Days", "sum0", "i_Holiday_Promotion"),
    ("Competitor_Pricing", "davg", "i_Competitor_Pricing"),
]
_MODES = [("Weather_Mode", "i_Weather_Condition"), ("Seasonality", "i_Seasonality")]


def _parts(spec) -> list:
    out = []
    for name, kind, src in spec:
        if kind in ("dsum0", "davg"):
            out += _exact_parts(src, name)
        if kind == "davg":
            out.append(F.count(src).alias(f"{name}__n"))
        if kind == "sum0":
            out.append(F.sum(src).alias(f"{name}__s"))
        if kind == "count":
            out.append(F.count(src).alias(f"{name}__n"))
        if kind == "count_if":
            column, value = src
            out.append(F.count_if(F.col(column) == value).alias(f"{name}__n"))
    return out


def _finals(spec) -> list:
    out = []
    for name, kind, _src in spec:
        if kind == "dsum0":
            out.append(F.coalesce(_exact_total(name), F.lit(0.0)).alias(name))
        elif kind == "davg":
            out.append((_exact_total(name) / F.nullif(F.sum(f"{name}__n"), F.lit(0))).alias(name))
        elif kind == "sum0":
            out.append(F.coalesce(F.sum(f"{name}__s"), F.lit(0)).cast("bigint").alias(name))
        else:
            out.append(F.sum(f"{name}__n").cast("bigint").alias(name))
    return out


def _typed_nulls(types: dict, cols: list[str]) -> list:
    return [F.lit(None).cast(types[c]).alias(c) for c in cols]


def _parts_by_key(rows: DataFrame) -> DataFrame:
    mode_keys = [src for _, src in _MODES]
    return (rows.groupBy("kind", *KEY, *mode_keys)
            .agg(F.count(F.lit(1)).alias("rows"), *_parts(_SALES_SPEC), *_parts(_INVENTORY_SPEC),
                 *[F.count(src).alias(f"{src}__n") for src in mode_keys]))


def combined_rollup_parts(facts: DataFrame, category_map: dict[str, str] | None = None) -> DataFrame:
    """Step 1 (line level) over line facts: one hash aggregation by (kind,
    month, region, category, weather, season) of additive parts only."""
    types = dict(facts.dtypes)
    s_cols = [f"s_{n}" for n in SALES_INPUTS]
    i_cols = [f"i_{n}" for n in INVENTORY_INPUTS]
    sales_row = F.struct(
        F.lit("S").alias("kind"), month_start("s_Sale_Date").alias("Month"),
        F.col("s_Region").alias("Region"), F.col("s_Category").alias("Category"),
        *[F.col(c).alias(c) for c in s_cols], *_typed_nulls(types, i_cols))
    inv_row = F.struct(
        F.lit("I").alias("kind"), month_start("i_Date").alias("Month"),
        F.col("i_Region").alias("Region"), _remapped("i_Category", category_map).alias("Category"),
        *_typed_nulls(types, s_cols), *[F.col(c).alias(c) for c in i_cols])
    rows = (facts.select(F.explode(F.array(F.when(F.col("s_ok"), sales_row),
                                           F.when(F.col("i_ok"), inv_row))).alias("r"))
            .select("r.*").filter(F.col("kind").isNotNull()))
    return _parts_by_key(rows)


def _sales_rows(sales: DataFrame, i_types: dict) -> DataFrame:
    i_cols = [f"i_{n}" for n in INVENTORY_INPUTS]
    return sales.select(
        F.lit("S").alias("kind"), month_start("Sale_Date").alias("Month"), "Region",
        F.col("Product_Category").alias("Category"),
        *[F.col(n).alias(f"s_{n}") for n in SALES_INPUTS], *_typed_nulls(i_types, i_cols))


def _inventory_rows(inventory: DataFrame, s_types: dict,
                    category_map: dict[str, str] | None) -> DataFrame:
    return inventory.select(
        F.lit("I").alias("kind"), month_start("Date").alias("Month"), "Region",
        _remapped("Category", category_map).alias("Category"),
        *_typed_nulls(s_types, [f"s_{n}" for n in SALES_INPUTS if s_types]), *[F.col(n).alias(f"i_{n}") for n in INVENTORY_INPUTS])


def _contract_types() -> tuple[dict, dict]:
    from ..schema import INVENTORY_SCHEMA, SALES_SCHEMA
    s_types = {f"s_{f.name}": f.dataType.simpleString() for f in SALES_SCHEMA.fields}
    i_types = {f"i_{f.name}": f.dataType.simpleString() for f in INVENTORY_SCHEMA.fields}
    return s_types, i_types


def raw_rollup_parts(sales: DataFrame, inventory: DataFrame,
                     category_map: dict[str, str] | None = None) -> DataFrame:
    """Step 1 over the two raw inputs (CSV contract): kind-tagged rows of
    both, one hash aggregation of additive parts."""
    s_types, i_types = _contract_types()
    return _parts_by_key(_sales_rows(sales, i_types)
                         .unionByName(_inventory_rows(inventory, s_types, category_map)))


def combined_rollup_finish(parts: DataFrame) -> DataFrame:
    """Step 2 (small table): totals and modes per (kind, month, region,
    category): kind, month, region, category, then every sales and
    inventory measure (only the row kind's own measures are meaningful).
    Lines that lack a key were counted in the parts and go here."""
    keys = ["kind", *KEY]
    parts = _non_null_keys(parts)
    totals = parts.groupBy(*keys).agg(*_finals(_SALES_SPEC), *_finals(_INVENTORY_SPEC))
    for name, src in _MODES:
        counts = (parts.filter(F.col(src).isNotNull()).groupBy(*keys, src)
                  .agg(F.sum(f"{src}__n").alias("_c")))
        mode = counts.groupBy(*keys).agg(
            F.min_by(src, F.struct((-F.col("_c")).alias("c"), F.col(src).alias("v"))).alias(name))
        totals = totals.join(mode, keys, "left")
    return totals.select(*keys, *SALES_MEASURES, *INVENTORY_MEASURES)
