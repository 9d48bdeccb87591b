"""Column contracts, fixed business constants and parameter objects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Raw input contracts (explicit schemas; the CSV reader never infers types).
# --------------------------------------------------------------------------
SALES_SCHEMA = T.StructType([
    T.StructField("Sale_Date", T.DateType()),
    T.StructField("Region", T.StringType()),
    T.StructField("Product_Category", T.StringType()),
    T.StructField("Sales_Amount", T.DoubleType()),
    T.StructField("Quantity_Sold", T.LongType()),
    T.StructField("Unit_Cost", T.DoubleType()),
    T.StructField("Unit_Price", T.DoubleType()),
    T.StructField("Discount", T.DoubleType()),
    T.StructField("Product_ID", T.StringType()),
    T.StructField("Customer_Type", T.StringType()),
    T.StructField("Sales_Channel", T.StringType()),
])

# Inventory file header as delivered (names with spaces and a slash).
INVENTORY_CSV_SCHEMA = T.StructType([
    T.StructField("Date", T.DateType()),
    T.StructField("Region", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Inventory Level", T.DoubleType()),
    T.StructField("Units Sold", T.LongType()),
    T.StructField("Units Ordered", T.LongType()),
    T.StructField("Demand Forecast", T.DoubleType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Discount", T.DoubleType()),
    T.StructField("Weather Condition", T.StringType()),
    T.StructField("Holiday/Promotion", T.IntegerType()),
    T.StructField("Competitor Pricing", T.DoubleType()),
    T.StructField("Seasonality", T.StringType()),
])

# Snake-safe names used everywhere after the read.
INVENTORY_RENAMES = {
    "Inventory Level": "Inventory_Level",
    "Units Sold": "Units_Sold",
    "Units Ordered": "Units_Ordered",
    "Demand Forecast": "Demand_Forecast",
    "Weather Condition": "Weather_Condition",
    "Holiday/Promotion": "Holiday_Promotion",
    "Competitor Pricing": "Competitor_Pricing",
}

INVENTORY_SCHEMA = T.StructType([
    T.StructField(INVENTORY_RENAMES.get(f.name, f.name), f.dataType)
    for f in INVENTORY_CSV_SCHEMA.fields
])

# Cells that mean "no value" in the CSV inputs (fixed values: the texts that
# the reference's reader takes as missing).
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

KEY = ["Month", "Region", "Category"]
SEGMENT = ["Region", "Category"]

# --------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# --------------------------------------------------------------------------
# Category spelled differently in the inventory file, mapped onto the sales name.
DEFAULT_CATEGORY_MAP = {"Groceries": "Food"}
# Model feature columns, in this order (importance rows follow it).
FEATURE_COLS = [
    "Region_enc", "Category_enc",
    "Year", "MonthNum", "Quarter",
    "Avg_Unit_Cost",
    "Avg_Discount_Sales",
    "Num_Transactions",
    "New_Customers", "Returning_Customers",
    "Online_Txn", "Retail_Txn",
    "Inventory_Level", "Units_Ordered", "Demand_Forecast",
    "Avg_Discount_Inv", "Holiday_Days", "Competitor_Pricing",
    "Seasonality_enc", "Weather_Mode_enc",
    "Price_vs_Competitor",
    "Fulfillment_Rate",
    "Recommended_Order_Qty",
]
TARGET_COLS = ["Total_Sales_Amount", "Net_Profit_Margin", "Total_Qty_Sold"]
ENCODED_COLS = ["Region", "Category", "Weather_Mode", "Seasonality"]
# Columns written to the predictions output, in this order.
PREDICTION_COLS = [
    "Month", "Region", "Category",
    "Total_Sales_Amount", "Total_Qty_Sold",
    "Avg_Unit_Cost", "Avg_Unit_Price",
    "Gross_Profit", "Transport_Cost_Est", "Net_Profit",
    "Net_Profit_Margin", "Profit_Margin_Pct",
    "Spot_Sales_Ratio", "Online_Sales_Ratio",
    "Inventory_Level", "Inventory_Coverage",
    "Demand_Forecast", "Recommended_Price", "Recommended_Order_Qty",
    "Predicted_Sales", "Predicted_Margin_Pct",
    "Predicted_Sell_Qty", "Predicted_Net_Profit",
    "Predicted_Profit_Class",
    "Sales_Growth_MoM", "Profit_Growth_MoM",
    "Fulfillment_Rate",
]
# Class labels of the profit classifier.
HIGH_PROFIT = "High Profit"
LOW_PROFIT = "Low Profit"
# Improvement report messages, in rule order.
MSG_MARGIN_GAP = ("Margin is {gap}pp below top performers – "
                  "review pricing or reduce supplier costs.")
MSG_HIGH_DISCOUNT = ("High avg discount ({discount}%) – "
                     "consider loyalty rewards instead of blanket discounts.")
MSG_BELOW_COMPETITOR = ("Priced below competitors – possible room to raise prices "
                        "without volume loss.")
MSG_OVERSTOCK = ("Over-stocked (>60 days coverage) – reduce order quantities to "
                 "free up working capital.")
MSG_UNDERSTOCK = ("Under-stocked (<10 days coverage) – risk of stockouts; "
                  "increase re-order frequency.")
MSG_LOW_FULFILMENT = "Low demand fulfilment – consider stocking more to capture latent demand."
MSG_LOW_ONLINE = "Low online sales share – invest in e-commerce / marketplace presence."
MSG_ON_TRACK = "Performance is on-track."
RECOMMENDATION_SEPARATOR = " | "
# Short month names for the trend axis.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# Dashboard text: currency sign, lakh divisor, segment separator.
CURRENCY = "₹"
LAKH = 1e5
SEGMENT_SEPARATOR = " · "
# Model keys of the score table and their score-card metadata.
MODEL_KEYS = ["Sales_Amount", "Profit_Margin", "Sell_Quantity", "Profit_Classifier"]
MODEL_CARDS = [
    # key, title, algorithm, primary metric label, primary key, cv key, mae key, mae unit
    ("Sales_Amount", "Sales Amount Predictor", "Random Forest Regressor", "R²", "R2", "CV_R2", "MAE", "₹/month"),
    ("Profit_Margin", "Profit Margin Predictor", "Gradient Boosting Regressor", "R²", "R2", "CV_R2", "MAE", "% pts"),
    ("Sell_Quantity", "Sell Qty Predictor", "Random Forest Regressor", "R²", "R2", "CV_R2", "MAE", "units"),
    ("Profit_Classifier", "Profit Classifier", "Random Forest Classifier", "Accuracy", "Accuracy", None, None, ""),
]
# Importance comparison column labels.
IMPORTANCE_LABELS = {
    "Importance_Sales": "Sales",
    "Importance_Margin": "Margin",
    "Importance_Qty": "Quantity",
    "Importance_Cls": "Classifier",
}


@dataclass(frozen=True)
class BusinessRules:
    """Constants of the derived-feature formulas."""
    transport_rate: float = 0.02        # transport cost as a share of COGS
    target_gross_margin: float = 0.40   # recommended price targets this margin
    safety_stock: float = 1.15          # order quantity = forecast + 15 %
    days_per_month: float = 30.0        # daily sales rate divisor


@dataclass(frozen=True)
class Thresholds:
    """Improvement-report rule thresholds."""
    top_quantile: float = 0.75
    margin_gap_pp: float = 5.0
    discount_pct: float = 20.0
    below_competitor: float = -5.0
    overstock_days: float = 60.0
    understock_days: float = 10.0
    fulfilment_pct: float = 70.0
    online_pct: float = 20.0


@dataclass(frozen=True)
class Filters:
    """Dashboard filters: ``None`` means "all"."""
    year: int | None = None
    regions: tuple[str, ...] | None = None
    categories: tuple[str, ...] | None = None

    def without_year(self) -> Filters:
        """The same filters for a frame over all years, such as the report."""
        return Filters(None, self.regions, self.categories)


@dataclass(frozen=True)
class ModelParams:
    """Tree-model settings; defaults are the reference's."""
    seed: int = 42
    test_pct: int = 20
    folds: int = 5
    sales_trees: int = 200
    sales_depth: int = 12
    qty_trees: int = 200
    qty_depth: int = 10
    cls_trees: int = 200
    cls_depth: int = 10
    min_leaf: int = 2
    gbt_rounds: int = 200
    gbt_step: float = 0.05
    gbt_depth: int = 4
    gbt_subsample: float = 0.8
    max_bins: int = 32
    cv: bool = True
    partition_rows: int = 100_000      # rows of the training frame a partition
