"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each query is the CTE chain below plus a final SELECT. The CTEs restate the
raw-input mapping and the stage formulas independently of the Spark code.
"""

from __future__ import annotations

import re

from .functions.columns import davg_sql, dsum0_sql, dsum_sql, np_round_sql, py_format_sql, py_round_sql

RAW_CTES = """
geo AS (
  SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey),
orders_x AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS Sale_Date, o_orderpriority
  FROM orders),
first_order AS (
  SELECT o_custkey AS f_custkey, min(Sale_Date) AS first_date FROM orders_x GROUP BY o_custkey),
sales AS (
  SELECT o.Sale_Date, g.r_name AS Region, p.p_type AS Product_Category,
         l.l_extendedprice * (1 - l.l_discount) AS Sales_Amount,
         CAST(l.l_quantity AS BIGINT) AS Quantity_Sold,
         p.p_retailprice * l.l_quantity AS Unit_Cost,
         l.l_extendedprice AS Unit_Price,
         l.l_discount * 4 AS Discount,
         CAST(l.l_partkey AS VARCHAR) AS Product_ID,
         CASE WHEN o.Sale_Date = f.first_date THEN 'New' ELSE 'Returning' END AS Customer_Type,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Online' ELSE 'Retail' END
           AS Sales_Channel
  FROM lineitem l
  JOIN orders_x o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.n_nationkey
  JOIN first_order f ON f.f_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey),
inventory AS (
  SELECT CAST(l.l_shipdate AS DATE) AS Date, g.r_name AS Region,
         CASE WHEN p.p_type = 'STANDARD' THEN 'Groceries' ELSE p.p_type END AS Category,
         CAST(p.p_size AS DOUBLE) * CAST(30.0 AS DOUBLE) AS Inventory_Level,
         CAST(CASE WHEN l.l_linestatus = 'F' THEN l.l_quantity ELSE 0.0 END AS BIGINT) AS Units_Sold,
         CAST(l.l_quantity AS BIGINT) AS Units_Ordered,
         l.l_quantity * 30 AS Demand_Forecast,
         p.p_retailprice * 55 AS Price,
         l.l_discount * 4 AS Discount,
         l.l_returnflag AS Weather_Condition,
         CASE WHEN day(CAST(l.l_shipdate AS DATE)) <= 7 THEN 1 ELSE 0 END AS Holiday_Promotion,
         p.p_retailprice * 55 AS Competitor_Pricing,
         CASE WHEN month(l.l_shipdate) IN (12, 1, 2) THEN 'Winter'
              WHEN month(l.l_shipdate) IN (3, 4, 5) THEN 'Spring'
              WHEN month(l.l_shipdate) IN (6, 7, 8) THEN 'Summer'
              ELSE 'Autumn' END AS Seasonality
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN geo g ON s.s_nationkey = g.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

ROLLUP_CTES = """
inv_m AS (
  SELECT *, CAST(date_trunc('month', Date) AS DATE) AS Month
  FROM (SELECT * REPLACE (CASE WHEN Category = 'Groceries' THEN 'STANDARD' ELSE Category END
                          AS Category) FROM inventory)
  WHERE Region IS NOT NULL AND Category IS NOT NULL AND Date IS NOT NULL),
weather_mode AS (
  SELECT Month, Region, Category, v AS Weather_Mode FROM (
    SELECT Month, Region, Category, Weather_Condition AS v,
           row_number() OVER (PARTITION BY Month, Region, Category
                              ORDER BY count(*) DESC, Weather_Condition) AS rn
    FROM inv_m WHERE Weather_Condition IS NOT NULL
    GROUP BY Month, Region, Category, Weather_Condition) WHERE rn = 1),
season_mode AS (
  SELECT Month, Region, Category, v AS Seasonality FROM (
    SELECT Month, Region, Category, Seasonality AS v,
           row_number() OVER (PARTITION BY Month, Region, Category
                              ORDER BY count(*) DESC, Seasonality) AS rn
    FROM inv_m WHERE Seasonality IS NOT NULL
    GROUP BY Month, Region, Category, Seasonality) WHERE rn = 1),
inv_agg AS (
  SELECT a.Month, a.Region, a.Category, a.Inventory_Level, a.Units_Sold_Online, a.Units_Ordered,
         a.Demand_Forecast, a.Avg_Price, a.Avg_Discount_Inv, w.Weather_Mode, a.Holiday_Days,
         a.Competitor_Pricing, s.Seasonality
  FROM (
    SELECT Month, Region, Category,
           @davg(Inventory_Level) AS Inventory_Level,
           CAST(coalesce(sum(Units_Sold), 0) AS BIGINT) AS Units_Sold_Online,
           CAST(coalesce(sum(Units_Ordered), 0) AS BIGINT) AS Units_Ordered,
           @davg(Demand_Forecast) AS Demand_Forecast,
           @davg(Price) AS Avg_Price,
           @davg(Discount) AS Avg_Discount_Inv,
           CAST(coalesce(sum(Holiday_Promotion), 0) AS BIGINT) AS Holiday_Days,
           @davg(Competitor_Pricing) AS Competitor_Pricing
    FROM inv_m GROUP BY Month, Region, Category) a
  LEFT JOIN weather_mode w USING (Month, Region, Category)
  LEFT JOIN season_mode s USING (Month, Region, Category)),
sales_agg AS (
  SELECT CAST(date_trunc('month', Sale_Date) AS DATE) AS Month, Region,
         Product_Category AS Category,
         @dsum0(Sales_Amount) AS Total_Sales_Amount,
         CAST(coalesce(sum(Quantity_Sold), 0) AS BIGINT) AS Total_Qty_Sold,
         @davg(Unit_Cost) AS Avg_Unit_Cost,
         @davg(Unit_Price) AS Avg_Unit_Price,
         @davg(Discount) AS Avg_Discount_Sales,
         count(Product_ID) AS Num_Transactions,
         count(*) FILTER (WHERE Customer_Type = 'New') AS New_Customers,
         count(*) FILTER (WHERE Customer_Type = 'Returning') AS Returning_Customers,
         count(*) FILTER (WHERE Sales_Channel = 'Online') AS Online_Txn,
         count(*) FILTER (WHERE Sales_Channel = 'Retail') AS Retail_Txn
  FROM sales
  WHERE Sale_Date IS NOT NULL AND Region IS NOT NULL AND Product_Category IS NOT NULL
  GROUP BY ALL)"""

MASTER_CTES = """
joined AS (
  SELECT s.*, i.Inventory_Level, i.Units_Sold_Online, i.Units_Ordered, i.Demand_Forecast,
         i.Avg_Price, i.Avg_Discount_Inv, i.Weather_Mode, i.Holiday_Days,
         i.Competitor_Pricing, i.Seasonality
  FROM sales_agg s LEFT JOIN inv_agg i USING (Month, Region, Category)),
fin AS (
  SELECT *, Total_Sales_Amount - COGS AS Gross_Profit, COGS * CAST(0.02 AS DOUBLE) AS Transport_Cost_Est
  FROM (SELECT *, Avg_Unit_Cost * Num_Transactions AS COGS FROM joined)),
derived AS (
  SELECT *,
    Gross_Profit / nullif(Total_Sales_Amount, 0) * 100 AS Profit_Margin_Pct,
    Total_Sales_Amount / nullif(Num_Transactions, 0) AS Avg_Revenue_Per_Txn,
    Gross_Profit - Transport_Cost_Est AS Net_Profit,
    (Gross_Profit - Transport_Cost_Est) / nullif(Total_Sales_Amount, 0) * 100 AS Net_Profit_Margin,
    Retail_Txn / nullif(Num_Transactions, 0) AS Spot_Sales_Ratio,
    Online_Txn / nullif(Num_Transactions, 0) AS Online_Sales_Ratio,
    Avg_Unit_Price - coalesce(Competitor_Pricing, Avg_Unit_Price) AS Price_vs_Competitor,
    CASE WHEN Units_Sold_Online / nullif(Demand_Forecast, 0) IS NOT NULL
         THEN greatest(least(Units_Sold_Online / nullif(Demand_Forecast, 0), CAST(1.0 AS DOUBLE)), CAST(0.0 AS DOUBLE)) END
      AS Fulfillment_Rate,
    Inventory_Level / nullif(CAST(Total_Qty_Sold AS DOUBLE) / CAST(30.0 AS DOUBLE), 0) AS Inventory_Coverage,
    CAST(year(Month) AS BIGINT) AS Year,
    CAST(month(Month) AS BIGINT) AS MonthNum,
    CAST(quarter(Month) AS BIGINT) AS Quarter,
    Avg_Unit_Cost * CAST(1.6666666666666667 AS DOUBLE) AS Recommended_Price,
    round_even(coalesce(Demand_Forecast, Units_Ordered) * CAST(1.15 AS DOUBLE), 0) AS Recommended_Order_Qty
  FROM fin),
filled AS (
  SELECT *,
    last_value(Total_Sales_Amount IGNORE NULLS) OVER w AS s_ff,
    last_value(Net_Profit IGNORE NULLS) OVER w AS p_ff
  FROM derived
  WINDOW w AS (PARTITION BY Region, Category ORDER BY Month
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
master AS (
  SELECT * EXCLUDE (s_ff, p_ff),
    (s_ff / nullif(lag(s_ff) OVER w2, 0) - 1) * 100 AS Sales_Growth_MoM,
    (p_ff / nullif(lag(p_ff) OVER w2, 0) - 1) * 100 AS Profit_Growth_MoM
  FROM filled
  WINDOW w2 AS (PARTITION BY Region, Category ORDER BY Month))"""


def with_ctes(*blocks: str, select: str) -> str:
    body = ",".join(b.strip("\n") for b in blocks)
    return f"WITH {body.strip()}\n{select}"


def master_sql(select: str) -> str:
    return with_ctes(RAW_CTES, ROLLUP_CTES, MASTER_CTES, select=select)


__all__ = ["RAW_CTES", "ROLLUP_CTES", "MASTER_CTES", "with_ctes", "master_sql",
           "py_round_sql", "py_format_sql", "np_round_sql", "model_sql", "expand_aggregates"]


MODEL_CTES = """
enc AS (
  SELECT *,
    CAST(dense_rank() OVER (ORDER BY coalesce(Region, 'nan')) - 1 AS DOUBLE) AS Region_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(Category, 'nan')) - 1 AS DOUBLE) AS Category_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(Weather_Mode, 'nan')) - 1 AS DOUBLE)
      AS Weather_Mode_enc,
    CAST(dense_rank() OVER (ORDER BY coalesce(Seasonality, 'nan')) - 1 AS DOUBLE)
      AS Seasonality_enc
  FROM master),
mf AS (
  SELECT * FROM enc WHERE {not_null}),
mf_split AS (
  SELECT *, (CAST(('0x' || substr(md5(Region || '|' || Category || '|' || CAST(Month AS VARCHAR)),
                                  1, 8)) AS BIGINT) % 100) < 20 AS is_test
  FROM mf),
thr AS (
  SELECT median(Net_Profit_Margin) AS Profit_Threshold FROM mf_split WHERE NOT is_test)"""


def model_sql(select: str) -> str:
    from .schema import FEATURE_COLS, TARGET_COLS
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLS + TARGET_COLS)
    return with_ctes(RAW_CTES, ROLLUP_CTES, MASTER_CTES, MODEL_CTES.replace("{not_null}", not_null),
                     select=select)


DASH_CTES = """
lab AS (
  SELECT mf_split.*, thr.Profit_Threshold,
         CAST(Net_Profit_Margin >= Profit_Threshold AS DOUBLE) AS label_cls
  FROM mf_split, thr),
seg_means AS (
  SELECT Region, Category, @davg(Total_Sales_Amount) AS ps, @davg(Net_Profit_Margin) AS pm,
         avg(Total_Qty_Sold) AS pq, avg(label_cls) AS pc
  FROM lab WHERE NOT is_test GROUP BY Region, Category),
preds0 AS (
  SELECT lab.*, s.ps AS Predicted_Sales, s.pm AS Predicted_Margin_Pct,
         CAST(round_even(s.pq, 0) AS BIGINT) AS Predicted_Sell_Qty,
         CASE WHEN s.pc >= 0.5 THEN 'High Profit' ELSE 'Low Profit' END AS Predicted_Profit_Class,
         strftime(Month, '%b %Y') AS MonthLabel
  FROM lab LEFT JOIN seg_means s USING (Region, Category)),
preds AS (
  SELECT *, Predicted_Sales * (Predicted_Margin_Pct / 100)
            - Avg_Unit_Cost * Predicted_Sell_Qty * CAST(0.02 AS DOUBLE) AS Predicted_Net_Profit
  FROM preds0),
monthly AS (
  SELECT Year, MonthNum, Region, Category,
         @dsum0(Total_Sales_Amount) AS Monthly_Sales,
         @dsum0(Net_Profit) AS Monthly_Profit,
         @dsum0(Predicted_Sales) AS Pred_Sales,
         @dsum0(Predicted_Net_Profit) AS Pred_Profit
  FROM preds GROUP BY Year, MonthNum, Region, Category)"""


def dash_sql(select: str, improve_select: str | None = None, extra_ctes: str = "") -> str:
    """Model CTEs + baseline predictions (+ the improvement report as
    ``improve`` when given)."""
    from .schema import FEATURE_COLS, TARGET_COLS
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLS + TARGET_COLS)
    blocks = [RAW_CTES, ROLLUP_CTES, MASTER_CTES, MODEL_CTES.replace("{not_null}", not_null),
              DASH_CTES]
    if improve_select is not None:
        blocks.append(f"\nimprove AS ({improve_select})")
    if extra_ctes:
        blocks.append(extra_ctes)
    return with_ctes(*blocks, select=select)


_AGG_TOKEN = re.compile(r"@(dsum0|dsum|davg)\((\w+)\)")
_AGG_SQL = {"dsum0": dsum0_sql, "dsum": dsum_sql, "davg": davg_sql}


def expand_aggregates(sql: str) -> str:
    """``@dsum(c)`` / ``@dsum0(c)`` / ``@davg(c)`` → the exact-sum SQL that
    mirrors ``functions.columns.dsum`` / ``dsum0`` / ``davg``."""
    return _AGG_TOKEN.sub(lambda m: _AGG_SQL[m.group(1)](m.group(2)), sql)
