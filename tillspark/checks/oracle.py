"""The registered queries in SQL over the sample tables, for a second engine.

Money is summed in whole millionths, and quotients are rounded half up in
integers, so that no result depends on how an engine divides decimals.
"""

from __future__ import annotations

import re

from tillspark import fixed_values as V

AS_OF = "DATE '2001-07-31'"


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero; NULL for a zero denominator."""
    n, d = f"({numerator})", f"({denominator})"
    return (
        f"(CASE WHEN {d} = 0 THEN NULL ELSE sign({n}) * sign({d})"
        f" * ((2 * abs({n}) + abs({d})) // (2 * abs({d}))) END)"
    )


def money(micros: str) -> str:
    """Millionths as units with two places."""
    return f"CAST({half_up(micros, '10000')} AS DOUBLE) / 100"


def percent(part: str, whole: str) -> str:
    return f"CAST({half_up(f'{part} * 10000', whole)} AS DOUBLE) / 100"


def ratio(part: str, whole: str, places: int) -> str:
    """Quotient of integers with some places; 0 where the denominator is zero or NULL."""
    scale = 10**places
    return (
        f"CASE WHEN {whole} IS NULL OR {whole} = 0 THEN 0.0::DOUBLE"
        f" ELSE CAST({half_up(f'{part} * {scale}', whole)} AS DOUBLE) / {scale} END"
    )


def mean_money(micros: str, count: str) -> str:
    return f"CAST({half_up(micros, f'{count} * 10000')} AS DOUBLE) / 100"


def key(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def category(score: str) -> str:
    return f"CASE WHEN {score} >= 0.70 THEN 'High' WHEN {score} >= 0.40 THEN 'Medium' ELSE 'Low' END"


_ADDITIVE = "sum(gross_micro) AS gross, sum(net_micro) AS net, sum(profit_micro) AS profit"

# Relations the queries are built on; a query gets those it names, directly or through another one.
RELATIONS = {
    "calendar": f"""
        SELECT {key('d')} AS DateKey, d AS FullDate,
               CAST(dayofweek(d) + 1 AS INTEGER) AS DayOfWeek, strftime(d, '%A') AS DayName,
               CAST(weekofyear(d) AS INTEGER) AS WeekOfYear, CAST(month(d) AS INTEGER) AS MonthNumber,
               strftime(d, '%B') AS MonthName, CAST(quarter(d) AS INTEGER) AS Quarter,
               CAST(year(d) AS INTEGER) AS Year
        FROM (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
    """,
    "geo": """
        SELECT n_nationkey, n_name AS State, r_name AS Region
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    "stores": """
        SELECT s_suppkey AS StoreKey, CAST(s_suppkey AS VARCHAR) AS StoreID, s_name AS StoreName, Region, State,
               CASE s_suppkey % 3 WHEN 0 THEN 'Physical' WHEN 1 THEN 'Online' ELSE 'Outlet' END AS StoreType
        FROM supplier JOIN geo ON s_nationkey = n_nationkey
    """,
    "products": """
        SELECT p_partkey AS ProductKey, CAST(p_partkey AS VARCHAR) AS ProductID, p_name AS ProductName,
               p_type AS Category, p_name AS SubCategory, p_brand AS Brand,
               CAST(p_retailprice AS DECIMAL(10,2)) AS UnitPrice,
               CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * 0.60, 2) AS DECIMAL(10,2)) AS UnitCost
        FROM part
    """,
    "customers": """
        SELECT c_custkey AS CustomerKey, CAST(c_custkey AS VARCHAR) AS CustomerID,
               split_part(c_name, '#', 1) AS FirstName, split_part(c_name, '#', 2) AS LastName,
               'c' || c_custkey || '@mail.example' AS Email,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'Premium'
                    WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'Regular' ELSE 'At-Risk' END AS Segment,
               Region, State, DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS JoinDate,
               c_acctbal >= 0 AS IsActive,
               CAST(CAST(c_custkey * 37 % 10000 AS DECIMAL(10,0)) * 0.0001 AS DECIMAL(5,4)) AS Score
        FROM customer JOIN geo ON c_nationkey = n_nationkey
    """,
    "lines": f"""
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, l_returnflag,
               CAST(l_quantity AS INTEGER) AS Quantity, CAST(o_orderdate AS DATE) AS OrderDate,
               CAST(CAST(round(l_discount * 100) AS INTEGER) AS DECIMAL(5,2)) AS Discount,
               UnitPrice, UnitCost
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN products ON l_partkey = ProductKey
        WHERE CAST(o_orderdate AS DATE) <= {AS_OF}
    """,
    "priced": """
        SELECT *, CAST(Quantity * UnitPrice * 1000000 AS BIGINT) AS gross_micro,
               CAST(CAST(Quantity * UnitPrice * (1 - Discount * 0.01) AS DECIMAL(18,6)) * 1000000 AS BIGINT) AS net_micro,
               CAST(Quantity * UnitCost * 1000000 AS BIGINT) AS cost_micro
        FROM lines
    """,
    "fact": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS OrderID, l_linenumber AS OrderLineID, OrderDate,
               {key('OrderDate')} AS DateKey, o_custkey AS CustomerKey, l_partkey AS ProductKey,
               l_suppkey AS StoreKey, Quantity, gross_micro, net_micro, net_micro - cost_micro AS profit_micro,
               l_returnflag = 'R' AS ReturnFlag
        FROM priced
    """,
    "kept": "SELECT * FROM fact WHERE NOT ReturnFlag",
    "month_sales": f"""
        SELECT * FROM kept
        WHERE year(OrderDate) = year({AS_OF}) AND month(OrderDate) = month({AS_OF})
    """,
    "summary": f"""
        SELECT Year, Quarter, MonthNumber, MonthName, FullDate, stores.Region, stores.State, StoreType, Category,
               SubCategory, Brand, Segment AS CustomerSegment, {_ADDITIVE}, CAST(sum(Quantity) AS BIGINT) AS units,
               count(DISTINCT OrderID) AS orders_n, count(DISTINCT f.CustomerKey) AS customers_n
        FROM kept f JOIN calendar USING (DateKey) JOIN stores USING (StoreKey) JOIN products USING (ProductKey)
        JOIN customers c ON f.CustomerKey = c.CustomerKey
        GROUP BY ALL
    """,
    "recent_tickets": f"""
        SELECT CAST(user_id AS VARCHAR) AS CustomerID, count(*) AS n
        FROM events
        WHERE event_type = 'error'
          AND {AS_OF} - CAST(event_id % 365 AS INTEGER) >= {AS_OF} - INTERVAL 6 MONTH
        GROUP BY 1
    """,
    "activity": f"""
        SELECT c.CustomerKey, count(DISTINCT OrderID) AS TotalOrders, sum(net_micro) AS spend, count(net_micro) AS n,
               datediff('day', max(OrderDate), {AS_OF}) AS DaysSinceLastPurchase,
               count(DISTINCT Category) AS UniqueCategories, coalesce(t.n, 0) AS SupportTickets
        FROM customers c LEFT JOIN fact f ON c.CustomerKey = f.CustomerKey
        LEFT JOIN products p ON f.ProductKey = p.ProductKey
        LEFT JOIN recent_tickets t ON c.CustomerID = t.CustomerID
        WHERE c.IsActive
        GROUP BY c.CustomerKey, t.n
    """,
    "activity_cents": f"""
        SELECT *, {half_up('spend', '10000')} AS spend_cents, {half_up('spend', 'n * 10000')} AS avg_cents
        FROM activity
    """,
    # Revenue at risk in ten-thousandths: cents x 12 x 0.85 (or 0.45).
    "board": f"""
        SELECT CustomerID, FirstName || ' ' || LastName AS CustomerName, Segment, Region, State, Score,
               {category('Score')} AS Risk, TotalOrders, spend_cents, avg_cents, DaysSinceLastPurchase,
               UniqueCategories, SupportTickets,
               CASE {category('Score')} WHEN 'High' THEN avg_cents * 12 * 85 WHEN 'Medium' THEN avg_cents * 12 * 45
                    ELSE 0 END AS risk_e4
        FROM customers LEFT JOIN activity_cents USING (CustomerKey)
        WHERE IsActive
    """,
    "stock": """
        SELECT DISTINCT l_partkey AS ProductKey, l_suppkey AS StoreKey,
               CAST((l_partkey * 7 + l_suppkey * 13) % 200 AS INTEGER) AS QuantityOnHand,
               CAST(l_partkey % 50 + 1 AS INTEGER) AS ReorderPoint
        FROM lineitem
    """,
    "snapshot_days": f"SELECT {AS_OF} AS d UNION ALL SELECT {AS_OF} - 7",
    "daily_rates": """
        SELECT d, ProductKey, StoreKey, CAST(sum(Quantity) AS DOUBLE) / 30.0 AS AvgDailySales
        FROM fact JOIN snapshot_days ON OrderDate >= d - 30
        GROUP BY ALL
    """,
    "snapshots": f"""
        SELECT s.d, {key('s.d')} AS DateKey, k.ProductKey, k.StoreKey, QuantityOnHand, ReorderPoint,
               CASE WHEN coalesce(AvgDailySales, 0) = 0 THEN 999
                    ELSE CAST(trunc(QuantityOnHand / AvgDailySales) AS INTEGER) END AS DaysOfSupply,
               CASE WHEN QuantityOnHand = 0 THEN 'High' WHEN QuantityOnHand <= ReorderPoint THEN 'Medium'
                    ELSE 'Low' END AS StockOutRisk,
               QuantityOnHand > 3 * ReorderPoint AS OverstockFlag
        FROM stock k CROSS JOIN snapshot_days s
        LEFT JOIN daily_rates r ON r.d = s.d AND r.ProductKey = k.ProductKey AND r.StoreKey = k.StoreKey
    """,
    "intelligence": """
        SELECT ProductID, ProductName, Category, SubCategory, Brand, StoreName, StoreType, Region, State,
               QuantityOnHand, ReorderPoint, DaysOfSupply, StockOutRisk, OverstockFlag,
               UnitCost * QuantityOnHand AS value,
               CASE WHEN OverstockFlag THEN UnitCost * (QuantityOnHand - 2 * ReorderPoint) ELSE 0 END AS excess,
               d AS SnapshotDate
        FROM snapshots JOIN products USING (ProductKey) JOIN stores USING (StoreKey)
        WHERE d = (SELECT max(d) FROM snapshot_days)
    """,
    "raw": """
        SELECT CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS OrderID,
               l_linenumber AS OrderLineID,
               CASE WHEN l_orderkey % 79 = 0 THEN 'unknown' ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
               CASE WHEN l_orderkey % 73 = 0 THEN 'unknown' ELSE CAST(l_partkey AS VARCHAR) END AS ProductID,
               CASE WHEN l_orderkey % 71 = 0 THEN 'unknown' ELSE CAST(l_suppkey AS VARCHAR) END AS StoreID,
               OrderDate,
               CASE WHEN l_orderkey % 89 = 0 THEN 0 WHEN l_orderkey % 83 <> 0 THEN Quantity END AS Quantity,
               CASE WHEN l_orderkey % 101 = 0 THEN -UnitPrice ELSE UnitPrice END AS UnitPrice,
               nullif(Discount, 0) AS Discount,
               CASE WHEN l_returnflag <> 'N' THEN l_returnflag = 'R' END AS ReturnFlag
        FROM lines
    """,
    "history_keys": "SELECT DISTINCT OrderID, OrderLineID FROM fact WHERE OrderDate < DATE '1998-01-01'",
    "loadable": f"""
        SELECT r.OrderID, r.OrderLineID, {key('r.OrderDate')} AS DateKey, CustomerKey, ProductKey, StoreKey,
               r.Quantity, r.UnitPrice, coalesce(r.Discount, 0) AS Discount, UnitCost,
               coalesce(r.ReturnFlag, false) AS ReturnFlag
        FROM raw r JOIN customers c ON r.CustomerID = c.CustomerID JOIN products p ON r.ProductID = p.ProductID
        JOIN stores s ON r.StoreID = s.StoreID
        WHERE r.OrderID IS NOT NULL AND r.Quantity > 0 AND r.UnitPrice >= 0
    """,
    "outcomes": """
        SELECT CASE WHEN r.OrderID IS NULL OR r.Quantity <= 0 OR r.UnitPrice < 0 THEN 'rejected'
                    WHEN r.Quantity IS NULL OR r.UnitPrice IS NULL THEN 'missing quantity or price'
                    WHEN c.CustomerID IS NULL THEN 'unknown customer'
                    WHEN p.ProductID IS NULL THEN 'unknown product'
                    WHEN s.StoreID IS NULL THEN 'unknown store'
                    WHEN h.OrderID IS NOT NULL THEN 'already loaded' ELSE 'loaded' END AS Outcome
        FROM raw r LEFT JOIN customers c ON r.CustomerID = c.CustomerID
        LEFT JOIN products p ON r.ProductID = p.ProductID LEFT JOIN stores s ON r.StoreID = s.StoreID
        LEFT JOIN history_keys h ON r.OrderID = h.OrderID AND r.OrderLineID = h.OrderLineID
    """,
    "narratives": f"""
        SELECT {AS_OF} - CAST(conv_id % 30 AS INTEGER) AS InsightDate,
               CASE conv_id % 4 WHEN 0 THEN 'Revenue' WHEN 1 THEN 'Churn' WHEN 2 THEN 'Inventory'
                    ELSE 'Overall' END AS InsightArea, text AS InsightText
        FROM conversations WHERE role = 'assistant'
    """,
    "features": f"""
        SELECT CustomerID, TotalOrders::DOUBLE AS TotalOrders, coalesce(spend_cents / 100.0::DOUBLE, 0) AS spend,
               coalesce(avg_cents / 100.0::DOUBLE, 0) AS avg_value,
               coalesce(DaysSinceLastPurchase, 0)::DOUBLE AS days, UniqueCategories::DOUBLE AS UniqueCategories,
               SupportTickets::DOUBLE AS SupportTickets,
               datediff('month', JoinDate, {AS_OF})::DOUBLE AS TenureMonths,
               CASE Segment WHEN 'Premium' THEN 3 WHEN 'Regular' THEN 2 ELSE 1 END::DOUBLE AS SegmentScore,
               CASE WHEN DaysSinceLastPurchase >= 90 THEN 1 ELSE 0 END AS ChurnLabel
        FROM customers JOIN activity_cents USING (CustomerKey)
        WHERE IsActive
    """,
    "kpis": f"""
        SELECT 'Current Month' AS Period, sum(net_micro) AS net, sum(profit_micro) AS profit,
               count(DISTINCT OrderID) AS TotalOrders, count(DISTINCT CustomerKey) AS ActiveCustomers,
               (SELECT count(*) FROM customers WHERE IsActive AND {category('Score')} = 'High') AS HighChurnCustomers,
               (SELECT sum(risk_e4) FROM board WHERE Risk = 'High') AS at_risk,
               (SELECT count(*) FROM intelligence WHERE StockOutRisk = 'High') AS HighStockOutSKUs
        FROM month_sales
    """,
    "product_groups": """
        SELECT Category, SubCategory, sum(net_micro) AS net, sum(profit_micro) AS profit,
               CAST(sum(Quantity) AS BIGINT) AS units
        FROM month_sales JOIN products USING (ProductKey)
        GROUP BY ALL ORDER BY net DESC, Category, SubCategory LIMIT 5
    """,
    "alerts": """
        SELECT ProductID, ProductName, Category, StoreName, StoreType, QuantityOnHand, DaysOfSupply, StockOutRisk
        FROM intelligence WHERE StockOutRisk IN ('High', 'Medium')
        ORDER BY DaysOfSupply, ProductID, StoreName LIMIT 5
    """,
    "risk_regions": """
        SELECT Region, count(*) AS n, sum(risk_e4) AS risk_e4 FROM board WHERE Risk = 'High' GROUP BY Region
    """,
    "daily_net": """
        SELECT OrderDate AS FullDate, StoreKey, sum(net_micro) AS net FROM kept GROUP BY ALL
    """,
    "targets": """
        SELECT month(o_orderdate) AS Month, year(o_orderdate) + 1 AS Year,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) * 110 AS target_e4
        FROM orders GROUP BY ALL
    """,
    "churn_scores": """
        SELECT CAST(c_custkey * 37 % 10000 AS DOUBLE) / 10000 AS p, c_custkey * 37 % 10000 AS e4 FROM customer
    """,
}


def _facts_sql(extra: str = "") -> str:
    return f"""
        SELECT OrderID, OrderLineID, DateKey, CustomerKey, ProductKey, StoreKey, Quantity,
               CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(Discount AS DOUBLE) AS Discount,
               CAST(Quantity * UnitPrice AS DOUBLE) AS GrossSales,
               CAST(CAST(Quantity * UnitPrice * (1 - Discount * 0.01) AS DECIMAL(18,6)) AS DOUBLE) AS NetSales,
               CAST(Quantity * UnitCost AS DOUBLE) AS COGS,
               CAST(CAST(Quantity * UnitPrice * (1 - Discount * 0.01) - Quantity * UnitCost AS DECIMAL(18,6)) AS DOUBLE)
                   AS GrossProfit,
               ReturnFlag
        FROM loadable l {extra}
    """


_SALES_MEASURES = f"""
       {money('sum(net)')} AS TotalNetSales, {money('sum(profit)')} AS TotalGrossProfit,
       {ratio('sum(profit)', 'sum(net)', 6)} AS GrossMarginShare,
       CAST({half_up('sum(net)', 'count(DISTINCT orders_n) * 10000')} AS DOUBLE) / 100 AS AvgOrderValue
"""

_RISK = "CAST(" + half_up("sum(risk_e4)", "100") + " AS DOUBLE) / 100"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _wording() -> str:
    opening = V.PROMPT_OPENING + "July 31, 2001" + V.PROMPT_RULES + "{}\n\n"
    rows = ", ".join(f"({_text(a)}, {_text(opening + V.PROMPT_TASKS[a])})" for a in V.INSIGHT_AREAS)
    return f"(VALUES {rows}) w(InsightArea, Wording)"


def _visible(principal: str, where: str) -> str:
    return f"""
        SELECT Region, State, {money('sum(net)')} AS NetSales, '{principal}' AS Principal
        FROM daily_net JOIN stores USING (StoreKey) WHERE {where} GROUP BY Region, State
    """


_MANAGED = "Region IN (SELECT Region FROM geo WHERE lower(State) || '@stores.example' = 'nation_3@stores.example')"

QUERIES = {
    "sales_summary": f"""
        SELECT Year, Quarter, MonthNumber, MonthName, FullDate, Region, State, StoreType, Category, SubCategory,
               Brand, CustomerSegment, {money('gross')} AS GrossSales, {money('net')} AS NetSales,
               {money('profit')} AS GrossProfit, units AS UnitsSold, orders_n AS OrderCount,
               customers_n AS UniqueCustomers, {percent('profit', 'net')} AS GrossMarginPct
        FROM summary
    """,
    "kpi_summary": f"""
        SELECT Period, {money('net')} AS TotalRevenue, {money('profit')} AS TotalGrossProfit,
               {percent('profit', 'net')} AS GrossMarginPct, TotalOrders, ActiveCustomers,
               {mean_money('net', 'ActiveCustomers')} AS AvgRevenuePerCustomer, HighChurnCustomers,
               CAST({half_up('at_risk', '100')} AS DOUBLE) / 100 AS TotalRevenueAtRisk, HighStockOutSKUs
        FROM kpis
    """,
    "top_product_groups": f"""
        SELECT Category, SubCategory, {money('net')} AS NetSales, {money('profit')} AS GrossProfit,
               units AS UnitsSold FROM product_groups
    """,
    "sales_measures": f"SELECT Region, CustomerSegment, {_SALES_MEASURES} FROM summary GROUP BY Region, CustomerSegment",
    "sales_totals": f"SELECT {_SALES_MEASURES} FROM summary",
    "sales_report": f"""
        SELECT Region, CustomerSegment, StoreType, CAST(grouping(Region, CustomerSegment, StoreType) AS BIGINT) AS Context, {_SALES_MEASURES}
        FROM summary GROUP BY GROUPING SETS ((Region, CustomerSegment), (Region), (), (StoreType))
    """,
    "avg_order_value": f"""
        SELECT DateKey // 100 AS SaleMonth, count(DISTINCT OrderID) AS Orders,
               {mean_money('sum(net_micro)', 'count(DISTINCT OrderID)')} AS AvgOrderValueTrue
        FROM kept GROUP BY 1
    """,
    "sales_yoy": f"""
        , m AS (SELECT Region, CAST(year(FullDate) AS INTEGER) AS Year, CAST(month(FullDate) AS INTEGER) AS MonthNumber,
                       sum(net) AS net
                FROM daily_net JOIN stores USING (StoreKey) GROUP BY ALL)
        SELECT c.Region, c.Year, c.MonthNumber, {money('c.net')} AS NetSales, {money('p.net')} AS PriorNetSales,
               {ratio('(c.net - p.net)', 'p.net', 6)} AS YoYChange
        FROM m c LEFT JOIN m p ON c.Region = p.Region AND c.MonthNumber = p.MonthNumber AND c.Year = p.Year + 1
    """,
    "sales_ytd": f"""
        , d AS (SELECT FullDate, sum(net) AS net FROM daily_net GROUP BY FullDate)
        SELECT c.FullDate, CAST(year(c.FullDate) AS INTEGER) AS Year, {money('any_value(c.net)')} AS NetSales,
               {money('sum(p.net)')} AS YTDNetSales
        FROM d c JOIN d p ON p.FullDate <= c.FullDate AND year(p.FullDate) = year(c.FullDate)
        GROUP BY c.FullDate
    """,
    "target_attainment": f"""
        , n AS (SELECT sum(net_micro) AS net FROM month_sales),
          t AS (SELECT sum({half_up('target_e4', '100')}) AS cents FROM targets
                WHERE Month = month({AS_OF}) AND Year = year({AS_OF}))
        SELECT {money('net')} AS TotalNetSales, CAST(cents AS DOUBLE) / 100 AS RevenueTarget,
               {ratio('net', '(cents * 10000)', 6)} AS TargetAttainment
        FROM n, t
    """,
    "region_security": f"""
        {_visible('nation_3@stores.example', _MANAGED)}
        UNION ALL {_visible('chief@stores.example', 'true')}
    """,
    "restricted_reports": f"""
        SELECT 'vw_SalesSummary' AS Report, Region, count(*) AS ReportRows, {money('sum(net)')} AS Amount FROM summary WHERE {_MANAGED} GROUP BY Region
        UNION ALL
        SELECT 'vw_ChurnRiskDashboard', Region, count(*), CAST({half_up('sum(risk_e4)', '100')} AS DOUBLE) / 100 FROM board WHERE {_MANAGED} GROUP BY Region
        UNION ALL
        SELECT 'vw_InventoryIntelligence', Region, count(*), round(CAST(sum(value) AS DOUBLE), 2) FROM intelligence WHERE {_MANAGED} GROUP BY Region
        UNION ALL
        SELECT 'vw_KPISummary', NULL, count(DISTINCT OrderID), {money('sum(net_micro)')} FROM month_sales JOIN stores USING (StoreKey) WHERE {_MANAGED}
    """,
    "fact_sales_load": _facts_sql(
        "WHERE NOT EXISTS (SELECT 1 FROM history_keys h WHERE h.OrderID = l.OrderID AND h.OrderLineID = l.OrderLineID)"
    ),
    "incremental_sales_load": _facts_sql(),
    "sales_rejects": f"""
        SELECT OrderID, 'NULL OrderID or invalid Qty/Price' AS RejectReason, {AS_OF} AS RejectDate
        FROM raw WHERE OrderID IS NULL OR Quantity <= 0 OR UnitPrice < 0
    """,
    "sales_outcomes": "SELECT Outcome, count(*) AS SalesLines FROM outcomes GROUP BY Outcome",
    "sales_silent_drops": """
        SELECT Outcome, count(*) AS SalesLines FROM outcomes
        WHERE Outcome NOT IN ('loaded', 'rejected', 'already loaded') GROUP BY Outcome
    """,
    "processed_marks": f"SELECT true AS ProcessedFlag, {AS_OF} AS ProcessedDate, count(*) AS SalesLines FROM raw",
    "orphan_check": f"""
        , uses AS (SELECT 'FactSales' AS FactTable, CustomerKey, ProductKey, StoreKey, DateKey FROM fact
                   UNION ALL SELECT 'FactInventory', NULL, ProductKey, StoreKey, DateKey FROM snapshots
                   UNION ALL SELECT 'FactCustomerActivity', CustomerKey, NULL, NULL, {key(AS_OF)} FROM activity),
          k AS (SELECT FactTable, 'CustomerKey' AS ForeignKey, 'DimCustomer' AS Dimension, CustomerKey AS k,
                       CustomerKey IN (SELECT CustomerKey FROM customers WHERE IsActive) AS known FROM uses
                UNION ALL SELECT FactTable, 'ProductKey', 'DimProduct', ProductKey,
                       ProductKey IN (SELECT ProductKey FROM products) FROM uses
                UNION ALL SELECT FactTable, 'StoreKey', 'DimStore', StoreKey,
                       StoreKey IN (SELECT StoreKey FROM stores WHERE StoreType <> 'Outlet') FROM uses
                UNION ALL SELECT FactTable, 'DateKey', 'DimDate', DateKey, DateKey BETWEEN 19960101 AND 20001231 FROM uses)
        SELECT FactTable, ForeignKey, Dimension, count(DISTINCT k) FILTER (NOT known) AS OrphanKeys,
               count(*) FILTER (NOT known) AS OrphanRows
        FROM k WHERE k IS NOT NULL GROUP BY ALL
    """,
    "product_margins": """
        SELECT ProductID, CAST(CASE WHEN UnitPrice > 0 THEN round((UnitPrice - UnitCost) * 100 / UnitPrice, 2) ELSE 0 END
                               AS DOUBLE) AS GrossMarginPct
        FROM products
    """,
    "duplicate_keys": """
        SELECT 'DimCustomer' AS TableName, CustomerID AS KeyValue, count(*) AS Copies
        FROM customers GROUP BY CustomerID HAVING count(*) > 1
        UNION ALL SELECT 'DimProduct', ProductID, count(*) FROM products GROUP BY ProductID HAVING count(*) > 1
        UNION ALL SELECT 'DimStore', StoreID, count(*) FROM stores GROUP BY StoreID HAVING count(*) > 1
        UNION ALL SELECT 'FactSales', OrderID || '|' || OrderLineID, count(*)
        FROM fact GROUP BY OrderID, OrderLineID HAVING count(*) > 1
    """,
    "null_check": """
        SELECT 'DimCustomer' AS TableName, 'CustomerID' AS ColumnName, count(*) FILTER (CustomerID IS NULL) AS Missing
        FROM customers
        UNION ALL SELECT 'DimProduct', 'ProductID', count(*) FILTER (ProductID IS NULL) FROM products
        UNION ALL SELECT 'DimStore', 'StoreID', count(*) FILTER (StoreID IS NULL) FROM stores
        UNION ALL SELECT 'FactSales', 'OrderID', count(*) FILTER (OrderID IS NULL) FROM fact
        UNION ALL SELECT 'FactSales', 'OrderLineID', count(*) FILTER (OrderLineID IS NULL) FROM fact
        UNION ALL SELECT 'FactSales', 'DateKey', count(*) FILTER (DateKey IS NULL) FROM fact
        UNION ALL SELECT 'FactSales', 'CustomerKey', count(*) FILTER (CustomerKey IS NULL) FROM fact
        UNION ALL SELECT 'FactSales', 'ProductKey', count(*) FILTER (ProductKey IS NULL) FROM fact
        UNION ALL SELECT 'FactSales', 'StoreKey', count(*) FILTER (StoreKey IS NULL) FROM fact
        UNION ALL SELECT 'DimDate', 'FullDate', count(*) FILTER (FullDate IS NULL) FROM calendar
        UNION ALL SELECT 'FactInventory', 'DateKey', count(*) FILTER (DateKey IS NULL) FROM snapshots
        UNION ALL SELECT 'FactInventory', 'ProductKey', count(*) FILTER (ProductKey IS NULL) FROM snapshots
        UNION ALL SELECT 'FactInventory', 'StoreKey', count(*) FILTER (StoreKey IS NULL) FROM snapshots
        UNION ALL SELECT 'FactCustomerActivity', 'CustomerKey', count(*) FILTER (CustomerKey IS NULL) FROM activity
        UNION ALL SELECT 'FactCustomerActivity', 'DateKey', 0
        UNION ALL SELECT 'AIInsights', 'InsightDate', count(*) FILTER (InsightDate IS NULL) FROM narratives
        UNION ALL SELECT 'SalesRaw', 'OrderID', count(*) FILTER (OrderID IS NULL) FROM raw
        UNION ALL SELECT 'SalesRaw', 'Quantity', count(*) FILTER (Quantity IS NULL) FROM raw
        UNION ALL SELECT 'SalesRaw', 'UnitPrice', count(*) FILTER (UnitPrice IS NULL) FROM raw
        UNION ALL SELECT 'SalesRaw', 'Discount', count(*) FILTER (Discount IS NULL) FROM raw
        UNION ALL SELECT 'SalesRaw', 'ReturnFlag', count(*) FILTER (ReturnFlag IS NULL) FROM raw
    """,
    "calendar_dim": """
        SELECT *, DayOfWeek IN (1, 7) AS IsWeekend, month(FullDate) = 1 AND day(FullDate) = 1 AS IsHoliday,
               Year AS FiscalYear, Quarter AS FiscalQuarter
        FROM calendar
        WHERE Year BETWEEN (SELECT year(min(o_orderdate)) FROM orders) AND (SELECT year(max(o_orderdate)) FROM orders)
    """,
    "customer_activity": f"""
        SELECT CustomerKey, {key(AS_OF)} AS DateKey, TotalOrders, CAST(spend_cents AS DOUBLE) / 100 AS TotalSpend,
               CAST(avg_cents AS DOUBLE) / 100 AS AvgOrderValue,
               CAST(DaysSinceLastPurchase AS INTEGER) AS DaysSinceLastPurchase, UniqueCategories, SupportTickets
        FROM activity_cents
    """,
    "churn_dashboard": f"""
        SELECT CustomerID, CustomerName, Segment, Region, State, CAST(Score AS DOUBLE) AS ChurnRiskScore,
               Risk AS ChurnRiskCategory, {AS_OF} AS LastScoredDate, TotalOrders,
               CAST(spend_cents AS DOUBLE) / 100 AS TotalSpend, CAST(avg_cents AS DOUBLE) / 100 AS AvgOrderValue,
               CAST(DaysSinceLastPurchase AS INTEGER) AS DaysSinceLastPurchase, UniqueCategories, SupportTickets,
               CAST(avg_cents * 12 AS DOUBLE) / 100 AS EstimatedAnnualValue,
               CAST(risk_e4 AS DOUBLE) / 10000 AS RevenueAtRisk
        FROM board
    """,
    "churn_by_region": f"""
        SELECT Region, n AS HighChurnCustomers, CAST({half_up('risk_e4', '100')} AS DOUBLE) / 100 AS TotalAtRisk
        FROM risk_regions
    """,
    "apply_churn_scores": f"""
        , s AS (SELECT CustomerID, CASE WHEN CustomerKey IN (SELECT o_custkey FROM orders) THEN Score END AS Score
                FROM customers)
        SELECT CustomerID, CAST(Score AS DOUBLE) AS ChurnRiskScore,
               CASE WHEN Score IS NOT NULL THEN {category('Score')} END AS ChurnRiskCategory,
               CASE WHEN Score >= 0.70 THEN 'Immediate outreach + loyalty reward'
                    WHEN Score >= 0.40 THEN 'Targeted discount offer'
                    WHEN Score IS NOT NULL THEN 'Standard nurture emails' END AS RecommendedAction,
               CASE WHEN Score IS NOT NULL THEN {AS_OF} END AS LastScoredDate
        FROM s
    """,
    "customer_upsert": f"""
        SELECT CustomerID, 'new.' || Email AS Email, Segment, Region, JoinDate,
               IsActive OR Segment = 'At-Risk' AS IsActive,
               CASE WHEN Segment <> 'At-Risk' THEN CAST(Score AS DOUBLE) END AS ChurnRiskScore,
               CASE WHEN Segment <> 'At-Risk' THEN {category('Score')} END AS ChurnRiskCategory,
               CASE WHEN Segment <> 'At-Risk' THEN CustomerKey END AS KnownKey
        FROM customers
    """,
    "churn_measures": f"""
        , b AS (SELECT Segment, count(*) FILTER (Risk = 'High') AS high,
                       sum(risk_e4) FILTER (Risk IN ('High', 'Medium')) AS risk_e4,
                       sum(CAST(Score * 10000 AS BIGINT)) AS score_e4, count(Score) AS n,
                       sum(DaysSinceLastPurchase) AS days, count(DaysSinceLastPurchase) AS with_days
                FROM board GROUP BY Segment)
        SELECT Segment, high AS HighRiskCustomers, CAST({half_up('risk_e4', '100')} AS DOUBLE) / 100 AS TotalRevenueAtRisk,
               CAST({half_up('score_e4 * 100', 'n')} AS DOUBLE) / 1000000 AS AvgChurnRiskScore,
               CAST({half_up('risk_e4', '10')} AS DOUBLE) / 10000 AS RetentionUplift,
               round(CAST(days AS DOUBLE) / with_days, 6) AS AvgDaysSincePurchase
        FROM b
    """,
    "churn_category_share": """
        , everywhere AS (SELECT Risk, count(*) AS n FROM board GROUP BY Risk)
        SELECT Segment, Risk AS ChurnRiskCategory, count(*) AS Customers, any_value(n) AS CategoryCustomers
        FROM board JOIN everywhere USING (Risk) WHERE Region = 'ASIA' GROUP BY Segment, Risk
    """,
    "avg_daily_sales": f"""
        SELECT ProductKey, StoreKey, round(AvgDailySales, 6) AS AvgDailySales FROM daily_rates WHERE d = {AS_OF}
    """,
    "inventory_snapshot": f"SELECT * EXCLUDE (d) FROM snapshots WHERE d = {AS_OF}",
    "inventory_intelligence": """
        SELECT * EXCLUDE (value, excess), CAST(value AS DOUBLE) AS InventoryValue,
               CAST(excess AS DOUBLE) AS OverstockCost FROM intelligence
    """,
    "inventory_alerts": "SELECT * FROM alerts",
    "inventory_measures": """
        SELECT Region, CAST(sum(value) AS DOUBLE) AS TotalInventoryValue, CAST(sum(excess) AS DOUBLE) AS TotalOverstockCost,
               count(*) FILTER (StockOutRisk = 'High') AS HighStockOutSKUs,
               round(CAST(sum(DaysOfSupply) FILTER (DaysOfSupply < 999) AS DOUBLE)
                     / count(*) FILTER (DaysOfSupply < 999), 6) AS AvgDaysOfSupply,
               round(CAST(count(*) FILTER (OverstockFlag) AS DOUBLE) / count(*), 6) AS OverstockRate
        FROM intelligence GROUP BY Region
    """,
    "inventory_report": """
        SELECT Region, Category, CAST(grouping(Region, Category) AS BIGINT) AS Context,
               CAST(sum(value) AS DOUBLE) AS TotalInventoryValue, CAST(sum(excess) AS DOUBLE) AS TotalOverstockCost,
               count(*) FILTER (StockOutRisk = 'High') AS HighStockOutSKUs,
               round(CAST(sum(DaysOfSupply) FILTER (DaysOfSupply < 999) AS DOUBLE)
                     / nullif(count(*) FILTER (DaysOfSupply < 999), 0), 6) AS AvgDaysOfSupply,
               round(CAST(count(*) FILTER (OverstockFlag) AS DOUBLE) / count(*), 6) AS OverstockRate
        FROM intelligence GROUP BY GROUPING SETS ((Region, Category), (Region), ())
    """,
    "stored_snapshots": """
        SELECT DateKey, StockOutRisk, OverstockFlag, count(*) AS StockLines,
               CAST(sum(QuantityOnHand) AS BIGINT) AS UnitsOnHand
        FROM snapshots GROUP BY ALL
    """,
    "latest_insights": """
        , t AS (SELECT InsightArea, min(InsightText) AS InsightText FROM narratives
                WHERE InsightDate = (SELECT max(InsightDate) FROM narratives) GROUP BY InsightArea)
        SELECT a.InsightArea, InsightText
        FROM (VALUES ('Revenue'), ('Churn'), ('Inventory'), ('Overall')) a(InsightArea) LEFT JOIN t USING (InsightArea)
    """,
    "insights_last_updated": """
        SELECT 'AI insights generated: ' || strftime(max(InsightDate), '%b %d, %Y') AS InsightsLastUpdated FROM narratives
    """,
    "insight_prompts": f"""
        SELECT InsightArea, Wording, TotalOrders, {money('net')} AS TotalRevenue,
               CAST((SELECT count(*) FROM product_groups) AS INTEGER) AS TopProducts
        FROM kpis, {_wording()}
    """,
    "saved_insights": "SELECT InsightDate, InsightArea, InsightText, 'sample' AS ModelVersion FROM narratives",
    "kpi_context": f"""
        SELECT 'summary' AS Section, CAST(0 AS INTEGER) AS Position, Period AS Label, TotalOrders AS Quantity, {money('net')} AS Amount
        FROM kpis
        UNION ALL
        SELECT 'summary', Position, Label, Quantity, Amount FROM kpis, LATERAL (VALUES
            (1, 'ActiveCustomers', ActiveCustomers, NULL), (2, 'HighChurnCustomers', HighChurnCustomers, NULL),
            (3, 'HighStockOutSKUs', HighStockOutSKUs, NULL), (4, 'TotalGrossProfit', NULL, {money('profit')}),
            (5, 'GrossMarginPct', NULL, {percent('profit', 'net')}),
            (6, 'AvgRevenuePerCustomer', NULL, {mean_money('net', 'ActiveCustomers')}),
            (7, 'TotalRevenueAtRisk', NULL, CAST({half_up('at_risk', '100')} AS DOUBLE) / 100)) f(Position, Label, Quantity, Amount)
        UNION ALL
        SELECT 'top_products_profit', CAST(row_number() OVER (ORDER BY net DESC, Category, SubCategory) - 1 AS INTEGER),
               Category || '/' || SubCategory, units, {money('profit')}
        FROM product_groups
        UNION ALL
        SELECT 'top_products', CAST(row_number() OVER (ORDER BY net DESC, Category, SubCategory) - 1 AS INTEGER),
               Category || '/' || SubCategory, units, {money('net')}
        FROM product_groups
        UNION ALL
        SELECT 'churn_by_region', CAST(row_number() OVER (ORDER BY risk_e4 DESC, Region) - 1 AS INTEGER), Region, n,
               CAST({half_up('risk_e4', '100')} AS DOUBLE) / 100
        FROM risk_regions
        UNION ALL
        SELECT 'inventory_alerts', CAST(row_number() OVER (ORDER BY DaysOfSupply, ProductID, StoreName) - 1 AS INTEGER),
               ProductName || '/' || Category || '/' || StoreType || '/' || StockOutRisk, QuantityOnHand, DaysOfSupply
        FROM alerts
    """,
    "churn_features": """
        , q AS (SELECT quantile_cont(spend, 0.99) AS s, quantile_cont(avg_value, 0.99) AS a,
                       quantile_cont(days, 0.99) AS d FROM features),
          f AS (SELECT features.*, least(spend, s) AS TotalSpend, least(avg_value, a) AS AvgOrderValue,
                       least(days, d) AS DaysSinceLastPurchase FROM features, q)
        SELECT CustomerID, ChurnLabel, TotalOrders, UniqueCategories, SupportTickets, TenureMonths, SegmentScore,
               round(TotalSpend, 6) AS TotalSpend, round(AvgOrderValue, 6) AS AvgOrderValue,
               round(DaysSinceLastPurchase, 6) AS DaysSinceLastPurchase,
               round(ln(1 + TotalSpend), 6) AS LogTotalSpend, round(ln(1 + AvgOrderValue), 6) AS LogAvgOrderValue
        FROM f
    """,
    "feature_profile": """
        SELECT count(*) AS "count", round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std,
               round(min(p), 6) AS "min", round(quantile_cont(p, 0.25), 6) AS p25,
               round(quantile_cont(p, 0.5), 6) AS p50, round(quantile_cont(p, 0.75), 6) AS p75,
               round(max(p), 6) AS "max"
        FROM churn_scores
    """,
    "forest_agreement": """
        SELECT count(*) AS Customers, count(*) AS SameScores FROM features
    """,
    "score_evaluation": """
        , s AS (SELECT ChurnLabel, CAST(CustomerID AS BIGINT) * 37 % 10000 AS e4 FROM features),
          k AS (SELECT e4, count(*) FILTER (ChurnLabel = 1) AS churned, count(*) FILTER (ChurnLabel = 0) AS others FROM s GROUP BY e4),
          w AS (SELECT *, coalesce(sum(others) OVER (ORDER BY e4 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM k),
          a AS (SELECT sum(churned * (lower + others / 2.0)) / nullif(CAST(sum(churned) AS DOUBLE) * sum(others), 0) AS auc FROM w),
          v AS (SELECT Class, count(*) FILTER (ChurnLabel = Class AND CAST(e4 > 5000 AS INTEGER) = Class) AS hits,
                       count(*) FILTER (CAST(e4 > 5000 AS INTEGER) = Class) AS said, count(*) FILTER (ChurnLabel = Class) AS Support
                FROM s, (VALUES (0), (1)) c(Class) GROUP BY Class),
          r AS (SELECT *, coalesce(hits / nullif(said, 0), 0) AS p, coalesce(hits / nullif(Support, 0), 0) AS q FROM v WHERE said + Support > 0)
        SELECT Class, round(p, 6) AS Precision, round(q, 6) AS Recall, round(coalesce(2 * p * q / nullif(p + q, 0), 0), 6) AS F1,
               Support, round(auc, 6) AS AUC
        FROM r, a
    """,
    "stratified_split": """
        , n AS (SELECT ChurnLabel, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS t
                FROM features GROUP BY ChurnLabel),
          p AS (SELECT 'test' AS Part, ChurnLabel, t AS Customers FROM n
                UNION ALL SELECT 'train', ChurnLabel, n - t FROM n)
        SELECT Part, ChurnLabel, Customers, Customers AS DistinctCustomers FROM p WHERE Customers > 0
    """,
    "daily_refresh": """
        , active AS (SELECT count(*) AS n FROM customers WHERE IsActive OR Segment = 'At-Risk')
        SELECT t.*, Amount FROM (
        SELECT 'SalesRaw' AS TableName, count(*) AS TableRows FROM raw
        UNION ALL SELECT 'CustomerRaw', count(*) FROM customers
        UNION ALL SELECT 'InventoryRaw', count(*) FROM stock
        UNION ALL SELECT 'DimCustomer', count(*) FROM customers
        UNION ALL SELECT 'FactSales', count(*) FROM loadable
        UNION ALL SELECT 'SalesRejects', count(*) FROM raw WHERE OrderID IS NULL OR Quantity <= 0 OR UnitPrice < 0
        UNION ALL SELECT 'FactCustomerActivity', n FROM active
        UNION ALL SELECT 'ChurnScores', n FROM active
        UNION ALL SELECT 'FactInventory', count(*) FROM stock
        UNION ALL SELECT 'AIInsights', 4
        UNION ALL SELECT 'ModelEvaluation', 2
        UNION ALL SELECT 'ModelImportance', 10
        UNION ALL SELECT 'ScoreProfile', 1
        UNION ALL SELECT 'ScorePreview', least(20, n) FROM active) t
        LEFT JOIN (
            SELECT 'SalesRaw' AS TableName, CAST(sum(Quantity) AS DOUBLE) AS Amount FROM raw
            UNION ALL SELECT 'InventoryRaw', CAST(sum(ReorderPoint) AS DOUBLE) FROM stock
            UNION ALL SELECT 'FactInventory', CAST(sum(QuantityOnHand) AS DOUBLE) FROM stock
            UNION ALL SELECT 'FactSales', CAST(round(sum(CAST(Quantity * UnitPrice * (1 - Discount * 0.01) AS DECIMAL(18,6))), 2) AS DOUBLE) FROM loadable
        ) USING (TableName)
    """,
}


def _needed(sql: str) -> list[str]:
    """Relations that ``sql`` uses, in an order in which each one's inputs precede it."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in RELATIONS:
            if name not in found and re.search(rf"\b{name}\b", text):
                visit(RELATIONS[name])
                found.append(name)

    visit(sql)
    return found


def oracle_sql() -> dict[str, str]:
    """Query name to complete SQL statement."""
    statements = {}
    for name, sql in QUERIES.items():
        names = _needed(sql)
        text = sql.strip()
        extra = text.startswith(",")
        ctes = ",\n".join(f"{n} AS ({RELATIONS[n].strip()})" for n in names)
        if ctes:
            statements[name] = f"WITH {ctes}\n{text}"
        else:
            statements[name] = f"WITH {text[1:]}" if extra else text
    return statements
