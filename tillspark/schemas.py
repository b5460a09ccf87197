"""Table schemas.

Surrogate keys are long so that they outlast two billion rows.  Money stays
decimal; ``TotalSpend`` is wide because one customer may own much of the fact.
"""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "int": IntegerType(),
    "long": LongType(),
    "str": StringType(),
    "date": DateType(),
    "ts": TimestampType(),
    "bool": BooleanType(),
    "price": DecimalType(10, 2),
    "percent": DecimalType(5, 2),
    "money": DecimalType(18, 6),
    "sum": DecimalType(28, 6),
    "total": DecimalType(20, 2),
    "share": DecimalType(5, 4),
    "float": DoubleType(),
    "bits": BinaryType(),
    "texts": ArrayType(StringType()),
}


def _schema(columns: str) -> StructType:
    fields = (item.split(":") for item in columns.split())
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


# --- landing and staging ----------------------------------------------------
SALES_EXTRACT = _schema(
    "OrderID:str OrderLineID:int CustomerID:str ProductID:str StoreID:str OrderDate:date "
    "Quantity:int UnitPrice:price Discount:percent ReturnFlag:int"
)
CUSTOMER_EXTRACT = _schema(
    "CustomerID:str FirstName:str LastName:str Email:str Segment:str Region:str State:str "
    "City:str JoinDate:date"
)
INVENTORY_EXTRACT = _schema("ProductID:str StoreID:str QuantityOnHand:int ReorderPoint:int")

SALES_RAW = _schema(
    "OrderID:str OrderLineID:int CustomerID:str ProductID:str StoreID:str OrderDate:date "
    "Quantity:int UnitPrice:price Discount:percent ReturnFlag:bool ProcessedFlag:bool ProcessedDate:ts"
)
SALES_REJECTS = _schema("OrderID:str RejectReason:str RejectDate:ts")
SUPPORT_TICKETS = _schema("CustomerID:str CreatedDate:ts")
CHURN_SCORES = _schema("CustomerID:str ChurnProbability:share ScoredDate:date")
TARGETS = _schema("Month:int Year:int MonthlyTarget:total")
USER_REGIONS = _schema("UserEmail:str Region:str")

# --- star schema ------------------------------------------------------------
DIM_DATE = _schema(
    "DateKey:int FullDate:date DayOfWeek:int DayName:str WeekOfYear:int MonthNumber:int MonthName:str "
    "Quarter:int Year:int IsWeekend:bool IsHoliday:bool FiscalYear:int FiscalQuarter:int"
)
DIM_STORE = _schema(
    "StoreKey:long StoreID:str StoreName:str Region:str State:str City:str StoreType:str OpenDate:date "
    "IsActive:bool"
)
DIM_PRODUCT = _schema(
    "ProductKey:long ProductID:str ProductName:str Category:str SubCategory:str Brand:str UnitCost:price "
    "UnitPrice:price GrossMarginPct:price IsActive:bool"
)
DIM_CUSTOMER = _schema(
    "CustomerKey:long CustomerID:str FirstName:str LastName:str Email:str Segment:str Region:str State:str "
    "City:str ZipCode:str JoinDate:date IsActive:bool ChurnRiskScore:share ChurnRiskCategory:str "
    "LastScoredDate:date"
)
FACT_SALES = _schema(
    "OrderID:str OrderLineID:int DateKey:int CustomerKey:long ProductKey:long StoreKey:long Quantity:int "
    "UnitPrice:price Discount:percent GrossSales:money NetSales:money COGS:money GrossProfit:money "
    "ReturnFlag:bool"
)
FACT_INVENTORY = _schema(
    "DateKey:int ProductKey:long StoreKey:long QuantityOnHand:int ReorderPoint:int DaysOfSupply:int "
    "StockOutRisk:str OverstockFlag:bool"
)
FACT_CUSTOMER_ACTIVITY = _schema(
    "CustomerKey:long DateKey:int TotalOrders:long TotalSpend:total AvgOrderValue:price "
    "DaysSinceLastPurchase:int UniqueCategories:long SupportTickets:long"
)
INSIGHTS = _schema(
    "InsightDate:date InsightArea:str InsightText:str KPIContext:str ModelVersion:str GeneratedAt:ts"
)
MODEL_EVALUATION = _schema("Class:int Precision:float Recall:float F1:float Support:long AUC:float")
MODEL_IMPORTANCE = _schema("Feature:str Importance:float")
SCORE_PROFILE = _schema("count:long mean:float std:float min:float p25:float p50:float p75:float max:float")
FOREST_NODES = _schema("Tree:int Node:int Feature:int Threshold:float LeftNode:int RightNode:int ChurnShare:float")
FOREST_INPUTS = _schema("Feature:int Name:str Shift:float Scale:float")
SCORE_PREVIEW = _schema("CustomerID:str ChurnProbability:share ChurnRiskCategory:str ScoredDate:date")
KPI_CONTEXT = _schema("KPIContext:str KPIText:str")

# --- stored totals per day --------------------------------------------------
SALES_GROUPS = _schema(
    "DateKey:int Region:str State:str StoreType:str Category:str SubCategory:str Brand:str CustomerSegment:str "
    "GrossSales:sum NetSales:sum GrossProfit:sum UnitsSold:long OrderCount:long UniqueCustomers:long"
)
SALES_REGIONS = _schema("DateKey:int Region:str NetSales:sum GrossProfit:sum Lines:long")
SALES_ORDERS = _schema("DateKey:int Region:str OrderID:str")
SALES_CUSTOMERS = _schema("DateKey:int Region:str Bucket:long Bits:bits")
SUMMARY_BATCHES = _schema("BatchID:str Attempt:int DateKey:int")
SUMMARY_KEYS = _schema("DimTable:str Key:long Groups:texts Present:bool")

# --- constraints ------------------------------------------------------------
BUSINESS_KEYS = {"DimCustomer": ["CustomerID"], "DimProduct": ["ProductID"], "DimStore": ["StoreID"]}
SALES_FOREIGN_KEYS = {
    "CustomerKey": "DimCustomer",
    "DateKey": "DimDate",
    "ProductKey": "DimProduct",
    "StoreKey": "DimStore",
}
INVENTORY_FOREIGN_KEYS = {"DateKey": "DimDate", "ProductKey": "DimProduct", "StoreKey": "DimStore"}
ACTIVITY_FOREIGN_KEYS = {"CustomerKey": "DimCustomer", "DateKey": "DimDate"}
REQUIRED_COLUMNS = {
    "DimDate": ["FullDate"],
    "DimCustomer": ["CustomerID"],
    "DimProduct": ["ProductID"],
    "DimStore": ["StoreID"],
    "FactSales": ["OrderID", "OrderLineID", "DateKey", "CustomerKey", "ProductKey", "StoreKey"],
    "FactInventory": ["DateKey", "ProductKey", "StoreKey"],
    "FactCustomerActivity": ["CustomerKey", "DateKey"],
    "AIInsights": ["InsightDate"],
}
