"""Thresholds, labels and texts that every result depends on."""

from decimal import Decimal

# --- sales load -------------------------------------------------------------
REJECT_REASON = "NULL OrderID or invalid Qty/Price"

# --- churn ------------------------------------------------------------------
HIGH_RISK_FROM = Decimal("0.70")
MEDIUM_RISK_FROM = Decimal("0.40")
MONTHS_PER_YEAR = Decimal("12")
HIGH_RISK_SHARE = Decimal("0.85")
MEDIUM_RISK_SHARE = Decimal("0.45")
RETENTION_UPLIFT = Decimal("0.10")
CHURNED_AFTER_DAYS = 90
TICKET_MONTHS = 6
SEGMENT_SCORES = {"Premium": 3, "Regular": 2}
OTHER_SEGMENT_SCORE = 1
RECOMMENDED_ACTIONS = {
    "Low": "Standard nurture emails",
    "Medium": "Targeted discount offer",
    "High": "Immediate outreach + loyalty reward",
}

# --- churn model ------------------------------------------------------------
BASE_FEATURES = [
    "TotalOrders",
    "TotalSpend",
    "AvgOrderValue",
    "DaysSinceLastPurchase",
    "UniqueCategories",
    "SupportTickets",
    "TenureMonths",
    "SegmentScore",
]
CAPPED_FEATURES = ["TotalSpend", "AvgOrderValue", "DaysSinceLastPurchase"]
CAP_QUANTILE = 0.99
LOG_FEATURES = {"LogTotalSpend": "TotalSpend", "LogAvgOrderValue": "AvgOrderValue"}
TEST_SHARE = 0.2
SEED = 42
TREES = 300
TREE_DEPTH = 8
MIN_LEAF = 10
PREVIEW_ROWS = 20

# --- inventory --------------------------------------------------------------
SALES_WINDOW_DAYS = 30
NO_SALES_DAYS_OF_SUPPLY = 999
OVERSTOCK_FLAG_FACTOR = 3
OVERSTOCK_COST_FACTOR = 2

# --- reports ----------------------------------------------------------------
TOP_ROWS = 5
KPI_PERIOD = "Current Month"
INSIGHTS_LABEL = "AI insights generated: "
UNRESTRICTED_ROLES = ["Executives"]

# --- narrative prompts ------------------------------------------------------
INSIGHT_AREAS = ["Revenue", "Churn", "Inventory", "Overall"]
FALLBACK_AREA = "Overall"
PROMPT_OPENING = """
You are a senior retail data analyst generating concise, actionable business insights 
for executive dashboards. Today is """
PROMPT_RULES = """. Speak directly to business leaders.
Avoid jargon. Be specific with numbers. Recommend one clear action per insight.

Here is the latest data in JSON format:
"""
PROMPT_TASKS = {
    "Revenue": """
Generate a 3-sentence revenue insight covering:
1. How current month revenue is trending
2. Which product category is leading
3. One specific recommendation to grow revenue next month.
""",
    "Churn": """
Generate a 3-sentence customer churn insight covering:
1. The size of the at-risk customer base and revenue at stake
2. Which region has the highest churn exposure
3. One specific retention action to take immediately.
""",
    "Inventory": """
Generate a 3-sentence inventory insight covering:
1. Which products are at highest stockout risk
2. The financial implication of stockout vs overstock
3. One specific supply chain action recommended.
""",
    "Overall": """
Generate a concise 4-sentence executive summary covering:
revenue performance, customer retention risk, inventory health, 
and the single most important action the business should take this week.
""",
}
