"""Values given by the workbooks and by the checks on them.

Everything in this file is a fixed value: sheet names, header texts, offsets
and category lists have to be exactly these for the results to be right.
"""

# Sheets that never hold data (compared trimmed and lower-case).
SKIP_SHEETS = [
    "cover",
    "notes",
    "contents",
    "important notice",
    "revisions",
    "explanatory notes",
    "filters control",
    "charts",
    "charts data",
]

# How many leading rows are searched for a header, and how many
# filled cells a row must exceed to be one.
HEADER_SEARCH_ROWS = 15
HEADER_MIN_FILLED = 3

# The three sheets of the product workbook and the row index of
# their headers.
RETURNS_SHEET, RETURNS_HEADER = "Table 2a", 4
ASSETS_SHEET, ASSETS_HEADER = "Table 1a", 3
MEMBERS_SHEET, MEMBERS_HEADER = "Table 4", 2

# Header text -> column name, per sheet.
RETURNS_COLUMNS = {
    "Period*": "quarter_year",
    "MySuper product name": "product_name",
    "Fund name": "fund_name",
    "Fund ABN": "abn",
    "Fund type": "fund_type",
    "One-year net return (rep member) - Annualised": "return_1yr",
    "Three year net return (rep member) - Annualised": "return_3yr",
    "Five year net return (rep member) - Annualised": "return_5yr",
    "Investment fees (rep member)": "investment_fee_pct",
    "Administration fees and costs (rep member)": "admin_fee_pct",
    "Total fees and costs (rep member)": "total_fee_pct",
}
ASSETS_COLUMNS = {
    "Period*": "quarter_year",
    "Fund ABN": "abn",
    "Total assets": "net_assets_m",
}
MEMBERS_COLUMNS = {
    "Period *": "quarter_year",
    "Fund ABN": "abn",
    "Member accounts": "member_accounts",
}

# Categories the checks accept.
FUND_TYPES = ["industry", "retail", "public sector", "corporate", "retirement savings account"]
VALUE_QUADRANTS = ["best_value", "expensive_performer", "cheap_underperformer", "worst_value"]

# Rows a question may return; quarters in a rolling year.
RESULT_CAP = 200
ROLLING_QUARTERS = 4
