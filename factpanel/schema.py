"""Column names, tag map and column lists shared by the whole package."""

from __future__ import annotations

# A filing is identified by its id inside one dataset period.
PERIOD_COLS = ["dataset_year", "dataset_quarter"]
FILING_ID = "adsh"
COMPANY_ID = "cik"

# Tables of a release, and the ones a complete period must have.
RELEASE_TABLES = ["sub", "num", "pre", "tag", "txt"]
REQUIRED_TABLES = ["sub", "num", "pre", "tag"]
DEFAULT_FORMS = ["10-K", "10-Q"]

# Tags that mean one metric.
DEFAULT_TAGS: dict[str, list[str]] = {
    "revenue": [
        "Revenues",
        "SalesRevenueNet",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
    ],
    "net_income": ["NetIncomeLoss", "ProfitLoss"],
    "gross_profit": ["GrossProfit", "GrossProfitLoss"],
    "operating_income": ["OperatingIncomeLoss"],
    "eps_basic": ["EarningsPerShareBasic"],
    "eps_diluted": ["EarningsPerShareDiluted"],
    "total_assets": ["Assets", "AssetsTotal"],
    "total_liabilities": ["Liabilities", "LiabilitiesTotal"],
    "total_equity": [
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
        "StockholdersEquityAttributableToParent",
        "LiabilitiesAndStockholdersEquity",
        "LiabilitiesAndStockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
        "LiabilitiesAndStockholdersEquityExcludingPortionAttributableToNoncontrollingInterest",
    ],
    "cfo": [
        "NetCashProvidedByUsedInOperatingActivities",
        "NetCashProvidedByUsedInOperatingActivitiesContinuingOperations",
    ],
    "cfi": [
        "NetCashProvidedByUsedInInvestingActivities",
        "NetCashProvidedByUsedInInvestingActivitiesContinuingOperations",
    ],
    "cff": [
        "NetCashProvidedByUsedInFinancingActivities",
        "NetCashProvidedByUsedInFinancingActivitiesContinuingOperations",
    ],
}

# One tag per metric, for the simple screener.
SCREENER_TAGS: dict[str, str] = {
    "revenue": "Revenues",
    "net_income": "NetIncomeLoss",
    "gross_profit": "GrossProfit",
    "operating_income": "OperatingIncomeLoss",
    "eps_basic": "EarningsPerShareBasic",
    "eps_diluted": "EarningsPerShareDiluted",
    "total_assets": "Assets",
    "total_liabilities": "Liabilities",
    "total_equity": "StockholdersEquity",
}

# Numerator and denominator of every ratio.
RATIOS: dict[str, tuple[str, str]] = {
    "gross_margin": ("gross_profit", "revenue"),
    "operating_margin": ("operating_income", "revenue"),
    "net_margin": ("net_income", "revenue"),
    "roa": ("net_income", "total_assets"),
    "roe": ("net_income", "total_equity"),
    "asset_turnover": ("revenue", "total_assets"),
    "debt_to_equity": ("total_liabilities", "total_equity"),
    "debt_to_assets": ("total_liabilities", "total_assets"),
    "equity_ratio": ("total_equity", "total_assets"),
    "assets_to_equity": ("total_assets", "total_equity"),
}

# Panel columns that get a year-over-year change, a trailing sum,
# a change of the trailing value, or a step change.
YOY_COLS = [
    "revenue", "net_income", "gross_profit", "operating_income",
    "eps_basic", "eps_diluted",
    "total_assets", "total_liabilities", "total_equity",
    "cfo", "cfi", "fcf_approx",
    "gross_margin", "operating_margin", "net_margin",
    "roa", "roe", "asset_turnover",
    "debt_to_equity", "debt_to_assets", "equity_ratio", "assets_to_equity",
    "fcf_to_net_income",
]
TTM_COLS = ["revenue", "net_income", "gross_profit", "operating_income", "fcf_approx"]
TTM_YOY_COLS = ["ttm_revenue", "ttm_net_income", "ttm_net_margin", "ttm_fcf_approx"]
DELTA_COLS = [
    "revenue", "net_income", "gross_profit", "operating_income",
    "gross_margin", "operating_margin", "net_margin",
    "roa", "roe", "asset_turnover",
    "debt_to_equity", "debt_to_assets", "equity_ratio", "assets_to_equity",
    "fcf_approx", "fcf_to_net_income",
]

# Columns that are made numeric on the single-period surface.
NUMERIC_COLS = [
    "pubfloatusd", "floataxis", "floatmems",
    *DEFAULT_TAGS,
    "fcf_approx", "fcf_to_net_income",
    *RATIOS,
]

# Column lists of the reports.
COMPARE_METRICS = [
    "revenue", "net_income", "gross_margin", "operating_margin",
    "net_margin", "roa", "roe", "fcf_approx",
]
SHEET_COLS = [
    "name", "cik", "fy", "fp", "revenue", "net_income",
    "gross_margin", "net_margin", "operating_margin", "roe", "roa", "fcf_approx",
]
PANEL_REQUIRED_COLS = [
    "cik", "period", "form", "revenue", "net_income", "ttm_revenue", "ttm_net_income",
]
SCREENER_COLS = ["cik", "name", "adsh", "form", "fy", "fp", "period", "filed"]

# Companies whose coverage the audit reports.
KNOWN_COMPANIES: dict[str, str] = {
    "Apple": "0000320193",
    "Microsoft": "0000789019",
    "Amazon": "0001018724",
    "Meta": "0001326801",
    "Alphabet": "0001652044",
    "Nvidia": "0001045810",
    "Tesla": "0001318605",
    "JPMorgan": "0000019617",
    "Exxon": "0000034088",
}


def filing_keys(*frames) -> list[str]:
    """Columns that identify a filing and are present in every given frame."""
    keys = [*PERIOD_COLS, FILING_ID]
    shared = set.intersection(*[set(f.columns) for f in frames])
    return [k for k in keys if k in shared]
