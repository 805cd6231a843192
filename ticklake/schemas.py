"""Rule tables and fixed reference values.

Everything in the FIXED VALUES blocks must equal the source system's values for
results to match: the XBRL local-name map, the preferred merge names, the
canonical financial lines, the transaction codes and the section rules.  They are
small (< 200 entries each) and are turned into broadcastable DataFrames by
``rule_df``; their size never grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES: XBRL normalised local name -> (line_code, statement)
# 124 keys, statement is one of balance | income | cashflow.
# ---------------------------------------------------------------------------
GAAP_MAP: list[tuple[str, str, str]] = [
    ("revenues", "revenue", "income"),
    ("revenuefromcontractwithcustomerexcludingassessedtax", "revenue", "income"),
    ("revenuefromcontractwithcustomerincludingsubsidies", "revenue", "income"),
    ("salesrevenuenet", "revenue", "income"),
    ("salesrevenuegoodsnet", "revenue", "income"),
    ("salesrevenueservicesnet", "revenue", "income"),
    ("totalrevenue", "revenue", "income"),
    ("operatingrevenue", "revenue", "income"),
    ("costofrevenue", "cost_of_revenue", "income"),
    ("costofgoodssold", "cost_of_revenue", "income"),
    ("costofgoodsandservicessold", "cost_of_revenue", "income"),
    ("costofservicessold", "cost_of_revenue", "income"),
    ("costofsales", "cost_of_revenue", "income"),
    ("grossprofit", "gross_profit", "income"),
    ("operatingexpenses", "operating_expenses", "income"),
    ("operatingcostsandexpenses", "operating_expenses", "income"),
    ("operatingincomeloss", "operating_income", "income"),
    ("incomelossfromcontinuingoperationsbeforeincometaxes", "operating_income", "income"),
    ("incomelossfromcontinuingoperationsbeforeincometaxesminorityinterestandincomelossfromequitymethodinvestments", "operating_income", "income"),
    ("incomelossfromcontinuingoperationsbeforeincometaxesextraordinaryitemsnoncontrollinginterest", "income_before_tax", "income"),
    ("researchanddevelopmentexpense", "research_and_development", "income"),
    ("sellinggeneralandadministrativeexpense", "selling_general_administrative", "income"),
    ("netincomeloss", "net_income", "income"),
    ("profitloss", "net_income", "income"),
    ("netincomelossavailabletocommonstockholdersbasic", "net_income", "income"),
    ("netincomelossattributabletocommonstockholdersbasicanddiluted", "net_income", "income"),
    ("interestexpense", "interest_expense", "income"),
    ("interestincomeexpensenet", "interest_income", "income"),
    ("interestincomeexpenseafterprovisionforlosses", "interest_income", "income"),
    ("incometaxexpensebenefit", "income_tax_expense", "income"),
    ("incometaxexpensebenefitcontinuingoperations", "income_tax_expense", "income"),
    ("earningspersharebasic", "eps_basic", "income"),
    ("earningspersharediluted", "eps_diluted", "income"),
    ("weightedaveragenumberofsharesoutstandingbasic", "shares_weighted_avg_basic", "income"),
    ("weightedaveragenumberofdilutedsharesoutstanding", "shares_weighted_avg_diluted", "income"),
    ("assets", "total_assets", "balance"),
    ("assetscurrent", "current_assets", "balance"),
    ("liabilities", "total_liabilities", "balance"),
    ("liabilitiescurrent", "current_liabilities", "balance"),
    ("stockholdersequity", "stockholders_equity", "balance"),
    ("equity", "stockholders_equity", "balance"),
    ("equityattributabletononcontrollinginterest", "stockholders_equity", "balance"),
    ("retainedearningsaccumulateddeficit", "retained_earnings", "balance"),
    ("retainedearnings", "retained_earnings", "balance"),
    ("cashandcashequivalentsatcarryingvalue", "cash_and_equivalents", "balance"),
    ("cashcashequivalentsrestrictedcashandrestrictedcashequivalents", "cash_and_equivalents", "balance"),
    ("accountsreceivablenetcurrent", "accounts_receivable", "balance"),
    ("accountsreceivablenet", "accounts_receivable", "balance"),
    ("inventorynet", "inventory", "balance"),
    ("inventoryfinishedgoodnetofreserves", "inventory", "balance"),
    ("propertyplantandequipmentnet", "ppe_net", "balance"),
    ("goodwill", "goodwill", "balance"),
    ("longtermdebtnoncurrent", "long_term_debt", "balance"),
    ("longtermdebt", "long_term_debt", "balance"),
    ("longtermdebtandcapitalsecurity", "long_term_debt", "balance"),
    ("assetsnoncurrent", "noncurrent_assets", "balance"),
    ("liabilitiesnoncurrent", "noncurrent_liabilities", "balance"),
    ("netcashprovidedbyusedinoperatingactivities", "cashflow_operating", "cashflow"),
    ("netcashprovidedbyusedininvestingactivities", "cashflow_investing", "cashflow"),
    ("netcashprovidedbyusedinfinancingactivities", "cashflow_financing", "cashflow"),
    ("depreciationdepletionandamortization", "depreciation_amortization", "cashflow"),
    ("depreciationandamortization", "depreciation_amortization", "cashflow"),
    ("paymentstoacquirepropertyplantandequipment", "capex", "cashflow"),
    ("paymentstoacquireproductivesets", "capex", "cashflow"),
    ("revenuesnet", "revenue", "income"),
    ("netsales", "revenue", "income"),
    ("salesandrevenuenet", "revenue", "income"),
    ("revenuefromcontractwithcustomer", "revenue", "income"),
    ("revenuefromservices", "revenue", "income"),
    ("revenuefromgoods", "revenue", "income"),
    ("costofgoodssoldexclusivedepreciationshownseparately", "cost_of_revenue", "income"),
    ("costofservices", "cost_of_revenue", "income"),
    ("costofproductssold", "cost_of_revenue", "income"),
    ("grossprofitloss", "gross_profit", "income"),
    ("incomelossfromcontinuingoperationsbeforeincometaxesextraordinaryitemsandcumulativeeffectofchangeinaccountingprinciple", "operating_income", "income"),
    ("incomebeforetax", "income_before_tax", "income"),
    ("earningsbeforeinterestandtaxes", "ebit", "income"),
    ("operatingincome", "operating_income", "income"),
    ("nonoperatingincomeexpense", "net_income", "income"),
    ("otheroperatingincome", "operating_income", "income"),
    ("otheroperatingexpense", "operating_expenses", "income"),
    ("othernonoperatingincome", "net_income", "income"),
    ("othernonoperatingexpense", "net_income", "income"),
    ("netincomelossattributabletocommonstockholders", "net_income", "income"),
    ("cash", "cash_and_equivalents", "balance"),
    ("cashandcashequivalentsatcarryingvalueincludingdiscontinuedoperations", "cash_and_equivalents", "balance"),
    ("marketablesecuritiescurrent", "short_term_investments", "balance"),
    ("shortterminvestments", "short_term_investments", "balance"),
    ("availableforsalesecuritiescurrent", "short_term_investments", "balance"),
    ("prepaidexpenseandotherassetscurrent", "prepaid_expenses", "balance"),
    ("prepaidexpensecurrent", "prepaid_expenses", "balance"),
    ("otherassetscurrent", "other_current_assets", "balance"),
    ("otherassetsnoncurrent", "other_noncurrent_assets", "balance"),
    ("intangibleassetsnetexcludinggoodwill", "intangible_assets_other", "balance"),
    ("finiteintangibleassetsnet", "intangible_assets_other", "balance"),
    ("indefinitelivedintangibleassetsnet", "intangible_assets_other", "balance"),
    ("accountspayablecurrent", "accounts_payable", "balance"),
    ("accountspayabletradecurrent", "accounts_payable", "balance"),
    ("employeerelatedliabilitiescurrent", "accrued_liabilities", "balance"),
    ("accruedliabilitiescurrent", "accrued_liabilities", "balance"),
    ("otherliabilitiescurrent", "accrued_liabilities", "balance"),
    ("contractwithcustomerliabilitycurrent", "deferred_revenue", "balance"),
    ("contractwithcustomerliability", "deferred_revenue", "balance"),
    ("deferredrevenuecurrent", "deferred_revenue", "balance"),
    ("deferredrevenue", "deferred_revenue", "balance"),
    ("longtermdebtcurrent", "debt_current", "balance"),
    ("shorttermborrowings", "debt_current", "balance"),
    ("commercialpaper", "commercial_paper", "balance"),
    ("longtermdebtandcapitalsecuritycurrent", "debt_current", "balance"),
    ("operatingleaseliabilitynoncurrent", "operating_lease_liability", "balance"),
    ("operatingleaseliabilitycurrent", "operating_lease_liability", "balance"),
    ("leaseobligation", "operating_lease_liability", "balance"),
    ("noncontrollinginterest", "stockholders_equity", "balance"),
    ("temporaryequitycarryingamountattributabletoparent", "stockholders_equity", "balance"),
    ("commonstockincludingadditionalpaidincapital", "stockholders_equity", "balance"),
    ("commonstocksincludingadditionalpaidincapital", "stockholders_equity", "balance"),
    ("commonstockvalue", "stockholders_equity", "balance"),
    ("additionalpaidincapital", "stockholders_equity", "balance"),
    ("treasurystockvalue", "stockholders_equity", "balance"),
    ("accumulatedothercomprehensiveincomelossnetoftax", "accumulated_other_comprehensive_income", "balance"),
    ("marketablesecuritiesnoncurrent", "other_noncurrent_assets", "balance"),
    ("nontradereceivablescurrent", "other_current_assets", "balance"),
    ("otherliabilitiesnoncurrent", "other_noncurrent_liabilities", "balance"),
    ("intangibleassetsnetexcludinggoodwillnoncurrent", "intangible_assets_other_noncurrent", "balance"),
]

# FIXED VALUES: merge preference, line_code -> preferred normalised names in order.
MERGE_PREFERRED: dict[str, tuple[str, ...]] = {
    "stockholders_equity": ("stockholdersequity",),
    "net_income": ("netincomeloss", "profitloss"),
    "debt_current": ("longtermdebtcurrent", "longtermdebtandcapitalsecuritycurrent", "shorttermborrowings"),
    "cashflow_operating": ("netcashprovidedbyusedinoperatingactivities",),
    "cashflow_investing": ("netcashprovidedbyusedininvestingactivities",),
    "cashflow_financing": ("netcashprovidedbyusedinfinancingactivities",),
}

# FIXED VALUES: namespace prefixes.
# Anchor inference strips these raw prefixes (case-blind) when the concept has no '}' or ':'.
ANCHOR_PREFIXES = (
    "us-gaap_", "us-gaap:", "ifrs-full_", "ifrs-full:", "ifrs_", "ifrs:",
    "dei_", "dei:", "srt_", "srt:", "ecd_", "ecd:",
)
# Lookup keys: the normalised name, then the name with each of these stripped.
TAXONOMY_PREFIXES = ("usgaap", "ifrsfull", "ifrs", "dei", "srt", "ecd", "currency")
# Issuer-extension prefixes that are not issuers.
ISSUER_BLOCKED = ("us", "dei", "srt", "ecd", "currency", "na")

# FIXED VALUES: statement frame metadata column names (compared case-blind).
STATEMENT_METADATA_COLUMNS = (
    "concept", "label", "standard_concept", "preferred_sign", "decimals", "units",
    "unit", "scale", "depth", "is_abstract", "index",
)

# FIXED VALUES: canonical financial lines
# (line_code, statement, display_name, synonyms, us_gaap_tag, sort_order)
FINANCIAL_LINES: list[tuple[str, str, str, list[str], str, int]] = [
    ("revenue", "income", "Revenue", ["revenue", "sales", "top line", "total revenue"], "Revenues", 10),
    ("cost_of_revenue", "income", "Cost of revenue", ["cost of revenue", "cost of sales", "cogs"], "CostOfRevenue", 20),
    ("gross_profit", "income", "Gross profit", ["gross profit"], "GrossProfit", 30),
    ("operating_expenses", "income", "Operating expenses", ["operating expenses", "opex"], "OperatingExpenses", 40),
    ("operating_income", "income", "Operating income", ["operating income", "operating profit", "op income"], "OperatingIncomeLoss", 50),
    ("income_before_tax", "income", "Income before tax", ["income before tax", "pretax income", "ebt"], "IncomeLossFromContinuingOperationsBeforeIncomeTaxesExtraordinaryItems", 55),
    ("ebit", "income", "EBIT", ["ebit", "earnings before interest and taxes"], "EarningsBeforeInterestAndTaxes", 56),
    ("net_income", "income", "Net income", ["net income", "net earnings", "profit", "bottom line"], "NetIncomeLoss", 60),
    ("research_and_development", "income", "Research and development", ["r&d", "research and development"], "ResearchAndDevelopmentExpense", 70),
    ("selling_general_administrative", "income", "SG&A", ["sg&a", "selling general administrative"], "SellingGeneralAndAdministrativeExpense", 80),
    ("interest_expense", "income", "Interest expense", ["interest expense"], "InterestExpense", 90),
    ("interest_income", "income", "Interest income", ["interest income"], "InterestIncomeExpenseNet", 95),
    ("income_tax_expense", "income", "Income tax expense", ["income tax", "tax expense"], "IncomeTaxExpenseBenefit", 100),
    ("eps_basic", "income", "EPS (basic)", ["eps basic", "earnings per share basic"], "EarningsPerShareBasic", 110),
    ("shares_weighted_avg_basic", "income", "Weighted average shares outstanding (basic)", ["wavg basic", "basic shares"], "WeightedAverageNumberOfSharesOutstandingBasic", 115),
    ("eps_diluted", "income", "EPS (diluted)", ["eps diluted", "earnings per share diluted"], "EarningsPerShareDiluted", 120),
    ("shares_weighted_avg_diluted", "income", "Weighted average shares outstanding (diluted)", ["wavg diluted"], "WeightedAverageNumberOfDilutedSharesOutstanding", 125),
    ("total_assets", "balance", "Total assets", ["total assets", "assets"], "Assets", 200),
    ("current_assets", "balance", "Current assets", ["current assets"], "AssetsCurrent", 210),
    ("short_term_investments", "balance", "Short-term investments", ["marketable securities", "st investments"], "MarketableSecuritiesCurrent", 215),
    ("cash_and_equivalents", "balance", "Cash and cash equivalents", ["cash", "cash and equivalents", "cash and cash equivalents"], "CashAndCashEquivalentsAtCarryingValue", 220),
    ("prepaid_expenses", "balance", "Prepaid expenses", ["prepaid", "prepaids"], "PrepaidExpenseCurrent", 225),
    ("accounts_receivable", "balance", "Accounts receivable", ["accounts receivable", "a/r", "receivables"], "AccountsReceivableNetCurrent", 230),
    ("other_current_assets", "balance", "Other current assets", ["other current assets"], "OtherAssetsCurrent", 235),
    ("inventory", "balance", "Inventory", ["inventory", "inventories"], "InventoryNet", 240),
    ("ppe_net", "balance", "Property, plant and equipment (net)", ["ppe", "property plant equipment", "pp&e"], "PropertyPlantAndEquipmentNet", 250),
    ("noncurrent_assets", "balance", "Non-current assets", ["long term assets", "noncurrent assets"], "AssetsNoncurrent", 252),
    ("other_noncurrent_assets", "balance", "Other non-current assets", ["other long term assets"], "OtherAssetsNoncurrent", 255),
    ("goodwill", "balance", "Goodwill", ["goodwill"], "Goodwill", 260),
    ("intangible_assets_other", "balance", "Intangible assets (excl. goodwill)", ["intangibles", "intangible assets"], "IntangibleAssetsNetExcludingGoodwill", 265),
    ("intangible_assets_other_noncurrent", "balance", "Intangible assets excl. goodwill (non-current)", ["intangibles noncurrent"], "IntangibleAssetsNetExcludingGoodwillNoncurrent", 267),
    ("total_liabilities", "balance", "Total liabilities", ["total liabilities", "liabilities"], "Liabilities", 270),
    ("accounts_payable", "balance", "Accounts payable", ["a/p", "trade payables"], "AccountsPayableCurrent", 275),
    ("current_liabilities", "balance", "Current liabilities", ["current liabilities"], "LiabilitiesCurrent", 280),
    ("accrued_liabilities", "balance", "Accrued and other current liabilities", ["accrued expenses", "other current liabilities"], "AccruedLiabilitiesCurrent", 285),
    ("long_term_debt", "balance", "Long-term debt", ["long term debt", "ltd"], "LongTermDebtNoncurrent", 290),
    ("deferred_revenue", "balance", "Deferred revenue / contract liabilities", ["contract liability", "unearned revenue"], "ContractWithCustomerLiabilityCurrent", 295),
    ("debt_current", "balance", "Current portion of debt", ["short term debt", "current debt"], "LongTermDebtCurrent", 305),
    ("commercial_paper", "balance", "Commercial paper", ["commercial paper", "cp"], "CommercialPaper", 306),
    ("noncurrent_liabilities", "balance", "Non-current liabilities", ["long term liabilities", "noncurrent liabilities"], "LiabilitiesNoncurrent", 312),
    ("operating_lease_liability", "balance", "Operating lease liabilities", ["lease liability", "rou"], "OperatingLeaseLiability", 315),
    ("other_noncurrent_liabilities", "balance", "Other non-current liabilities", ["other long term liabilities"], "OtherLiabilitiesNoncurrent", 320),
    ("stockholders_equity", "balance", "Stockholders' equity", ["equity", "shareholders equity", "stockholders equity"], "StockholdersEquity", 300),
    ("retained_earnings", "balance", "Retained earnings", ["retained earnings"], "RetainedEarningsAccumulatedDeficit", 310),
    ("accumulated_other_comprehensive_income", "balance", "Accumulated other comprehensive income (loss)", ["aoci", "oci"], "AccumulatedOtherComprehensiveIncomeLossNetOfTax", 318),
    ("cashflow_operating", "cashflow", "Cash from operating activities", ["operating cash flow", "cfo", "cash from operations"], "NetCashProvidedByUsedInOperatingActivities", 400),
    ("cashflow_investing", "cashflow", "Cash from investing activities", ["investing cash flow", "cfi"], "NetCashProvidedByUsedInInvestingActivities", 410),
    ("cashflow_financing", "cashflow", "Cash from financing activities", ["financing cash flow", "cff"], "NetCashProvidedByUsedInFinancingActivities", 420),
    ("depreciation_amortization", "cashflow", "Depreciation and amortization", ["d&a", "depreciation amortization"], "DepreciationDepletionAndAmortization", 430),
    ("capex", "cashflow", "Capital expenditures", ["capex", "capital expenditures", "pp&e purchases"], "PaymentsToAcquirePropertyPlantAndEquipment", 440),
]

# FIXED VALUES: insider transaction codes (code, label, description)
TRANSACTION_CODES: list[tuple[str, str, str]] = [
    ("P", "Purchase", "Open market or private purchase of securities"),
    ("S", "Sale", "Open market or private sale of securities"),
    ("A", "Grant/Award", "Grant, award, or other acquisition from the issuer"),
    ("D", "Disposition to issuer", "Disposition to the issuer (forfeiture, cancellation, etc.)"),
    ("M", "Option exercise", "Exercise or conversion of derivative security"),
    ("F", "Tax withholding", "Payment of exercise price or tax liability using shares"),
    ("G", "Gift", "Bona fide gift of securities"),
    ("C", "Conversion", "Conversion of derivative security"),
    ("V", "Voluntary", "Voluntary transaction with the issuer"),
    ("J", "Other", "Other acquisition or disposition"),
    ("K", "Equity swap", "Transaction in equity swap or similar instrument"),
    ("L", "Small acquisition", "Small acquisition under Rule 16a-6"),
    ("U", "Tender offer", "Disposition pursuant to tender offer in Rule 14d-1(b)"),
    ("W", "Will acquisition", "Acquisition or disposition by will or laws of descent"),
    ("X", "In-the-money exercise", "Exercise of in-the-money derivative"),
    ("Z", "Deposit/withdrawal", "Deposit into or withdrawal from voting trust"),
]

# FIXED VALUES: MD&A section rules (form, logical_id, title, candidate keys in order)
MDNA_SECTIONS: list[tuple[str, str, str, list[str]]] = [
    ("10-K", "Item 7", "Management's Discussion and Analysis",
     ["Item 7", "ITEM 7", "item 7", "part_ii_item_7", "item_7"]),
    ("10-K", "Item 7A", "Quantitative and Qualitative Disclosures About Market Risk",
     ["Item 7A", "ITEM 7A", "item 7a", "part_ii_item_7a", "item_7a"]),
    ("10-Q", "Item 2", "Management's Discussion and Analysis of Financial Condition and Results of Operations",
     ["Item 2", "ITEM 2", "item 2", "part_i_item_2", "item_2"]),
]

# FIXED VALUES: press-release title boilerplate phrases (matched lower-case)
TITLE_BOILERPLATE = ("for immediate release", "press release", "news release", "exhibit 99", "exhibit 99.1")
TITLE_DEFAULT = "Press Release"

# FIXED VALUES: graph chain weights for the first and second relationship
CHAIN_WEIGHT_FIRST = {"REPORTS": 100, "FACES": 80, "PRODUCES": 70, "IMPLEMENTS": 60}
CHAIN_WEIGHT_FIRST_ELSE = 40
CHAIN_WEIGHT_SECOND = {"RELATED_TO": 50, "MENTIONED_IN": 40, "IMPACTS": 60}
CHAIN_WEIGHT_SECOND_ELSE = 30

# FIXED VALUES: process names and run-state statuses
PROCESS_NAMES = ("stocks", "financials", "press_releases", "insider_transactions")
RUN_STATUSES = ("idle", "running", "success", "failed")


# FIXED VALUES: company-info key -> ticker profile column (32 keys).
PROFILE_KEYS: list[tuple[str, str]] = [
    ("address1", "address_line_1"), ("city", "city"), ("state", "state"), ("zip", "zip"),
    ("country", "country"), ("phone", "phone"), ("website", "website"), ("industry", "industry"),
    ("industryKey", "industry_key"), ("industryDisp", "industry_disp"), ("sector", "sector"),
    ("sectorKey", "sector_key"), ("sectorDisp", "sector_disp"), ("fullTimeEmployees", "full_time_employees"),
    ("longBusinessSummary", "long_business_summary"), ("auditRisk", "audit_risk"), ("boardRisk", "board_risk"),
    ("compensationRisk", "compensation_risk"), ("shareHolderRightsRisk", "shareholder_rights_risk"),
    ("overallRisk", "overall_risk"), ("irWebsite", "ir_website"), ("currency", "currency"),
    ("fullExchangeName", "full_exchange_name"), ("corporateActions", "corporate_actions"),
    ("shortName", "name"), ("longName", "long_name"), ("displayName", "display_name"),
    ("quoteType", "quote_type"), ("typeDisp", "type_disp"), ("legalType", "legal_type"),
    ("fundFamily", "fund_family"), ("category", "category"),
]

# FIXED VALUES: fundamentals metrics with a default (key, type, default); 68 entries.
DEFAULT_METRICS: list[tuple[str, str, object]] = [
    ("trailingPE", "double", 0.0), ("forwardPE", "double", 0.0), ("marketCap", "bigint", 0),
    ("enterpriseValue", "bigint", 0), ("priceToBook", "double", 0.0), ("trailingPegRatio", "double", 0.0),
    ("priceToSalesTrailing12Months", "double", 0.0), ("dividendYield", "double", 0.0),
    ("dividendRate", "double", 0.0), ("payoutRatio", "double", 0.0), ("fiveYearAvgDividendYield", "double", 0.0),
    ("beta", "double", 0.0), ("volume", "bigint", 0), ("regularMarketVolume", "bigint", 0),
    ("averageVolume", "bigint", 0), ("fiftyTwoWeekLow", "double", 0.0), ("fiftyTwoWeekHigh", "double", 0.0),
    ("fiftyTwoWeekRange", "string", ""), ("fiftyTwoWeekChangePercent", "double", 0.0),
    ("fiftyTwoWeekLowChange", "double", 0.0), ("fiftyTwoWeekLowChangePercent", "double", 0.0),
    ("fiftyTwoWeekHighChange", "double", 0.0), ("fiftyTwoWeekHighChangePercent", "double", 0.0),
    ("fiftyDayAverage", "double", 0.0), ("fiftyDayAverageChange", "double", 0.0),
    ("fiftyDayAverageChangePercent", "double", 0.0), ("twoHundredDayAverage", "double", 0.0),
    ("twoHundredDayAverageChange", "double", 0.0), ("twoHundredDayAverageChangePercent", "double", 0.0),
    ("floatShares", "bigint", 0), ("sharesOutstanding", "bigint", 0), ("sharesShort", "bigint", 0),
    ("bookValue", "double", 0.0), ("trailingEps", "double", 0.0), ("forwardEps", "double", 0.0),
    ("epsForward", "double", 0.0), ("earningsQuarterlyGrowth", "double", 0.0), ("earningsGrowth", "double", 0.0),
    ("enterpriseToRevenue", "double", 0.0), ("enterpriseToEbitda", "double", 0.0), ("totalRevenue", "bigint", 0),
    ("revenueGrowth", "double", 0.0), ("revenuePerShare", "double", 0.0), ("totalCash", "bigint", 0),
    ("totalCashPerShare", "double", 0.0), ("ebitda", "bigint", 0), ("totalDebt", "bigint", 0),
    ("netIncomeToCommon", "bigint", 0), ("debtToEquity", "double", 0.0), ("quickRatio", "double", 0.0),
    ("currentRatio", "double", 0.0), ("returnOnAssets", "double", 0.0), ("returnOnEquity", "double", 0.0),
    ("profitMargins", "double", 0.0), ("grossMargins", "double", 0.0), ("ebitdaMargins", "double", 0.0),
    ("operatingMargins", "double", 0.0), ("grossProfits", "bigint", 0), ("freeCashflow", "bigint", 0),
    ("operatingCashflow", "bigint", 0), ("averageAnalystRating", "string", ""),
    ("recommendationMean", "double", 0.0), ("recommendationKey", "string", ""),
    ("numberOfAnalystOpinions", "bigint", 0), ("targetHighPrice", "double", 0.0),
    ("targetLowPrice", "double", 0.0), ("targetMeanPrice", "double", 0.0), ("targetMedianPrice", "double", 0.0),
]

# FIXED VALUES: fund metrics that stay NULL when absent (column, key); 13 entries.
OPTIONAL_METRICS: list[tuple[str, str]] = [
    ("nav_price", "navPrice"), ("total_assets", "totalAssets"), ("net_assets", "netAssets"),
    ("net_expense_ratio", "netExpenseRatio"), ("yield_pct", "yield"),
    ("trailing_annual_dividend_rate", "trailingAnnualDividendRate"),
    ("trailing_annual_dividend_yield", "trailingAnnualDividendYield"), ("ytd_return", "ytdReturn"),
    ("beta_three_year", "beta3Year"), ("three_year_average_return", "threeYearAverageReturn"),
    ("five_year_average_return", "fiveYearAverageReturn"),
    ("trailing_three_month_returns", "trailingThreeMonthReturns"),
    ("trailing_three_month_nav_returns", "trailingThreeMonthNavReturns"),
]


def _sql_lit(v, dt: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dt.simpleString()})"
    if isinstance(dt, T.ArrayType):
        if not v:
            return f"CAST(array() AS {dt.simpleString()})"
        return "array(" + ", ".join(_sql_lit(x, dt.elementType) for x in v) + ")"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_df(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """A small literal table as one SQL ``VALUES`` list (a LocalRelation).

    Used for the fixed rule tables above: one parse, no Python worker, no RDD;
    Catalyst knows its exact size and broadcasts it for free."""
    rows = list(rows)
    names = [f.name for f in schema.fields]
    if not rows:
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields)
        return spark.sql(f"SELECT {nulls} WHERE FALSE")
    body = ", ".join("(" + ", ".join(_sql_lit(v, f.dataType) for v, f in zip(r, schema.fields)) + ")" for r in rows)
    cols = ", ".join(f"CAST(`{n}` AS {f.dataType.simpleString()}) AS `{n}`" for n, f in zip(names, schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({', '.join('`' + n + '`' for n in names)})")


def gaap_map_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("key", T.StringType(), False),
        T.StructField("line_code", T.StringType(), False),
        T.StructField("statement", T.StringType(), False),
    ])
    return local_df(spark, GAAP_MAP, schema)


def financial_line_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("line_code", T.StringType(), False),
        T.StructField("statement", T.StringType(), False),
        T.StructField("display_name", T.StringType(), False),
        T.StructField("synonyms", T.ArrayType(T.StringType()), False),
        T.StructField("us_gaap_tag", T.StringType(), True),
        T.StructField("sort_order", T.IntegerType(), False),
    ])
    return local_df(spark, FINANCIAL_LINES, schema)


def transaction_code_df(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("code", T.StringType(), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("description", T.StringType(), False),
    ])
    return local_df(spark, TRANSACTION_CODES, schema)


def mdna_rules_df(spark: SparkSession) -> DataFrame:
    rows = [(form, lid, title, cands) for form, lid, title, cands in MDNA_SECTIONS]
    schema = T.StructType([
        T.StructField("form", T.StringType(), False),
        T.StructField("section_id", T.StringType(), False),
        T.StructField("section_title", T.StringType(), False),
        T.StructField("candidates", T.ArrayType(T.StringType()), False),
    ])
    return local_df(spark, rows, schema)
