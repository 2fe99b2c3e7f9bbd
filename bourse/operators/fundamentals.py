"""Fundamental documents -> long-form metric rows.

One parse of the documents feeds every category. A single category is an array
of metric rows per document, exploded; ``fund_all`` explodes the objects and
records of a document and makes the metric rows of these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import nested as N

# ---------------------------------------------------------------------------
# Field lists of the common-stock document sections, in the
# vendor's order (they decide which metric rows exist, NULL or not).
GENERAL_FIELDS = [
    "Code", "Type", "Name", "Exchange", "CurrencyCode", "CountryISO", "OpenFigi", "ISIN", "LEI",
    "PrimaryTicker", "CUSIP", "CIK", "EmployerIdNumber", "FiscalYearEnd", "IPODate", "InternationalDomestic",
    "Sector", "Industry", "GicSector", "GicGroup", "GicIndustry", "GicSubIndustry", "HomeCategory", "IsDelisted",
    "Description", "AddressData", "Phone", "WebURL", "LogoURL", "FullTimeEmployees", "UpdatedAt",
]
ADDRESS_FIELDS = ["Street", "City", "State", "Country", "ZIP"]
LISTING_FIELDS = ["Code", "Exchange"]
PEOPLE_FIELDS = ["Name", "Title", "YearBorn"]
HIGHLIGHT_FIELDS = [
    "MarketCapitalization", "MarketCapitalizationMln", "EBITDA", "PERatio", "PEGRatio", "WallStreetTargetPrice",
    "BookValue", "DividendShare", "DividendYield", "EarningsShare", "EPSEstimateCurrentYear", "EPSEstimateNextYear",
    "EPSEstimateNextQuarter", "EPSEstimateCurrentQuarter", "MostRecentQuarter", "ProfitMargin",
    "OperatingMarginTTM", "ReturnOnAssetsTTM", "ReturnOnEquityTTM", "RevenueTTM", "RevenuePerShareTTM",
    "QuarterlyRevenueGrowthYOY", "GrossProfitTTM", "DilutedEpsTTM", "QuarterlyEarningsGrowthYOY",
]
VALUATION_FIELDS = ["TrailingPE", "ForwardPE", "PriceSalesTTM", "PriceBookMRQ", "EnterpriseValue",
                    "EnterpriseValueRevenue", "EnterpriseValueEbitda"]
SHARE_STAT_FIELDS = ["SharesOutstanding", "SharesFloat", "PercentInsiders", "PercentInstitutions", "SharesShort",
                     "SharesShortPriorMonth", "ShortRatio", "ShortPercentOutstanding", "ShortPercentFloat"]
TECHNICAL_FIELDS = ["Beta", "52WeekHigh", "52WeekLow", "50DayMA", "200DayMA", "SharesShort",
                    "SharesShortPriorMonth", "ShortRatio", "ShortPercent"]
DIVIDEND_FIELDS = ["ForwardAnnualDividendRate", "ForwardAnnualDividendYield", "PayoutRatio", "DividendDate",
                   "ExDividendDate"]
SHARE_SPLIT_FIELDS = ["LastSplitFactor", "LastSplitDate"]
SHARE_OUTSTANDING_FIELDS = ["dateFormatted", "shares"]
COMMON_STOCK = "Common Stock"
# ---------------------------------------------------------------------------

_REC = T.MapType(T.StringType(), T.MapType(T.StringType(), T.StringType()))
_OBJ = T.MapType(T.StringType(), T.StringType())


def _periodic():
    return T.StructType([T.StructField("yearly", _REC), T.StructField("quarterly", _REC)])


DOC_SCHEMA = T.StructType([
    T.StructField("General", _OBJ),
    T.StructField("Highlights", _OBJ),
    T.StructField("Valuation", _OBJ),
    T.StructField("SharesStats", _OBJ),
    T.StructField("Technicals", _OBJ),
    T.StructField("SplitsDividends", _OBJ),
    T.StructField("Components", _REC),
    T.StructField("Financials", T.StructType([
        T.StructField("Balance_Sheet", _periodic()),
        T.StructField("Income_Statement", _periodic()),
        T.StructField("Cash_Flow", _periodic()),
    ])),
    T.StructField("outstandingShares", T.StructType([T.StructField("annual", _REC),
                                                     T.StructField("quarterly", _REC)])),
    T.StructField("Earnings", T.StructType([T.StructField("History", _REC), T.StructField("Trend", _REC),
                                            T.StructField("Annual", _REC)])),
])

ID_COLS = ["exchange_code", "security_code"]


# Columns of the parsed frame -> (section path in the document).
_COLUMNS = {
    "Highlights": ("Highlights",), "Valuation": ("Valuation",), "SharesStats": ("SharesStats",),
    "Technicals": ("Technicals",), "SplitsDividends": ("SplitsDividends",),
    "bs_y": ("Financials", "Balance_Sheet", "yearly"), "bs_q": ("Financials", "Balance_Sheet", "quarterly"),
    "is_y": ("Financials", "Income_Statement", "yearly"), "is_q": ("Financials", "Income_Statement", "quarterly"),
    "cf_y": ("Financials", "Cash_Flow", "yearly"), "cf_q": ("Financials", "Cash_Flow", "quarterly"),
    "os_y": ("outstandingShares", "annual"), "os_q": ("outstandingShares", "quarterly"),
    "eh": ("Earnings", "History"), "et": ("Earnings", "Trend"), "ea": ("Earnings", "Annual"),
}


def _pruned_schema(columns) -> T.StructType:
    """DOC_SCHEMA restricted to General + the sections behind ``columns``: the
    JSON parser then builds only what the requested categories read."""
    paths = [_COLUMNS[c] for c in columns if c in _COLUMNS]

    def prune(st: T.StructType, prefix: tuple) -> T.StructType:
        keep = []
        for f in st.fields:
            here = prefix + (f.name,)
            if not prefix and f.name == "General":
                keep.append(f)
            elif any(p[:len(here)] == here for p in paths):
                if any(p == here for p in paths) or not isinstance(f.dataType, T.StructType):
                    keep.append(f)
                else:
                    keep.append(T.StructField(f.name, prune(f.dataType, here)))
        return T.StructType(keep)

    return prune(DOC_SCHEMA, ())


_HEADER = T.StructType([T.StructField(f, T.StringType()) for f in ["Code", "Type", "Exchange"]])


def _may_be(value: str, text_col: str):
    """False only for documents that cannot hold this value: those whose text
    lacks it and has no backslash (it might be written with escapes)."""
    text = F.col(text_col)
    return text.contains(value) | text.contains("\\")


def parsed_common_stock(docs: DataFrame, text_col: str = "doc_text", columns=None,
                        full_general: bool = True) -> DataFrame:
    """Parse once (only the sections behind ``columns``; all when None), keep
    common-stock documents, expose id columns and the sections as columns.

    With ``full_general=False`` only the three header fields of ``General``
    are parsed (its nested objects are skipped, not re-serialized as text);
    the general / listing / people categories need the full object."""
    columns = list(_COLUMNS) if columns is None else list(columns)
    schema = _pruned_schema(columns)
    if not full_general:
        schema = T.StructType([T.StructField("General", _HEADER) if f.name == "General" else f
                               for f in schema.fields])
    parsed, _rejects = N.parse_documents(docs, text_col, schema, required="General", only=_may_be(COMMON_STOCK, text_col))
    d = F.col("doc")
    g = d["General"]
    if not full_general:
        base = parsed.where(g["Type"] == F.lit(COMMON_STOCK))
        out = [g["Exchange"].alias("exchange_code"), g["Code"].alias("security_code")]
        for c in columns:
            if c in _COLUMNS:
                e = d
                for part in _COLUMNS[c]:
                    e = e[part]
                out.append(e.alias(c))
        return base.select(*out)
    base = parsed.where(N.map_get(g, "Type") == F.lit(COMMON_STOCK))
    out = [N.map_get(g, "Exchange").alias("exchange_code"), N.map_get(g, "Code").alias("security_code"),
           g.alias("General"),
           F.from_json(N.map_get(g, "Listings"), _REC).alias("Listings"),
           F.from_json(N.map_get(g, "Officers"), _REC).alias("Officers")]
    for c in columns:
        if c in _COLUMNS:
            e = d
            for part in _COLUMNS[c]:
                e = e[part]
            out.append(e.alias(c))
    return base.select(*out)


# Each category is an array column of metric rows per document; a category
# frame is that array exploded. ``fund_all`` has the same rows of all sixteen in
# ONE pass (no union of separate scans, no shuffle), from ``_all_sections``.

def _c(name):
    return F.col(name)


ARRAYS = {
    "fund_general": lambda: N.struct_metric_array(_c("General"), "general", GENERAL_FIELDS,
                                                  {"AddressData": ADDRESS_FIELDS}),
    "fund_listing": lambda: N.json_value_metric_array(_c("Listings"), "listing", "general", LISTING_FIELDS),
    "fund_people": lambda: N.json_value_metric_array(_c("Officers"), "people", "general", PEOPLE_FIELDS),
    "fund_balance_sheet": lambda: N.records_metric_array([(_c("bs_y"), "yearly"), (_c("bs_q"), "quarterly")],
                                                         "balance_sheet"),
    "fund_income_statement": lambda: N.records_metric_array([(_c("is_y"), "yearly"), (_c("is_q"), "quarterly")],
                                                            "income_statement"),
    "fund_cash_flow": lambda: N.records_metric_array([(_c("cf_y"), "yearly"), (_c("cf_q"), "quarterly")],
                                                     "cash_flow_statement"),
    "fund_outstanding_shares": lambda: N.records_metric_array(
        [(_c("os_y"), "yearly"), (_c("os_q"), "quarterly")], "outstanding_shares", date_key="dateFormatted",
        fields=SHARE_OUTSTANDING_FIELDS),
    "fund_earning_history": lambda: N.records_metric_array([(_c("eh"), "quarterly")], "earning_history",
                                                           published_key="reportDate"),
    "fund_earning_trend": lambda: N.records_metric_array([(_c("et"), "quarterly")], "earning_trend"),
    "fund_earning_per_share": lambda: N.records_metric_array([(_c("ea"), "yearly")], "earning_per_share"),
    "fund_highlight": lambda: N.struct_metric_array(_c("Highlights"), "highlight", HIGHLIGHT_FIELDS),
    "fund_valuation": lambda: N.struct_metric_array(_c("Valuation"), "valuation", VALUATION_FIELDS),
    "fund_share_stat": lambda: N.struct_metric_array(_c("SharesStats"), "share_stat", SHARE_STAT_FIELDS),
    "fund_technical": lambda: N.struct_metric_array(_c("Technicals"), "technical", TECHNICAL_FIELDS),
    "fund_dividend": lambda: N.struct_metric_array(_c("SplitsDividends"), "dividend", DIVIDEND_FIELDS),
    "fund_share_split": lambda: N.struct_metric_array(_c("SplitsDividends"), "share_split", SHARE_SPLIT_FIELDS),
}


def _category(name):
    def fn(p: DataFrame) -> DataFrame:
        return N.explode_metrics(p, ARRAYS[name](), ID_COLS)
    fn.__name__ = name
    return fn


fund_general = _category("fund_general")
fund_people = _category("fund_people")
fund_balance_sheet = _category("fund_balance_sheet")
fund_income_statement = _category("fund_income_statement")
fund_cash_flow = _category("fund_cash_flow")
fund_outstanding_shares = _category("fund_outstanding_shares")
fund_earning_history = _category("fund_earning_history")
fund_earning_trend = _category("fund_earning_trend")
fund_earning_per_share = _category("fund_earning_per_share")
fund_highlight = _category("fund_highlight")
fund_valuation = _category("fund_valuation")
fund_share_stat = _category("fund_share_stat")
fund_technical = _category("fund_technical")
fund_dividend = _category("fund_dividend")
fund_share_split = _category("fund_share_split")


def fund_listing(p: DataFrame, legacy_metric_name: bool = False) -> DataFrame:
    # The reference labels this metric "people" (defect D3); "listing" here.
    name = "people" if legacy_metric_name else "listing"
    return N.explode_metrics(p, N.json_value_metric_array(_c("Listings"), name, "general", LISTING_FIELDS), ID_COLS)


# Parsed columns each category reads.
SECTIONS = {
    "fund_general": [], "fund_listing": [], "fund_people": [],
    "fund_balance_sheet": ["bs_y", "bs_q"], "fund_income_statement": ["is_y", "is_q"],
    "fund_cash_flow": ["cf_y", "cf_q"], "fund_outstanding_shares": ["os_y", "os_q"],
    "fund_earning_history": ["eh"], "fund_earning_trend": ["et"], "fund_earning_per_share": ["ea"],
    "fund_highlight": ["Highlights"], "fund_valuation": ["Valuation"], "fund_share_stat": ["SharesStats"],
    "fund_technical": ["Technicals"], "fund_dividend": ["SplitsDividends"], "fund_share_split": ["SplitsDividends"],
}

CATEGORIES = {
    "fund_general": fund_general,
    "fund_listing": fund_listing,
    "fund_people": fund_people,
    "fund_balance_sheet": fund_balance_sheet,
    "fund_income_statement": fund_income_statement,
    "fund_cash_flow": fund_cash_flow,
    "fund_outstanding_shares": fund_outstanding_shares,
    "fund_earning_history": fund_earning_history,
    "fund_earning_trend": fund_earning_trend,
    "fund_earning_per_share": fund_earning_per_share,
    "fund_highlight": fund_highlight,
    "fund_valuation": fund_valuation,
    "fund_share_stat": fund_share_stat,
    "fund_technical": fund_technical,
    "fund_dividend": fund_dividend,
    "fund_share_split": fund_share_split,
}


_NEEDS_GENERAL = {"fund_general", "fund_listing", "fund_people"}


def fund_category(docs: DataFrame, name: str, text_col: str = "doc_text") -> DataFrame:
    """One category: parse only the sections it reads, then reshape."""
    return CATEGORIES[name](parsed_common_stock(docs, text_col, SECTIONS[name],
                                                full_general=name in _NEEDS_GENERAL))


def rejected_documents(docs: DataFrame, text_col: str = "doc_text") -> DataFrame:
    """The documents that no category is read from because they do not parse
    or have no ``General`` part; only its header fields are parsed."""
    return N.parse_documents(docs, text_col, T.StructType([T.StructField("General", _HEADER)]), required="General")[1]


def _all_sections() -> list[N.Section]:
    """The sixteen categories as sections of the parsed frame."""
    def whole(category, m, fields, given=None):
        return N.Section(category, tuple(fields), N.field_values(_c(m), fields, given))

    def dated(category, *parts, **keys):
        return [N.Section(category, records=_c(c), period_type=pt, **keys) for c, pt in parts]

    plain = [f for f in GENERAL_FIELDS if f != "AddressData"]
    return [
        whole("general", "General", plain), whole("general", "Address", ADDRESS_FIELDS, _c("General")),
        N.Section("general", ("listing",), N.json_values(_c("Listings"), LISTING_FIELDS)),
        N.Section("general", ("people",), N.json_values(_c("Officers"), PEOPLE_FIELDS)),
        whole("highlight", "Highlights", HIGHLIGHT_FIELDS), whole("valuation", "Valuation", VALUATION_FIELDS),
        whole("share_stat", "SharesStats", SHARE_STAT_FIELDS), whole("technical", "Technicals", TECHNICAL_FIELDS),
        whole("dividend", "SplitsDividends", DIVIDEND_FIELDS), whole("share_split", "SplitsDividends", SHARE_SPLIT_FIELDS),
        *dated("balance_sheet", ("bs_y", "yearly"), ("bs_q", "quarterly")),
        *dated("income_statement", ("is_y", "yearly"), ("is_q", "quarterly")),
        *dated("cash_flow_statement", ("cf_y", "yearly"), ("cf_q", "quarterly")),
        *dated("outstanding_shares", ("os_y", "yearly"), ("os_q", "quarterly"), date_key="dateFormatted",
               fields=tuple(f for f in SHARE_OUTSTANDING_FIELDS if f != "dateFormatted")),
        *dated("earning_history", ("eh", "quarterly"), published_key="reportDate"),
        *dated("earning_trend", ("et", "quarterly")), *dated("earning_per_share", ("ea", "yearly")),
    ]


def fund_all(docs: DataFrame, text_col: str = "doc_text") -> DataFrame:
    """All categories of all common-stock documents, one frame: the
    documents are parsed once, and every category's metric rows come from
    that parse."""
    p = parsed_common_stock(docs, text_col)
    p = p.withColumn("Address", F.from_json(N.map_get(_c("General"), "AddressData"), _OBJ))
    return N.explode_sections(p, _all_sections(), ID_COLS)
