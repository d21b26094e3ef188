"""The tables: columns, keys, date column, units.

Storage scale is part of the result: indicators are computed as doubles and take their final
scale only when a frame is conformed to its table.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

# Instrument code rules.
SHANGHAI_PREFIX = "^[695]"
FUND_PATTERN = "^(sh5|sz1)"

# Fiscal quarter names by quarter number.
QUARTER_TYPES = ("Q1", "Q2", "Q3", "FY")

# Storage kinds: Spark type and unit.
KINDS: dict[str, tuple[str, str | None]] = {
    "code": ("string", None),
    "text": ("string", None),
    "date": ("date", None),
    "time": ("timestamp", None),
    "flag": ("boolean", None),
    "long": ("bigint", None),
    "int": ("int", None),
    "shares": ("decimal(20,0)", "share"),
    "volume": ("bigint", "share"),
    "price": ("decimal(10,2)", "yuan"),
    "price4": ("decimal(12,4)", "yuan"),
    "range": ("decimal(18,4)", "yuan"),
    "money": ("decimal(18,2)", "yuan"),
    "money20": ("decimal(20,2)", "yuan"),
    "money4": ("decimal(18,4)", "100m yuan"),
    "pct": ("decimal(18,4)", "%"),
    "num4": ("decimal(18,4)", None),
    "num4w": ("decimal(18,4)", None),
    "num6": ("decimal(20,6)", None),
    "pct6": ("decimal(20,6)", "%"),
    "frac6": ("decimal(20,6)", "fraction"),
    "qty": ("decimal(20,0)", None),
    "avg2": ("decimal(18,2)", "share"),
}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str

    @property
    def spark_type(self) -> str:
        return KINDS[self.kind][0]

    @property
    def unit(self) -> str | None:
        return KINDS[self.kind][1]

    @property
    def description(self) -> str:
        return self.name.replace("_", " ")


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[Field, ...]
    keys: tuple[str, ...]
    date_col: str | None
    equity_only: bool = False

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]

    @property
    def by_month(self) -> bool:
        """Stored in month folders: tables whose key holds their date."""
        return self.date_col in self.keys

    def type_of(self, column: str) -> str:
        return next(f.spark_type for f in self.fields if f.name == column)

    @property
    def struct(self) -> T.StructType:
        out = T.StructType()
        for f in self.fields:
            meta = {"description": f.description, "unit": f.unit or ""}
            parsed = T._parse_datatype_string(f.spark_type)
            out.add(f.name, parsed, nullable=f.name not in self.keys, metadata=meta)
        return out


def _fields(groups: Iterable[tuple[str, str]]) -> tuple[Field, ...]:
    return tuple(Field(name, kind) for kind, names in groups for name in names.split())


def _table(name, keys, date_col, *groups, equity_only=False) -> TableSpec:
    return TableSpec(name, _fields(groups), tuple(keys.split()), date_col, equity_only)


# The statement measures that are reported year-to-date, with the kind each is stored in.
CUMULATIVE = (
    "net_profit",
    "total_revenue",
    "operating_cost",
    "net_profit_deducted",
    "operating_cash_flow",
    "capex",
    "interest_expense",
    "eps",
)
BALANCES = (
    "equity_parent",
    "total_assets",
    "inventory",
    "accounts_receivable",
    "accounts_payable",
)
_MARGINS = "roe roa gross_margin net_margin_parent net_margin_deducted"
_DUPONT = "net_margin asset_turnover equity_multiplier"
_CYCLE = ("inventory", "accounts_receivable", "accounts_payable")


def _suffixed(names: str, suffix: str, prefix: str = "") -> str:
    return " ".join(f"{prefix}{n}{suffix}" for n in names.split())


def _cycle(suffix: str) -> str:
    pairs = " ".join(f"{c}_turnover{suffix} {c}_days{suffix}" for c in _CYCLE)
    return f"{pairs} cash_cycle{suffix}"


_FLOW_SIZES = "main xlarge large medium small"

_SPECS = (
    _table(
        "stock_daily", "stock_code trade_date", "trade_date",
        ("code", "stock_code"), ("date", "trade_date"),
        ("price", "open high low close"), ("volume", "volume"), ("money", "amount"),
        ("num6", "adjust_factor"), ("price", "prev_close"), ("pct", "change_pct amplitude"),
        ("range", "body_size upper_shadow lower_shadow"),
        ("price", "high_20 low_20 high_60 low_60"), ("pct6", "turnover"),
        ("shares", "outstanding_share"),
    ),
    _table(
        "financial_statements", "stock_code report_date report_type", "report_date",
        ("code", "stock_code"), ("date", "report_date"), ("text", "report_type"),
        ("money", "total_revenue net_profit total_assets total_liabilities operating_cash_flow"),
        ("num4", "eps"), ("pct", "roe"), ("money", "equity_parent"), ("date", "announcement_date"),
        ("money", "operating_cost net_profit_deducted inventory accounts_receivable"),
        ("money", "accounts_payable capex interest_expense current_assets current_liabilities"),
        ("money", "monetary_funds"),
        equity_only=True,
    ),
    _table(
        "announcements", "stock_code announcement_date title", "announcement_date",
        ("long", "id"), ("code", "stock_code"), ("date", "announcement_date"),
        ("text", "title pdf_url announcement_type"),
    ),
    _table(
        "update_log", "stock_code data_type", "last_update_date",
        ("long", "id"), ("code", "stock_code"), ("text", "data_type"),
        ("date", "last_update_date"), ("time", "update_time"),
    ),
    _table(
        "technical_indicators", "stock_code trade_date", "trade_date",
        ("code", "stock_code"), ("date", "trade_date"), ("price", "ma5 ma10 ma20 ma60"),
        ("range", "ema12 ema26"), ("price", "boll_mid boll_upper boll_lower"),
        ("num4", "macd_dif macd_dea macd_hist"), ("pct", "bias5 bias10 bias20 bias60"),
        ("num4", "rsi6 rsi12 rsi24 kdj_k kdj_d kdj_j cci20 wr14 atr14 std20"),
        ("qty", "vol_ma5 vol_ma10 obv"),
        ("num4", "mfi14 vr dmi_pdi dmi_mdi dmi_adx dmi_adxr"), ("price", "sar"),
        ("num4w", "wvad"),
    ),
    _table(
        "valuation_indicators", "stock_code trade_date", "trade_date",
        ("code", "stock_code"), ("date", "trade_date"), ("num4", "pe_ttm pb ps_ttm"),
        ("pct", "dividend_yield roe"), ("num4", "pe_annual ps_annual"),
        ("pct", "roe_ttm roe_annual"), ("date", "used_report_date used_announcement_date"),
        equity_only=True,
    ),
    _table(
        "stock_capital", "stock_code record_date", "record_date",
        ("code", "stock_code"), ("date", "record_date"), ("shares", "total_shares"),
        equity_only=True,
    ),
    _table(
        "dividends", "stock_code dividend_date", "dividend_date",
        ("code", "stock_code"), ("date", "dividend_date"), ("num4", "cash_per_share"),
        ("date", "announcement_date"),
        equity_only=True,
    ),
    _table(
        "financial_intermediate", "stock_code report_date report_type", "report_date",
        ("code", "stock_code"), ("date", "report_date"), ("text", "report_type"),
        ("num4", "eps bvps revenue_per_share"),
        ("money", "net_profit total_revenue equity equity_parent total_assets"),
        ("shares", "total_shares"), ("date", "announcement_date"),
        ("money", "operating_cost net_profit_deducted inventory accounts_receivable"),
        ("money", "accounts_payable capex interest_expense operating_cash_flow"),
        ("money", "net_profit_q total_revenue_q"), ("num4", "eps_q"),
        ("money", _suffixed("operating_cost net_profit_deducted operating_cash_flow capex", "_q")),
        ("money", "net_profit_ttm total_revenue_ttm"), ("num4", "eps_ttm"),
        ("money", _suffixed(
            "operating_cost net_profit_deducted operating_cash_flow capex interest_expense",
            "_ttm")),
        ("money", _suffixed(" ".join(BALANCES), "", "avg_")),
        ("money", _suffixed(" ".join(BALANCES), "_ttm", "avg_")),
        ("pct", _suffixed(_MARGINS, "_annual")), ("pct", _suffixed(_MARGINS, "_ttm")),
        ("pct", "revenue_yoy_annual net_profit_yoy_annual revenue_yoy_qoq net_profit_yoy_qoq"),
        ("pct", "revenue_yoy_ttm net_profit_yoy_ttm"),
        ("pct", "revenue_cagr_3y net_profit_cagr_3y net_profit_deducted_cagr_3y"),
        ("num4", _suffixed(_DUPONT, "_annual", "dupont_")),
        ("num4", _suffixed(_DUPONT, "_ttm", "dupont_")),
        ("num4w", _cycle("_annual")), ("num4w", _cycle("_ttm")),
        ("num4w", "cash_profit_coverage_ttm"), ("money", "fcf_ttm"),
        ("num4w", "fcf_profit_coverage_ttm cash_interest_coverage_ttm"),
        ("num4", "current_ratio quick_ratio"),
        equity_only=True,
    ),
    _table(
        "northbound_flow", "stock_code trade_date", "trade_date",
        ("code", "stock_code"), ("date", "trade_date"), ("money", "net_inflow"),
        ("shares", "holding_shares"), ("money", "holding_value"), ("pct", "holding_ratio"),
        ("money", "inflow_5d inflow_10d inflow_30d"),
    ),
    _table(
        "northbound_market_flow", "trade_date", "trade_date",
        ("date", "trade_date"),
        ("money4", "net_buy_amount buy_amount sell_amount cumulative_net_buy"),
        ("money4", "daily_inflow daily_balance holding_market_value"),
    ),
    _table(
        "margin_trading", "stock_code trade_date", "trade_date",
        ("code", "stock_code"), ("date", "trade_date"),
        ("money", "rz_balance rz_change"), ("pct", "rz_change_pct"),
        ("money", "rq_balance rq_change"), ("pct", "rq_change_pct"),
        ("money", "total_balance total_change"), ("pct", "total_change_pct"),
    ),
    _table(
        "capital_flow", "stock_code trade_date", "trade_date",
        ("code", "stock_code"), ("date", "trade_date"),
        ("money20", _suffixed(_FLOW_SIZES, "_net_amount")),
        ("pct", _suffixed(_FLOW_SIZES, "_net_ratio")),
    ),
    _table(
        "risk_pledge", "stock_code trade_date", "trade_date",
        ("code", "stock_code"), ("date", "trade_date"), ("pct", "pledge_ratio"),
        ("volume", "pledge_shares"), ("money20", "pledge_market_value"), ("int", "pledge_count"),
        equity_only=True,
    ),
    _table(
        "risk_holder_change",
        "stock_code announcement_date holder_name change_type change_shares",
        "announcement_date",
        ("code", "stock_code"), ("date", "announcement_date"), ("text", "holder_name change_type"),
        ("volume", "change_shares"), ("pct", "change_ratio"), ("volume", "hold_after_shares"),
        ("pct", "hold_after_ratio"), ("date", "change_start_date change_end_date"),
        equity_only=True,
    ),
    _table(
        "risk_buyback", "stock_code announcement_date progress", "announcement_date",
        ("code", "stock_code"), ("date", "announcement_date"), ("text", "progress"),
        ("date", "plan_start_date"), ("price4", "price_cap"),
        ("volume", "shares_lower shares_upper"), ("money20", "amount_lower amount_upper"),
        ("volume", "done_shares"), ("money20", "done_amount"),
        ("price4", "done_price_low done_price_high"),
        equity_only=True,
    ),
    _table(
        "risk_unlock", "stock_code free_date free_type", "free_date",
        ("code", "stock_code"), ("date", "free_date"), ("text", "free_type"),
        ("volume", "free_shares actual_free_shares"), ("money20", "actual_free_value"),
        ("frac6", "ratio_to_float"), ("price4", "close_before"),
        equity_only=True,
    ),
    _table(
        "risk_holder_num", "stock_code stat_date", "stat_date",
        ("code", "stock_code"), ("date", "stat_date"),
        ("long", "holder_num holder_num_prev holder_num_change"), ("pct", "change_ratio"),
        ("money20", "avg_mktcap"), ("avg2", "avg_shares"), ("volume", "total_shares"),
        ("date", "notice_date"),
        equity_only=True,
    ),
    _table(
        "dragon_tiger", "stock_code trade_date list_type", "trade_date",
        ("long", "id"), ("code", "stock_code"), ("date", "trade_date"), ("text", "list_type reason"),
        ("money", "buy_amount sell_amount net_amount"),
        ("pct", "institution_buy_ratio institution_sell_ratio institution_net_ratio"),
    ),
    _table(
        "dragon_tiger_detail", "id", None,
        ("long", "id dragon_tiger_id"), ("code", "stock_code"), ("date", "trade_date"),
        ("text", "list_type seat_name seat_type"),
        ("money", "buy_amount sell_amount net_amount"), ("int", "rank"),
    ),
    _table(
        "stock_industry", "stock_code", "update_date",
        ("code", "stock_code"), ("text", "industry_name industry_level source"),
        ("date", "update_date"),
    ),
    _table(
        "column_metadata", "table_name column_name", None,
        ("text", "table_name column_name description unit"),
    ),
    _table(
        "stock_master", "stock_code", "added_date",
        ("code", "stock_code"), ("text", "stock_name stock_name_cn market board"),
        ("date", "listing_date delisting_date"), ("text", "status"), ("flag", "is_etf is_index"),
        ("date", "added_date"), ("text", "notes"),
    ),
)

TABLES: dict[str, TableSpec] = {s.name: s for s in _SPECS}

# Tables whose per-symbol coverage is reported.
COVERAGE_TABLES = (
    "stock_daily", "technical_indicators", "valuation_indicators", "margin_trading",
    "capital_flow", "financial_intermediate", "financial_statements", "stock_capital",
    "dividends", "dragon_tiger", "risk_pledge", "risk_holder_change", "risk_buyback",
    "risk_unlock", "risk_holder_num",
)
