"""Data-quality checks.

Invariant checks share one report shape: (check, violations, sample_size, passed). All checks over
one table are counted in a single pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalar import ndiv, non_zero, num, positive
from tickloom.functions.series import BARS, Series
from tickloom.operators.latest import duplicate_keys, narrow

AMOUNT_TOLERANCE = 1.0
RATIO_TOLERANCE = 0.05
CLOSE_TOLERANCE = 0.01
JUMP_PERCENT = 30.0
MIN_SYMBOLS_PER_DAY = 8

# Unit detection bands (stored / reference), its minimum sample and tolerances.
PERCENT_BAND = (0.8, 1.25)
FRACTION_BAND = (0.008, 0.0125)
MIN_SAMPLE = 20
SAME_ABSOLUTE = 0.005
SAME_RELATIVE = 0.02

_KEY = ["stock_code", "trade_date"]


def count_checks(df: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """One report row per check; ``checks`` maps a name to its violation predicate."""
    totals = df.selectExpr(
        "count(*) AS sample_size",
        *(f"count_if({bad}) AS c{i}" for i, bad in enumerate(checks.values())),
    )
    pairs = ", ".join(f"'{n}', c{i}" for i, n in enumerate(checks))
    return totals.selectExpr(
        f"stack({len(checks)}, {pairs}) AS (check, violations)", "sample_size"
    ).selectExpr("check", "violations", "sample_size", "violations = 0 AS passed")


def count_rows(bad: DataFrame, sample: DataFrame, check: str) -> DataFrame:
    """A report row whose violations are the rows of a frame."""
    found = bad.selectExpr("count(*) AS n").scalar()
    return sample.selectExpr("count(*) AS sample_size").select(
        F.lit(check).alias("check"),
        found.alias("violations"),
        "sample_size",
        (found == 0).alias("passed"),
    )


# --- capital flow -----------------------------------------------------------------------------


def _conservation() -> dict[str, str]:
    """Do the four classes cancel out? The audit and the load put the floor differently."""
    sizes = [num(f"{s}_net_amount") for s in ("xlarge", "large", "medium", "small")]
    total = f"abs({' + '.join(sizes)})"
    scale = " + ".join(f"abs({s})" for s in sizes)
    return {
        "conservation": f"{total} > greatest({scale}, 1D) * 1e-3",
        "conservation_on_load": f"{total} > greatest(({scale}) * 1e-3, 10D)",
    }


def flow_identities(flow: DataFrame) -> DataFrame:
    """Main = large + extra large, closing ratios, and conservation by audit and by load rule."""

    def gap(what: str) -> str:
        main, large, xlarge = (num(f"{s}_net_{what}") for s in ("main", "large", "xlarge"))
        return f"abs({main} - ({large} + {xlarge}))"

    return count_checks(
        flow,
        {
            "main_amount": f"{gap('amount')} > {AMOUNT_TOLERANCE}D",
            "main_ratio": f"{gap('ratio')} > {RATIO_TOLERANCE}D",
            **_conservation(),
        },
    )


def flow_against_bars(
    flow: DataFrame, daily: DataFrame, exceptions: DataFrame | None = None
) -> DataFrame:
    """Each comparable row, marked bad if its stated ratio disagrees with net over traded amount.

    Documented exceptions are never bad.
    """
    bars = daily.where("amount != 0").selectExpr(*_KEY, f"{num('amount')} AS traded")
    rows = flow.join(bars, _KEY).selectExpr(
        *_KEY,
        f"{ndiv(num('main_net_amount'), 'traded')} * 100 AS implied",
        f"{num('main_net_ratio')} AS stated",
    )
    rows = rows.selectExpr(
        "*", "abs(implied - stated) > greatest(0.05D, abs(stated) * 0.01D) AS bad"
    )
    if exceptions is None:
        return rows
    marked = exceptions.selectExpr(*_KEY, "true AS known")
    rows = rows.join(marked, _KEY, "left")
    return rows.selectExpr(*_KEY, "implied", "stated", "bad AND known IS NULL AS bad")


def flow_against_bars_report(
    flow: DataFrame, daily: DataFrame, exceptions: DataFrame | None = None
) -> DataFrame:
    return count_checks(flow_against_bars(flow, daily, exceptions), {"cross_source": "bad"})


def close_mismatch(quotes: DataFrame, daily: DataFrame) -> DataFrame:
    """Per symbol: how many days carry both closes, and on how many they differ by over 1 %."""
    bars = daily.where("close != 0").selectExpr(*_KEY, f"{num('close')} AS bar_close")
    both = quotes.selectExpr(*_KEY, f"{num('close')} AS quoted").join(bars, _KEY)
    apart = f"abs(bar_close - quoted) / bar_close > {CLOSE_TOLERANCE}D"
    return both.groupBy("stock_code").agg(
        F.count("*").alias("checked"), F.expr(f"count_if({apart}) AS mismatch")
    )


def orphans(rows: DataFrame, parent: DataFrame, keys: Sequence[str] = _KEY) -> DataFrame:
    return rows.join(parent.select(*keys), list(keys), "left_anti")


def duplicate_report(df: DataFrame, keys: Sequence[str], check: str) -> DataFrame:
    return count_rows(duplicate_keys(df, keys), df, check)


# --- calendar gaps ----------------------------------------------------------------------------


def trading_calendar(daily: DataFrame, min_symbols: int = MIN_SYMBOLS_PER_DAY) -> DataFrame:
    """Days on which enough symbols traded."""
    return (
        daily.groupBy("trade_date")
        .agg(F.countDistinct("stock_code").alias("symbols"))
        .where(f"symbols >= {min_symbols}")
        .select("trade_date")
    )


def calendar_gaps(
    daily: DataFrame, start: str | None = None, min_symbols: int = MIN_SYMBOLS_PER_DAY
) -> DataFrame:
    """Trading days a symbol lacks.

    Trading days are numbered, and each symbol's jumps in that numbering are filled in. Only the
    missing days are ever produced, not the symbol x calendar grid. The numbering runs over one
    row per calendar day.
    """
    days = daily if start is None else daily.where(f"trade_date >= date'{start}'")
    calendar = trading_calendar(days, min_symbols).selectExpr(
        "trade_date", "row_number() OVER (ORDER BY trade_date) AS day"
    )
    last = calendar.selectExpr("coalesce(max(day), 0) AS n").scalar()
    present = daily.select(*_KEY).join(calendar, "trade_date").select("stock_code", "day")
    symbols = daily.select("stock_code").distinct()
    ends = symbols.select("stock_code", F.explode(F.array(F.lit(0), last + 1)).alias("day"))
    before = Series(order="day").lag("day")
    jumps = present.unionByName(ends).selectExpr("stock_code", "day", f"{before} AS before")
    missing = jumps.where("day - before > 1").selectExpr(
        "stock_code", "explode(sequence(before + 1, day - 1)) AS day"
    )
    return missing.join(calendar, "day").select("stock_code", "trade_date")


def long_gaps(daily: DataFrame, over_days: int = 7) -> DataFrame:
    """Neighbouring bars further apart than ``over_days`` calendar days."""
    rows = daily.selectExpr(*_KEY, f"{BARS.lag('trade_date')} AS prev_date")
    rows = rows.selectExpr("*", "datediff(trade_date, prev_date) AS gap_days")
    return rows.where(f"gap_days > {over_days}")


def price_jumps(daily: DataFrame, max_percent: float = JUMP_PERCENT) -> DataFrame:
    """Every bar with its change against the previous one and whether it may be stored."""
    rows = daily.selectExpr(*_KEY, f"{num('close')} AS close")
    rows = rows.selectExpr("*", f"{BARS.lag('close')} AS before")
    rows = rows.selectExpr(
        *_KEY, f"abs({ndiv('close', non_zero('before'))} - 1) * 100 AS move_pct"
    )
    return rows.selectExpr("*", f"coalesce(move_pct <= {max_percent}, true) AS accepted")


# --- profiles ---------------------------------------------------------------------------------


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, NULLs and a grade, from one pass."""
    totals = df.selectExpr(
        "count(*) AS total_rows", *(f"count({c}) AS n{i}" for i, c in enumerate(columns))
    )
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(columns))
    rows = totals.selectExpr(
        f"stack({len(columns)}, {pairs}) AS (column_name, present)", "total_rows"
    )
    return rows.selectExpr(
        "column_name", "total_rows", "total_rows - present AS null_rows"
    ).selectExpr(
        "*",
        "CASE WHEN null_rows = 0 THEN 'PASS' WHEN null_rows < total_rows * 0.1 THEN 'WARN' "
        "ELSE 'FAIL' END AS grade",
    )


def range_violations(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Per column: how many present values lie outside [low, high]."""
    return count_checks(
        df, {c: f"{num(c)} NOT BETWEEN {low} AND {high}" for c, (low, high) in bounds.items()}
    )


def non_positive_prices(daily: DataFrame) -> DataFrame:
    return count_checks(
        daily, {"non_positive_price": "open <= 0 OR high <= 0 OR low <= 0 OR close <= 0"}
    )


def filled_counts(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """Per group: rows, and present values of each column."""
    return df.groupBy(by).agg(
        F.count("*").alias("total_rows"), *(F.count(c).alias(f"{c}_filled") for c in columns)
    )


def pe_bands(valuation: DataFrame) -> DataFrame:
    return valuation.selectExpr(
        "count_if(pe_ttm <= 0) AS negative",
        "count_if(pe_ttm > 0 AND pe_ttm < 15) AS low",
        "count_if(pe_ttm >= 15 AND pe_ttm < 30) AS middle",
        "count_if(pe_ttm >= 30 AND pe_ttm < 60) AS high",
        "count_if(pe_ttm >= 60) AS very_high",
        "count_if(pe_ttm IS NULL) AS unknown",
    )


def latest_pe_bands(valuation: DataFrame) -> DataFrame:
    """The coarser bands over the latest row of each symbol."""
    latest = valuation.groupBy("stock_code").agg(F.max_by("pe_ttm", "trade_date").alias("pe_ttm"))
    return latest.selectExpr(
        "count(*) AS total",
        "count_if(pe_ttm > 0 AND pe_ttm < 30) AS normal",
        "count_if(pe_ttm >= 30 AND pe_ttm < 100) AS high",
        "count_if(pe_ttm >= 100 OR pe_ttm IS NULL) AS very_high",
        "count_if(pe_ttm < 1) AS abnormal",
    )


def column_stats(df: DataFrame, column: str) -> DataFrame:
    return df.selectExpr(
        f"min({column}) AS min_value", f"max({column}) AS max_value", f"avg({column}) AS avg_value"
    )


# --- turnover units ---------------------------------------------------------------------------


def _with_reference(stored: DataFrame, reference: DataFrame) -> DataFrame:
    ours = stored.selectExpr(*_KEY, f"{num('turnover')} AS stored")
    theirs = reference.selectExpr(*_KEY, f"{positive(num('turnover'))} AS ref")
    return ours.join(theirs, _KEY, "left")


def _unit() -> str:
    def band(low: float, high: float) -> str:
        return f"median_ratio BETWEEN {low}D AND {high}D"

    return (
        "CASE WHEN samples = 0 AND empty THEN 'vacant' "
        f"WHEN samples < {MIN_SAMPLE} THEN 'unknown' "
        f"WHEN {band(*PERCENT_BAND)} THEN 'percent' "
        f"WHEN {band(*FRACTION_BAND)} THEN 'fraction' ELSE 'unknown' END"
    )


def turnover_units(stored: DataFrame, reference: DataFrame) -> DataFrame:
    """Per symbol: is the stored turnover a percent, a fraction, empty or unclear?

    Decided by the upper median of stored / reference. Ranks come from a window over the symbol's
    days, so no group of values is collected.
    """
    rows = _with_reference(stored, reference).selectExpr(
        "stock_code", "stored", f"{ndiv(positive('stored'), 'ref')} AS ratio"
    )
    by_ratio = Series(order="ratio ASC NULLS LAST")
    ranked = rows.selectExpr(
        "stock_code",
        "stored",
        "ratio",
        f"{by_ratio.over('row_number()')} AS place",
        f"{by_ratio.whole('count(ratio)')} AS samples",
    )
    per = ranked.groupBy("stock_code").agg(
        F.max("samples").alias("samples"),
        F.expr("max(if(place = samples div 2 + 1, ratio, NULL)) AS median_ratio"),
        F.expr("bool_and(coalesce(stored = 0, true)) AS empty"),
    )
    return per.selectExpr(
        "stock_code",
        f"{_unit()} AS unit",
        f"if(samples >= {MIN_SAMPLE}, median_ratio, NULL) AS median_ratio",
        "samples",
    )


def reconcile_turnover(stored: DataFrame, reference: DataFrame) -> DataFrame:
    """Classify each stored value against the reference and give the value to keep.

    Symbols of unknown unit are left out altogether.
    """
    units = turnover_units(stored, reference).where("unit != 'unknown'")
    rows = _with_reference(stored, reference).join(units.select("stock_code", "unit"), "stock_code")
    close = f"abs(stored - ref) <= greatest({SAME_ABSOLUTE}D, ref * {SAME_RELATIVE}D)"
    kind = (
        "CASE WHEN ref IS NULL THEN 'no_ref' WHEN stored IS NULL OR stored = 0 THEN 'fill' "
        f"WHEN {close} THEN 'same' WHEN unit = 'fraction' THEN 'fix_unit' ELSE 'overwrite' END"
    )
    return rows.selectExpr("*", f"{kind} AS kind").selectExpr(
        *_KEY, "kind", "if(kind IN ('no_ref', 'same'), stored, ref) AS turnover"
    )


# --- quotes -----------------------------------------------------------------------------------


def quote_identities(quotes: DataFrame) -> DataFrame:
    """Eight identities of a parsed quote, one boolean column each; a missing field fails."""

    def near(a: str, b: str, tolerance: float) -> str:
        return f"abs({a} - {b}) <= {tolerance}D"

    limit = f"({ndiv(non_zero('high_limit'), non_zero('prev_close'))} - 1)"
    moved = f"({ndiv(non_zero('close'), non_zero('prev_close'))} - 1) * 100"
    swing = f"{ndiv('high - low', non_zero('prev_close'))} * 100"
    float_shares = ndiv(f"{non_zero('circ_mv')} * 1e8", non_zero("close"))
    turned = f"{ndiv(f'{non_zero('volume')} * 100', float_shares)} * 100"
    checks = {
        "limit_band": " OR ".join(near(limit, f"{x}D", 0.005) for x in (0.05, 0.10, 0.20)),
        "change_pct": near(moved, "change_pct", 0.05),
        "amplitude": near(swing, "amplitude", 0.05),
        "turnover": near(turned, "turnover", 0.05),
        "cap_order": "total_mv >= circ_mv - 1e-6",
        "pe_not_tiny": "NOT (abs(pe_ttm) > 0 AND abs(pe_ttm) < 1)",
        "pb_range": "pb > 0 AND pb < 100",
        "close_in_range": "low <= close AND close <= high",
    }
    return quotes.selectExpr(
        "stock_code", *(f"coalesce({bad}, false) AS ok_{n}" for n, bad in checks.items())
    )


# --- risk tables, statements, completeness ----------------------------------------------------


RISK_RULES: dict[str, dict[str, str]] = {
    "risk_pledge": {"ratio_bounds": "pledge_ratio < 0 OR pledge_ratio > 100"},
    "risk_holder_change": {"shares_positive": "change_shares <= 0"},
    "risk_buyback": {
        "amounts_ordered": "done_amount < 0 OR done_shares < 0 OR amount_upper < amount_lower"
    },
    "risk_unlock": {"shares_positive": "free_shares <= 0 OR ratio_to_float <= 0"},
    "risk_holder_num": {"count_positive": "holder_num <= 0"},
}


def risk_rules(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Value rules of the five risk tables in one report."""
    report = None
    for table, rules in RISK_RULES.items():
        part = count_checks(tables[table], {f"{table}.{n}": rule for n, rule in rules.items()})
        report = part if report is None else report.unionByName(part)
    return report


def funds_ratio(statements: DataFrame) -> DataFrame:
    """Per symbol: how often monetary funds are filled, their greatest share of current assets."""
    share = ndiv(num("monetary_funds"), num("current_assets"))
    out = statements.groupBy("stock_code").agg(
        F.count("*").alias("total_rows"),
        F.count("monetary_funds").alias("filled"),
        F.expr(f"max({share}) AS max_ratio"),
    )
    return out.selectExpr("*", "coalesce(max_ratio > 1, false) AS suspicious")


def recompute_deviation(
    stored: DataFrame,
    fresh: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    threshold: float = 0.02,
) -> DataFrame:
    """Mean absolute difference of stored and recomputed columns, a missing one counting as zero."""
    renamed = fresh.selectExpr(*keys, *(f"{num(c)} AS _fresh_{c}" for c in columns))
    both = stored.selectExpr(*keys, *(f"{num(c)} AS {c}" for c in columns))
    means = both.join(renamed, list(keys)).selectExpr(
        *(f"avg(coalesce(abs({c} - _fresh_{c}), 0D)) AS m{i}" for i, c in enumerate(columns))
    )
    pairs = ", ".join(f"'{c}', m{i}" for i, c in enumerate(columns))
    return means.selectExpr(
        f"stack({len(columns)}, {pairs}) AS (column_name, mean_abs_diff)"
    ).selectExpr("*", f"mean_abs_diff < {threshold} AS passed")


def relative_deviation(
    stored: DataFrame, fresh: DataFrame, keys: Sequence[str], column: str, percent: float = 1.0
) -> DataFrame:
    """Both values of one column, and whether the stored one is within ``percent`` of the fresh."""
    both = stored.selectExpr(*keys, f"{num(column)} AS stored_value").join(
        fresh.selectExpr(*keys, f"{num(column)} AS fresh_value"), list(keys)
    )
    gap = f"{ndiv('abs(fresh_value - stored_value)', 'abs(fresh_value)')} * 100"
    ok = f"(fresh_value = 0 AND stored_value = 0) OR {gap} < {percent}"
    return both.selectExpr("*", f"coalesce({ok}, false) AS passed")


def completeness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per symbol: rows of each table, and whether the derived tables cover the bars."""
    named = {
        "daily": "stock_daily",
        "technical": "technical_indicators",
        "valuation": "valuation_indicators",
        "statements": "financial_statements",
        "fundamentals": "financial_intermediate",
        "capital": "stock_capital",
    }
    stacked = None
    for short, table in named.items():
        part = narrow(tables, table, "stock_code").groupBy("stock_code").agg(F.count("*").alias("n"))
        part = part.selectExpr("stock_code", f"'{short}' AS t", "n")
        stacked = part if stacked is None else stacked.unionByName(part)
    wide = stacked.groupBy("stock_code").agg(
        *(F.expr(f"coalesce(sum(if(t = '{s}', n, NULL)), 0) AS {s}_rows") for s in named)
    )
    return wide.selectExpr(
        "*", "technical_rows >= daily_rows - 1 AND statements_rows > 0 AS complete"
    )


def table_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame], names: Sequence[str]
) -> DataFrame:
    """Row count of each table; a table that is absent counts NULL."""
    listed = spark.createDataFrame([(n,) for n in names], "table_name string")
    report = None
    for table in names:
        if table in tables:
            part = tables[table].selectExpr(f"'{table}' AS table_name", "count(*) AS rows")
            report = part if report is None else report.unionByName(part)
    if report is None:
        return listed.selectExpr("table_name", "bigint(NULL) AS rows")
    return listed.join(report, "table_name", "left")


def truncation_collisions(
    feed: DataFrame, keys: Sequence[str], text: str, width: int
) -> DataFrame:
    """Keys that become equal only because a text is cut to ``width`` characters."""
    cut = feed.selectExpr(*keys, f"left({text}, {width}) AS short_text", text).distinct()
    return cut.groupBy(*keys, "short_text").agg(F.count("*").alias("variants")).where("variants > 1")
